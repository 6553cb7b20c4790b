"""Receipt metadata and line items from recognised text.

Every field of a receipt depends on its own text alone, so all of this works on arrays inside the document's row.
Nothing is shuffled, the number of lines never decides how work is spread, and each step is linear in the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.functions.numbers import (
    NUMBER_ANY,
    PERCENT_TOKEN,
    PRICE_DECIMAL,
    fix_split_decimal,
    money_ocr,
    round2,
)
from docledger.functions.predicates import is_excluded_line, is_total_named, is_valid_name
from docledger.functions.strings import item_name_of, merchant_text_clean, name_like, normalize_line
from docledger.functions.text import blank_to_null, collapse, extract, filled_lines, strip, text_lines, tidy_lines

# Brands looked for in the whole text before any line is considered, with a part that the lower-cased text
# must hold. No character but ASCII letters has the lower case of one in these parts.
BRANDS = (
    (r"(?iU)\bwal[-\s\*]*mart\b", "mart", "WALMART"),
    (r"(?iU)\btrader\s*joe'?s?\b", "trader", "TRADER JOE'S"),
)

# Patterns of single receipt fields.
NOT_A_MERCHANT = r"(?i)survey|feedback|thank|manager|mgr"
TC_CODE = r"(?iU)\bTC[#:\s]+([0-9\s]{10,})"
PHONE = r"(?U)\(?\s*(\d{3})\s*\)?\D*\s*(\d{3})\D*\s*(\d{4})"
THREE_DIGITS = r"(?U)\d{3}"
DATE = r"\d{2}[/-]\d{2}[/-]\d{2,4}"
DATE_AND_TIME = r"(?U)(\d{2}[/-]\d{2}[/-]\d{2,4})\s+(\d{1,2}:\d{2}(?::\d{2})?\s?[APMapm]{0,2})"
SOLD = r"(?iU)ITEMS\s*SOLD\b"
SOLD_PART = "tem"
SOLD_COUNT = r"(?iU)(?:#\s*)?ITEMS\s*SOLD\s*[:\-]?\s*(\d+)"
SOLD_NEXT_LINE = r"(?U)\b(\d{1,3})\b"
ITEMS_COUNT = r"(?iU)\bITEMS\s+(\d{1,3})\b"

# What a lower-cased line must show for each amount.
AMOUNT_LINES = {
    "discount_meta_val": r"(?U)\bdiscount\s+given\b",
    "subtotal_meta": r"(?U)\bsub\s*tot[ai1l]\b|subtotal",
    "total_meta": r"(?U)^\s*tot[ai1l]\b|^total| total",
    "tendered_meta": r"(?U)\b(?:cash|debit|credit|card|visa|mastercard)\b",
    "change_due_meta": r"(?U)change\s*due|\bchange\b",
}
AMOUNT_HINT = r"(?i)(?=[tdcv])(?:t(?:ot|ax)|d(?:iscount|ebit)|c(?:hange|ash|redit|ard)|visa)"
NOT_TAX = r"(?U)non\s*tax|taxable"

# An item line that ends in a price, and what such a line holds.
DECIMALS = r"(?U)[.,]\d{2}"
END_PRICE = r"(?U)^(.+?)\s+(\d+[.,]\d{2})(?:\s*[A-Za-z])?$"

ITEM = "struct<line_no:int,item:string,description:string,quantity:double,unit_price:double,line_total:double>"


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def _last(array: Column) -> Column:
    return F.get(array, F.size(array) - 1)


def _over_all(rows: Column, fn) -> Column:
    """``fn(rows, row, i)`` for each row. A lambda variable over a one-element array stands for all rows, so that they
    are worked out once and not again for each row."""
    return F.flatten(F.transform(F.array(rows), lambda all_: F.transform(all_, lambda row, i: fn(all_, row, i))))


def receipt_merchant(text: Column, lines: Column) -> Column:
    """A known brand, else the first usable of the first ten lines."""

    def usable(line: Column) -> Column:
        fits = (F.length(line) >= 3) & ~line.rlike(NOT_A_MERCHANT)
        return F.when(fits, blank_to_null(merchant_text_clean(line)))

    # The first usable line ends the work on the others.
    none = F.lit(None).cast("string")
    found = F.aggregate(F.slice(lines, 1, 10), none, lambda acc, x: F.when(acc.isNotNull(), acc).otherwise(usable(x)))
    for pattern, part, brand in reversed(BRANDS):
        found = F.when(F.lower(text).contains(part) & text.rlike(pattern), F.lit(brand)).otherwise(found)
    return found


def receipt_tc_code(lines: Column) -> Column:
    """The first ``TC#`` code of the last forty lines."""
    tail = F.slice(lines, F.greatest(F.size(lines) - 39, F.lit(1)), F.lit(40))
    line = _first(F.filter(tail, lambda x: x.rlike(TC_CODE)))
    return blank_to_null(strip(collapse(F.regexp_extract(line, TC_CODE, 1))))


def phone_candidates(lines: Column) -> Column:
    """All 3-3-4 digit groups of the first forty lines with the marks they are ranked by."""

    def candidate(match: Column, line_no: Column, match_no: Column) -> Column:
        digits = F.regexp_replace(match, r"(?U)\D", "")
        area, office, number = (F.substring(digits, s, n) for s, n in ((1, 3), (4, 3), (7, 4)))
        bad = area.rlike("^[01]") | (office == "000") | (number == "0000")
        zeros = F.length(digits) - F.length(F.translate(digits, "0", ""))
        return F.struct(
            bad.alias("bad"),
            zeros.alias("zeros"),
            line_no.alias("line_no"),
            match_no.alias("match_no"),
            area.alias("area"),
            office.alias("office"),
            number.alias("number"),
        )

    def matches(line: Column) -> Column:
        found = F.regexp_extract_all(line, F.lit(PHONE), F.lit(0))
        return F.when(line.rlike(THREE_DIGITS), found).otherwise(F.array().cast("array<string>"))

    return F.flatten(
        F.transform(
            F.slice(lines, 1, 40),
            lambda line, i: F.transform(matches(line), lambda match, j: candidate(match, i, j)),
        )
    )


def best_phone(candidates: Column) -> Column:
    """The least bad candidate; no phone if even its area code starts with 0 or 1."""
    best = F.array_min(candidates)
    written = F.format_string("(%s) %s-%s", best["area"], best["office"], best["number"])
    return F.when(best.isNotNull() & ~best["area"].rlike("^[01]"), written)


def receipt_phone(lines: Column) -> Column:
    return best_phone(phone_candidates(lines))


def receipt_datetime_raw(lines: Column) -> Column:
    """Date, with the time beside it if there is one, of the last line that shows a date."""

    def shown(line: Column) -> Column:
        day, time = (F.regexp_extract(line, DATE_AND_TIME, g) for g in (1, 2))
        return F.when(day != "", strip(F.concat_ws(" ", day, time))).otherwise(F.regexp_extract(line, DATE, 0))

    return shown(_last(F.filter(lines, lambda x: x.rlike(DATE))))


def receipt_items_sold(lines: Column) -> Column:
    """Count behind ``ITEMS SOLD``, else on the next line, else behind ``ITEMS``."""

    def stated(line: Column, i: Column) -> Column:
        return F.when(
            F.lower(line).contains(SOLD_PART) & line.rlike(SOLD), F.coalesce(extract(line, SOLD_COUNT), extract(F.get(lines, i + 1), SOLD_NEXT_LINE))
        )

    known = lambda x: x.isNotNull()
    return F.coalesce(
        _first(F.filter(F.transform(lines, stated), known)),
        _first(F.filter(F.transform(lines, lambda line: extract(line, ITEMS_COUNT)), known)),
    ).try_cast("bigint")


def amount_lines(lines: Column) -> Column:
    """Lines that may state an amount: lower-cased text, first number, first percent.

    Built in stages, each naming the one before once, and only for lines with a digit and part of a keyword.
    """
    likely = F.filter(lines, lambda x: x.rlike("[0-9]") & x.rlike(AMOUNT_HINT))
    tidy = F.transform(likely, lambda x: fix_split_decimal(normalize_line(x)))
    return F.transform(
        tidy,
        lambda x: F.struct(
            F.lower(x).alias("low"),
            money_ocr(F.regexp_extract(x, NUMBER_ANY, 0)).alias("num"),
            money_ocr(F.regexp_extract(x, PERCENT_TOKEN, 1)).alias("pct"),
        ),
    )


def _first_amount(amounts: Column, pattern: str) -> Column:
    return _first(F.filter(amounts, lambda x: x["num"].isNotNull() & x["low"].rlike(pattern)))["num"]


def receipt_totals(df: DataFrame, lines: str = "lines") -> DataFrame:
    """Add the seven stated amounts: for each, the first line with its keyword *and* a number."""
    amounts = F.col("_amounts")
    tax_lines = F.col("_tax_lines")
    df = df.withColumn("_amounts", amount_lines(F.col(lines)))
    for name, pattern in AMOUNT_LINES.items():
        df = df.withColumn(name, _first_amount(amounts, pattern))
    df = df.withColumn(
        "_tax_lines", F.filter(amounts, lambda x: x["low"].contains("tax") & ~x["low"].rlike(NOT_TAX))
    )
    first_num = F.array_position(F.transform(tax_lines, lambda x: x["num"].isNotNull()), F.lit(True)).cast("int")
    seen = F.when(first_num > 0, F.slice(tax_lines, F.lit(1), first_num)).otherwise(tax_lines)
    return (
        df.withColumn("tax_meta_val", F.get(tax_lines, first_num - 1)["num"])
        .withColumn("tax_meta_pct", _last(F.filter(seen, lambda x: x["pct"].isNotNull()))["pct"] / 100)
        .drop("_amounts", "_tax_lines")
    )


def derive_totals_from_text(df: DataFrame) -> DataFrame:
    """Complete total, tax and total again from the other stated amounts, in this order."""
    subtotal, tax, total = F.col("subtotal_meta"), F.col("tax_meta_val"), F.col("total_meta")
    tendered, change = F.col("tendered_meta"), F.col("change_due_meta")
    return (
        df.withColumn("total_meta", F.coalesce(total, round2(subtotal + tax)))
        .withColumn("tax_meta_val", F.coalesce(tax, round2(total - subtotal)))
        .withColumn("total_meta", F.coalesce(total, round2(tendered - change)))
    )


def receipt_items(text: Column) -> Column:
    """Line items of a receipt text as an array.

    Three layouts are tried on each line, the first that fits wins: (A) ``qty @ unit [total]`` with a name on the
    line or on one of the two before it, (B) a name followed by a line with ``@``, (C) a line that ends in a price.
    A line used up by (B) is skipped. Such a line never starts a (B) itself: its successor aside, it would need an
    own valid name, with which it fits (A). So it is enough to look at one line before.
    """

    # Stages, each of which names the one before it once or by a lambda variable.
    def split_up(line: Column) -> Column:
        at = line.contains("@")
        priced = lambda group: F.when(line.rlike(DECIMALS), F.regexp_extract(line, END_PRICE, group)).otherwise("")
        return F.struct(
            line.alias("line"),
            ((line == "") | is_excluded_line(line)).alias("skipped"),
            at.alias("at"),
            F.when(at, F.regexp_extract_all(line, F.lit(f"({PRICE_DECIMAL})"), F.lit(1))).alias("nums"),
            priced(1).alias("priced_name"),
            priced(2).alias("price"),
        )

    def read(rows: Column, row: Column, i: Column) -> Column:
        near = row["at"] | F.get(rows, i + 1)["at"] | F.get(rows, i + 2)["at"]
        return F.struct(
            row["skipped"].alias("skipped"),
            row["at"].alias("at"),
            F.transform(row["nums"], money_ocr).alias("nums"),
            F.when(near & ~row["skipped"], item_name_of(row["line"])).alias("name"),
            F.when(row["price"] != "", item_name_of(row["priced_name"])).alias("priced_name"),
            F.when(row["price"] != "", money_ocr(row["price"])).alias("price"),
        )

    info = _over_all(F.transform(tidy_lines(text), split_up), read)

    def by_at(name: Column, nums: Column, i: Column) -> Column:
        qty, unit = F.get(nums, F.lit(0)), F.get(nums, F.lit(1))
        total = F.when(F.size(nums) >= 3, _last(nums)).otherwise(qty * unit)
        return F.struct(
            i.alias("line_no"),
            name.alias("item"),
            F.lit("").alias("description"),
            qty.alias("quantity"),
            unit.alias("unit_price"),
            round2(total).alias("line_total"),
        ).cast(ITEM)

    def pairs_with(row: Column, following: Column) -> Column:
        """Layout B, with layout A ruled out."""
        own = row["at"] & (F.size(row["nums"]) >= 2)
        return F.coalesce(
            ~row["skipped"]
            & is_valid_name(row["name"])
            & ~own
            & following["at"]
            & (F.size(following["nums"]) >= 2),
            F.lit(False),
        )

    def item(rows: Column, row: Column, i: Column) -> Column:
        before, before2, after = F.get(rows, i - 1), F.get(rows, i - 2), F.get(rows, i + 1)
        long_enough = lambda r: F.when(F.length(r["name"]) >= 3, r["name"])
        usable = lambda r: F.when(~r["skipped"] & ~r["at"], long_enough(r))
        name_a = F.coalesce(long_enough(row), usable(before), usable(before2))
        fits_a = row["at"] & (F.size(row["nums"]) >= 2) & is_valid_name(name_a)
        name_c, price = row["priced_name"], row["price"]
        single = F.struct(
            i.alias("line_no"),
            name_c.alias("item"),
            F.lit("").alias("description"),
            F.lit(1.0).alias("quantity"),
            price.alias("unit_price"),
            price.alias("line_total"),
        ).cast(ITEM)
        return (
            F.when(row["skipped"] | pairs_with(before, row), F.lit(None))
            .when(fits_a, by_at(name_a, row["nums"], i))
            .when(pairs_with(row, after), by_at(row["name"], after["nums"], i))
            .when(price.isNotNull() & is_valid_name(name_c), single)
        )

    return F.filter(_over_all(info, item), lambda x: x.isNotNull() & ~is_total_named(x["item"]))


def name_lookback(df: DataFrame, text: str = "text") -> DataFrame:
    """Each line with the nearest usable name on the two lines above it, within the document's row."""

    def read(line: Column) -> Column:
        tidy = normalize_line(line)
        skipped = (tidy == "") | is_excluded_line(tidy) | tidy.contains("@")
        return F.struct(tidy.alias("line"), F.when(~skipped, name_like(tidy)).alias("usable"))

    rows = F.col("_rows")
    above = lambda i, n: F.get(rows, i - n)["usable"]
    kept = [c for c in df.columns if c != text]
    found = F.transform(
        rows, lambda row, i: F.struct(i.alias("line_no"), row["line"].alias("line"), F.coalesce(above(i, 1), above(i, 2)).alias("name"))
    )
    return df.withColumn("_rows", F.transform(text_lines(F.col(text)), read)).select(*kept, F.inline(found))


def explode_items(df: DataFrame, items: str = "items") -> DataFrame:
    """One row per extracted item, in line order."""
    kept = [c for c in df.columns if c != items]
    return df.select(*kept, F.explode(items).alias("_item")).select(*kept, "_item.*")


def derive_totals_from_items(df: DataFrame, sum_items: Column) -> DataFrame:
    """Complete subtotal and total by the item sum and the stated discount."""
    subtotal, total, discount = F.col("subtotal_meta"), F.col("total_meta"), F.col("discount_meta_val")
    net = round2(F.greatest(sum_items - discount, F.when(discount.isNotNull(), F.lit(0.0))))
    return df.withColumn("subtotal_meta", F.coalesce(subtotal, net)).withColumn(
        "total_meta",
        F.coalesce(
            total,
            round2(subtotal + F.col("tax_meta_val")),
            round2(F.col("tendered_meta") - F.col("change_due_meta")),
            net,
        ),
    )


def exact_sum(items: Column) -> Column:
    """Sum of the line totals of an item array, added up as decimals."""
    amounts = F.transform(items, lambda x: F.coalesce(x["line_total"], F.lit(0.0)).cast("decimal(28,8)"))
    return F.aggregate(amounts, F.lit(0).cast("decimal(28,8)"), lambda acc, x: (acc + x).cast("decimal(28,8)"))


def items_sum(items: Column) -> Column:
    """The sum of an item array, rounded."""
    return F.round(exact_sum(items), 2).cast("double")


def receipt_header(df: DataFrame, text: str = "text", lines: str = "lines") -> DataFrame:
    """Add merchant, TC code, raw date, phone and the stated item count."""
    t, rows = F.col(text), F.col(lines)
    return (
        df.withColumn("merchant_name", receipt_merchant(t, rows))
        .withColumn("tc_code", receipt_tc_code(rows))
        .withColumn("txn_datetime_raw", receipt_datetime_raw(rows))
        .withColumn("phone", receipt_phone(rows))
        .withColumn("items_sold_meta", receipt_items_sold(rows))
    )


def receipt_bronze(df: DataFrame, text: str = "text") -> DataFrame:
    """Everything a receipt text tells, items included, in one pass over the text.

    Adds the metadata fields, ``items_detected`` and the ``items`` array; the text itself goes.
    """
    df = df.withColumn("lines", filled_lines(F.col(text)))
    df = receipt_totals(receipt_header(df, text))
    df = derive_totals_from_text(df.withColumn("items", receipt_items(F.col(text))))
    return derive_totals_from_items(df, items_sum(F.col("items"))).withColumn(
        "items_detected", F.size("items")
    ).drop("lines", text)
