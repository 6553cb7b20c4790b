"""Line items from detected table cells: rows ``(doc_id, table_no, row_no, cells)``.

Row order matters here, so positions and neighbours come from :mod:`docledger.operators.positions`; what one table
tells about itself (its header row, its score) is grouped with partial aggregates. Per-table results are joined back
on ``(doc_id, table_no, _bucket)``, so a table that holds a large part of all rows still spreads over many tasks. Where
every table is one bucket, windows over the rows as they lie give the same without another exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions.numbers import MONEY_TOKEN, PLAIN_NUMBER, money_invoice, to_number_or_null
from docledger.functions.predicates import contains_any, holds_any, is_meta_row, is_noise_item, is_summary_row
from docledger.functions.text import collapse, strip
from docledger.operators.lineage import stored, write_once
from docledger.operators.positions import beyond_first, bucket_of, consumed, number_rows, one_bucket

TABLE = ["doc_id", "table_no"]
PART = [*TABLE, "_bucket"]
SCAN_ROWS = 60

# Words that name a target column, in order of preference.
HEADER_WORDS = {
    "item": ("item", "item name", "product", "code"),
    "description": ("description", "desc", "details"),
    "quantity": ("qty", "quantity", "amount"),
    "unit_price": ("unit price", "price", "rate"),
    "line_total": ("total", "amount"),
}
NUMBERS = ("quantity", "unit_price", "line_total")


def row_text(cells: Column) -> Column:
    return F.array_join(cells, " ", "")


def drop_all_null_rows(df: DataFrame, cells: str = "cells") -> DataFrame:
    return df.where(F.exists(cells, lambda x: x.isNotNull()))


def several_buckets(cells: DataFrame) -> bool:
    """Whether any row lies beyond its table's first bucket."""
    return beyond_first(cells, bucket_of(F.col("row_no")))


def table_rows(cells: DataFrame, several: bool = True) -> DataFrame:
    """Non-empty rows with their dense position ``pos`` and the cells of the row after them.

    ``several`` is what :func:`several_buckets` tells of these cells, or of more; true holds for all.
    """
    bucket = bucket_of(F.col("row_no"))
    return number_rows(drop_all_null_rows(cells), TABLE, ["row_no"], bucket, look_ahead="cells", several=several)


def header_score(low: Column) -> Column:
    """In how many of the five word groups the text, in lower case, has a hit."""
    score = F.lit(0)
    for words in HEADER_WORDS.values():
        score = score + holds_any(low, words).cast("int")
    return score


def _scored(rows: DataFrame) -> DataFrame:
    """Rows with what they are worth as a header: ``_scored`` for the first rows with two hits, ``_fallback`` for headings.

    What a row holds, the row with the one below it holds too, so rows without two hits in both are not looked at alone.
    Names and target columns are made for these rows only, and travel with the score.
    """
    cells, next_cells = F.col("cells"), F.col("next_cells")
    low, both = F.col("_low"), F.col("_both")
    # Texts and scores are columns of their own, so that no branch works them out again.
    scored = (
        rows.withColumn("_low", F.lower(row_text(cells)))
        .withColumn("_below", F.when(F.col("has_next"), F.lower(row_text(next_cells))))
        .withColumn("_both", F.concat_ws(" ", "_low", "_below"))
        .withColumn("_score", F.when(F.col("pos") <= SCAN_ROWS, header_score(both)))
        .withColumn("_two", F.when(F.col("_score") >= 2, F.col("has_next") & (F.col("_score") > header_score(low))))
    )
    item_and_description = holds_any(low, ("item",)) & holds_any(low, ("description",))
    heading = F.col("has_next") & (item_and_description | holds_any(low, ("item name",)))
    below = holds_any(F.col("_below"), ("price", "rate", "qty", "quantity"))
    by_score = F.struct(
        F.col("_score").alias("score"), (-F.col("pos")).alias("neg"), F.col("_two").alias("two"), _named(cells, next_cells, F.col("_two"))
    )
    by_words = F.struct(F.col("pos").alias("pos"), F.col("_two").alias("two"), _named(cells, next_cells, F.col("_two")))
    return (
        scored.withColumn("_scored", F.when(F.col("_two").isNotNull(), by_score))
        .withColumn("_two", F.when(heading, below))
        .withColumn("_fallback", F.when(F.col("_two").isNotNull(), by_words))
        .drop("_low", "_below", "_both", "_score", "_two")
    )


def _named(cells: Column, next_cells: Column, two_rows: Column) -> Column:
    """Names of a header as ``named.header``, with the target columns found among them as ``named.columns``."""
    return _let(
        header_names(cells, next_cells, two_rows), lambda names: F.struct(names.alias("header"), target_columns(names).alias("columns"))
    ).alias("named")


def _header(b: Column, f: Column) -> dict[str, Column]:
    """The header's place, names and target columns from the best scored row ``b`` and the first heading ``f``."""
    good = b.isNotNull()
    chosen = lambda name: F.when(good, b[name]).otherwise(f[name])
    return {
        "header_pos": F.when(good, -b["neg"]).otherwise(f["pos"]),
        "two_rows": chosen("two"),
        "named": chosen("named"),
    }


def _found_headers(rows: DataFrame) -> DataFrame:
    """Header of each table that has one; ``named`` as in :func:`_named`.

    The best scored of the first rows, alone or with its successor; below two hits the first row that looks like
    a heading. The winner's names travel with its score through the aggregate, so rows are read only once.
    """
    best = (
        _scored(rows)
        .select(*PART, "_scored", "_fallback")
        .groupBy(*TABLE)
        .agg(F.max("_scored").alias("b"), F.min("_fallback").alias("f"), F.max("_bucket").alias("last_bucket"))
    )
    found = _header(F.col("b"), F.col("f"))
    return best.select(*TABLE, *[c.alias(name) for name, c in found.items()], "last_bucket").where(F.col("header_pos").isNotNull())


def detect_header_row(rows: DataFrame) -> DataFrame:
    """Header of each table that has one: ``(doc_id, table_no, header_pos, two_rows, header, last_bucket)``."""
    return _found_headers(rows).select(*TABLE, "header_pos", "two_rows", F.col("named.header").alias("header"), "last_bucket")


def _headed(rows: DataFrame) -> DataFrame:
    """Rows of tables of one bucket each with ``header``, ``_columns`` and ``_last_header_pos``, null where a table has no
    header, and ``last_bucket``."""
    table = Window.partitionBy(*PART)
    found = _header(F.col("_b"), F.col("_f"))
    known = F.lit(True)
    for name in PART:
        known = known & F.col(name).isNotNull()
    return (
        _scored(rows)
        .withColumn("_b", F.max("_scored").over(table))
        .withColumn("_f", F.min("_fallback").over(table))
        .withColumn("_last_header_pos", F.when(known, found["header_pos"] + found["two_rows"].cast("int")))
        .withColumn("_named", F.when(known, found["named"]))
        .withColumn("header", F.col("_named.header"))
        .withColumn("_columns", F.col("_named.columns"))
        .withColumn("last_bucket", F.col("_bucket"))
        .drop("_scored", "_fallback", "_b", "_f", "_named")
    )


def header_names(cells: Column, next_cells: Column, two_rows: Column) -> Column:
    """Name per cell: the header row's own text, else that of the row below."""
    tidy = lambda c: strip(collapse(F.coalesce(c, F.lit(""))))
    merged = F.transform(
        cells, lambda c, i: F.when(tidy(c) != "", tidy(c)).otherwise(tidy(F.get(next_cells, i)))
    )
    return F.when(two_rows, merged).otherwise(F.transform(cells, tidy))


def apply_header(rows: DataFrame) -> DataFrame:
    """Data rows with the column names of their table in ``header`` and the target columns in ``_columns``; the header rows go.

    A header is one row per table. It is repeated for each of the table's buckets and joined on those; tables of one bucket
    need no join.
    """
    if one_bucket(rows):
        return _headed(rows).where(F.col("pos") > F.col("_last_header_pos")).drop("_last_header_pos")
    headers = _found_headers(rows).select(
        *TABLE,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last_bucket"))).alias("_bucket"),
        (F.col("header_pos") + F.col("two_rows").cast("int")).alias("_last_header_pos"),
        "last_bucket",
        "named.header",
        F.col("named.columns").alias("_columns"),
    )
    return rows.join(headers, PART).where(F.col("pos") > F.col("_last_header_pos")).drop("_last_header_pos")


def _places(low: Column) -> list[Column]:
    """The cell index of each target column among lower-case names: its first candidate name present."""
    place = lambda words: F.coalesce(*[F.nullif(F.array_position(low, F.lit(w)), F.lit(0).cast("bigint")) for w in words])
    return [(place(words) - 1).cast("int").alias(f"{target}_at") for target, words in HEADER_WORDS.items()]


def target_columns(names: Column) -> Column:
    """Cell indexes of the target columns as one value."""
    return _let(F.transform(names, F.lower), lambda low: F.struct(*_places(low)))


def map_columns(df: DataFrame) -> DataFrame:
    """Add the cell index of each target column: its first candidate name present, by exact name, any case.

    Rows of :func:`apply_header` bring what was found once for their table.
    """
    targets = [f"{target}_at" for target in HEADER_WORDS]
    if "_columns" in df.columns:
        return df.withColumns({name: F.col(f"_columns.{name}") for name in targets}).drop("_columns")
    low = F.col("_low")
    return df.withColumn("_low", F.transform(F.col("header"), F.lower)).withColumns(dict(zip(targets, _places(low), strict=True))).drop("_low")


def header_table_to_items(rows: DataFrame) -> DataFrame:
    """Typed items of the tables with a header; noise dropped, missing totals filled."""
    return _header_items(rows if one_bucket(rows) else write_once(rows)).drop("last_bucket")


def _typed(mapped: DataFrame, *kept: str) -> DataFrame:
    cell = lambda target: F.get(F.col("cells"), F.col(f"{target}_at"))
    return mapped.select(
        *PART,
        "last_bucket",
        "pos",
        F.coalesce(strip(cell("item")), F.lit("")).alias("item"),
        F.coalesce(strip(cell("description")), F.lit("")).alias("description"),
        to_number_or_null(cell("quantity")).alias("quantity"),
        money_invoice(cell("unit_price")).alias("unit_price"),
        money_invoice(cell("line_total")).alias("line_total"),
        *kept,
    )


def _header_items(rows: DataFrame) -> DataFrame:
    return _clean_items(_typed(map_columns(apply_header(rows))))


def _both_parses(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items by header, and the rows of tables whose header parse has no number; of tables of one bucket each.

    Rows are numbered once and written once: cells stay only with the rows that are read again.
    """
    body = F.col("pos") > F.col("_last_header_pos")
    mapped = map_columns(_headed(rows).withColumn("_body", F.coalesce(body, F.lit(False))))
    items = _typed(mapped, "_body", "_multi", "cells", "next_cells", "has_next")
    kept = items.withColumn("_item", F.col("_body") & ~_is_noise()).withColumn("line_total", _filled_total())
    strong = F.max(F.col("_item") & (numeric_cells() > 0)).over(Window.partitionBy(*PART))
    marked = kept.withColumn("_strong", strong).where(F.col("_item") | ~F.col("_strong"))
    fields = ("item", "description", *NUMBERS)
    read_again = [F.when(~F.col("_strong"), F.col(n)).alias(n) for n in ("cells", "next_cells")]
    written = stored(marked.select(*PART, "last_bucket", "pos", *fields, "_multi", "has_next", "_item", "_strong", *read_again))
    by_header = written.where("_item").select(*PART, "last_bucket", "pos", *fields)
    weak = written.where(~F.col("_strong")).select(*PART, "pos", "_multi", "has_next", "cells", "next_cells")
    return by_header, weak


def _is_noise() -> Column:
    return is_noise_item(F.col("item"), F.col("description"), *[F.col(n) for n in NUMBERS])


def _filled_total() -> Column:
    return F.coalesce("line_total", F.col("unit_price") * F.col("quantity"))


def _clean_items(items: DataFrame) -> DataFrame:
    # Behind a generator, a filter on the verdict does not work out again all fields that the verdict is made of.
    judged = items.withColumn("_verdict", _is_noise()).select(*items.columns, F.explode(F.array("_verdict")).alias("_noise"))
    return judged.where(~F.col("_noise")).drop("_noise").withColumn("line_total", _filled_total())


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _gaps(tokens: Column, between: Column) -> Column:
    """Matches with their lengths and those of the texts before them; there is one more text between than there are matches."""
    pairs = F.arrays_zip(tokens.alias("tok"), F.slice(between, F.lit(1), F.size(tokens)).alias("between"))
    return F.transform(pairs, lambda x: F.struct(x["tok"].alias("tok"), F.length(x["between"]).alias("gap"), F.length(x["tok"]).alias("size")))


def number_beside_money(numbers: Column, money: Column, first_end: Column, last_start: Column) -> Column:
    """Of the ``numbers`` that do not lie inside a match of ``money``, the first between ``first_end`` and ``last_start``, else
    the first from ``first_end`` on, else the first. Both are arrays of :func:`_gaps`.

    One walk along both in text order: each step goes past a number or past a money match that ends before it. The state is a
    few offsets and the three candidates, which Spark copies at each step; the arrays stay columns of the row. So the work is
    linear in the matches.
    """
    none, zero = F.lit(None).cast("string"), F.lit(0)
    begin = F.struct(
        zero.alias("i"), zero.alias("j"), zero.alias("n_at"), zero.alias("m_at"), none.alias("between"), none.alias("right"), none.alias("any")
    )

    def step(acc: Column, _: Column) -> Column:
        number, match = F.get(numbers, acc["i"]), F.get(money, acc["j"])
        start, m_start = acc["n_at"] + number["gap"], acc["m_at"] + match["gap"]
        here = F.struct(
            number["tok"].alias("tok"), start.alias("s"), (start + number["size"]).alias("e"),
            m_start.alias("ms"), (m_start + match["size"]).alias("me"),
        )

        def move(x: Column) -> Column:
            past_money = F.coalesce(x["me"] < x["e"], F.lit(False))
            free = ~past_money & ~F.coalesce(x["ms"] <= x["s"], F.lit(False))
            right = free & (x["s"] >= first_end)
            take = lambda name, cond: F.when(acc[name].isNull() & cond, x["tok"]).otherwise(acc[name]).alias(name)
            return F.struct(
                F.when(past_money, acc["i"]).otherwise(acc["i"] + 1).alias("i"),
                F.when(past_money, acc["j"] + 1).otherwise(acc["j"]).alias("j"),
                F.when(past_money, acc["n_at"]).otherwise(F.coalesce(x["e"], acc["n_at"])).alias("n_at"),
                F.when(past_money, x["me"]).otherwise(acc["m_at"]).alias("m_at"),
                take("between", right & (x["e"] <= last_start)),
                take("right", right),
                take("any", free),
            )

        return _let(here, move)

    steps = F.when(F.size(numbers) > 0, F.sequence(F.lit(1), F.size(numbers) + F.size(money)))
    return F.aggregate(steps, begin, step, lambda acc: F.coalesce(acc["between"], acc["right"], acc["any"]))


def same_line_numbers(df: DataFrame, text: str) -> DataFrame:
    """Add ``unit_price``, ``quantity`` and ``line_total`` as they stand in one row's text.

    First money token, last money token if there are two, and a plain number outside of money: between the two,
    else right of the first, else any. Matches and the texts between them are columns, worked out once a row.
    """
    t = F.col(text)
    tokens, gaps = F.col("_money_tokens"), F.col("_money_between")
    two = F.size(tokens) >= 2
    first, last = F.get(tokens, F.lit(0)), F.get(tokens, F.size(tokens) - 1)
    empty = F.array().cast("array<string>")
    has_money = t.rlike(MONEY_TOKEN)
    for name, pattern in (("_money", MONEY_TOKEN), ("_nums", PLAIN_NUMBER)):
        matches = F.regexp_extract_all(t, F.lit(f"({pattern})"), F.lit(1))
        df = df.withColumn(f"{name}_tokens", F.when(has_money, matches).otherwise(empty)).withColumn(
            f"{name}_between", F.when(has_money, F.split(t, pattern, -1)).otherwise(empty)
        )
    first_end = F.length(F.get(gaps, F.lit(0))) + F.length(first)
    last_start = F.when(two, F.length(t) - F.length(F.get(gaps, F.size(tokens))) - F.length(last))
    parts = [f"{name}_{part}" for name in ("_money", "_nums") for part in ("tokens", "between")]
    return (
        df.withColumn("_money", _gaps(tokens, gaps))
        .withColumn("_nums", _gaps(F.col("_nums_tokens"), F.col("_nums_between")))
        .withColumn("_first_end", first_end)
        .withColumn("_last_start", last_start)
        .withColumn("_chosen", number_beside_money(F.col("_nums"), F.col("_money"), F.col("_first_end"), F.col("_last_start")))
        .withColumn("unit_price", money_invoice(first))
        .withColumn("quantity", to_number_or_null(F.col("_chosen")))
        .withColumn("line_total", F.when(two, money_invoice(last)))
        .drop("_money", "_nums", "_first_end", "_last_start", "_chosen", *parts)
    )


def line_pairs_to_items(rows: DataFrame) -> DataFrame:
    """Items of tables without a usable header; numbers missing in a row come from the row below, which is then used up."""
    text = strip(row_text(F.col("cells")))
    following = strip(row_text(F.col("next_cells")))
    item = F.coalesce(strip(F.get("cells", F.lit(0))), F.lit(""))
    description = F.coalesce(strip(F.get("cells", F.lit(1))), F.lit(""))
    df = same_line_numbers(
        rows.withColumn("_text", text)
        .withColumn("_below", F.when(F.col("has_next"), following))
        .withColumn("item", item)
        .withColumn("description", description)
        .drop("cells", "next_cells"),
        "_text",
    )
    skipped = is_meta_row(F.col("_text")) | (
        contains_any(F.col("_text"), ("item",)) & contains_any(F.col("_text"), ("description",))
    )
    for name in ("item", "description"):
        skipped = skipped | is_meta_row(F.col(name)) | is_summary_row(F.col(name))
    incomplete = F.col("quantity").isNull() | F.col("line_total").isNull()
    usable = ~F.col("_skipped") & incomplete & F.col("has_next") & ~is_meta_row(F.col("_below"))
    matches = lambda p: F.regexp_extract_all("_below", F.lit(f"({p})"), F.lit(1))
    df = (
        df.withColumn("_skipped", skipped)
        .withColumn("_usable", usable)
        .withColumn("_money", F.when(F.col("_usable"), F.get(matches(MONEY_TOKEN), F.lit(0))))
        .withColumn(
            "_num",
            F.when(
                F.col("_usable"), F.get(F.filter(matches(PLAIN_NUMBER), lambda n: ~n.rlike(MONEY_TOKEN)), F.lit(0))
            ),
        )
        .withColumn("_takes", F.col("_money").isNotNull() | F.col("_num").isNotNull())
        .drop("_text", "_below", "_usable")
    )
    df = consumed(df, TABLE, "pos", F.col("_takes"))
    items = df.where(~F.col("_skipped") & ~F.col("consumed")).select(
        *PART,
        "pos",
        "item",
        "description",
        F.coalesce("quantity", to_number_or_null(F.col("_num"))).alias("quantity"),
        "unit_price",
        F.coalesce("line_total", money_invoice(F.col("_money"))).alias("line_total"),
    )
    return _clean_items(items)


def numeric_cells() -> Column:
    count = F.lit(0)
    for name in NUMBERS:
        count = count + F.col(name).isNotNull().cast("int")
    return count


def score_numeric(candidates: DataFrame) -> DataFrame:
    """Rows and filled number cells of each parse of each table."""
    return candidates.groupBy(*TABLE, "path").agg(
        F.sum(numeric_cells()).alias("numeric_cells"), F.count(F.lit(1)).alias("rows")
    )


def union_candidates(rows: DataFrame) -> DataFrame:
    """Both parses, told apart by ``path``. The pairs parse is made only of tables whose header parse has no number.

    Both parses have several consumers (that choice, the scores, the result), so each is written once.
    """
    if one_bucket(rows):
        by_header, weak = _both_parses(rows)
        by_pairs = stored(line_pairs_to_items(weak))
        return _candidates(by_header, by_pairs)
    by_header = write_once(_header_items(rows))
    strong = (
        by_header.groupBy(*TABLE)
        .agg(F.max("last_bucket").alias("last_bucket"), F.max(numeric_cells()).alias("numeric_cells"))
        .where(F.col("numeric_cells") > 0)
        .select(*TABLE, F.explode(F.sequence(F.lit(0).cast("bigint"), "last_bucket")).alias("_bucket"))
    )
    by_pairs = write_once(line_pairs_to_items(rows.join(strong, PART, "left_anti")))
    return _candidates(by_header, by_pairs)


def _candidates(by_header: DataFrame, by_pairs: DataFrame) -> DataFrame:
    return (
        by_header.drop("last_bucket")
        .withColumn("path", F.lit("header"))
        .unionByName(by_pairs.withColumn("path", F.lit("pairs")))
    )


def best_candidate(scores: DataFrame) -> DataFrame:
    """Best parse of a document: most number cells, then most rows, then first table.

    Pairs have to be strictly better than the header parse of the same table.
    """
    is_header = F.col("path") == "header"
    pick = lambda cond, name: F.coalesce(F.max(F.when(cond, F.col(name))), F.lit(0))
    per_table = scores.groupBy(*TABLE).agg(
        pick(is_header, "numeric_cells").alias("hn"),
        pick(is_header, "rows").alias("hr"),
        pick(~is_header, "numeric_cells").alias("pn"),
        pick(~is_header, "rows").alias("pr"),
    )
    pairs = (F.col("hn") == 0) & ((F.col("pn") > 0) | (F.col("pr") > F.col("hr")))
    choice = F.struct(
        F.when(pairs, F.col("pn")).otherwise(F.col("hn")).alias("numeric_cells"),
        F.when(pairs, F.col("pr")).otherwise(F.col("hr")).alias("rows"),
        (-F.col("table_no")).alias("neg"),
        pairs.alias("pairs"),
    )
    return (
        per_table.groupBy("doc_id")
        .agg(F.max(choice).alias("best"))
        .select(
            "doc_id",
            (-F.col("best.neg")).alias("table_no"),
            F.when(F.col("best.pairs"), "pairs").otherwise("header").alias("path"),
            F.col("best.numeric_cells").alias("numeric_cells"),
            F.col("best.rows").alias("rows"),
        )
    )


def choose_items(cells: DataFrame, several: bool | None = None) -> DataFrame:
    """Items of the best parse of the best table of each document; ``several`` as in :func:`table_rows`, looked up if it is
    not given."""
    rows = table_rows(cells, several_buckets(cells) if several is None else several)
    # The header search, the header's rows and the pairs all read the rows: they are numbered once, and stay dealt by bucket.
    candidates = union_candidates(rows if one_bucket(rows) else write_once(rows))
    per_bucket = candidates.groupBy(*PART, "path").agg(
        F.sum(numeric_cells()).alias("numeric_cells"), F.count(F.lit(1)).alias("rows")
    )
    scores = per_bucket.groupBy(*TABLE, "path").agg(
        F.sum("numeric_cells").alias("numeric_cells"), F.sum("rows").alias("rows")
    )
    won = per_bucket.select(*PART, "path").join(
        best_candidate(scores).select("doc_id", "table_no", "path"), [*TABLE, "path"]
    )
    return candidates.join(won, [*PART, "path"], "left_semi").drop("_bucket", "path")
