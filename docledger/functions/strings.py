"""Name, key and identifier expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docledger.functions.dates import dmy_to_yyyymmdd, iso_to_yyyymmdd
from docledger.functions.text import blank_to_null, collapse, extract, strip, text_lines

UNKNOWN = "UNKNOWN"

# Words that show a text is a receipt.
RECEIPT_KEYWORDS = (
    "subtotal",
    "total",
    "tax",
    "change due",
    "cash tend",
    "debit tend",
    "items sold",
    "thank you",
    "manager",
    "terminal",
    "account",
    "tc#",
)

# Currency code, sign in the text, word in the lower-cased text; first hit wins.
CURRENCIES = (("EUR", "€", "eur"), ("GBP", "£", "gbp"), ("BRL", "r$", "brl"), ("USD", "$", "usd"))

# Fixed value: characters trimmed off the ends of an item name.
NAME_TRIM = " .-:|,"


def normalize_path(c: Column) -> Column:
    return F.translate(c, "\\", "/")


def path_stem(c: Column) -> Column:
    """File name without its last suffix."""
    return extract(c, r"([^/]+?)(?:\.[^./]*)?/*$")


def safe_stem(c: Column) -> Column:
    """File stem that is safe as a folder name."""
    return F.coalesce(blank_to_null(F.regexp_replace(F.lower(path_stem(c)), r"[^a-z0-9_\-]+", "-")), F.lit("doc"))


def text_sample(c: Column, n: int = 120) -> Column:
    """First ``n`` lines; kept beside the metadata only, extraction itself reads the whole text."""
    return F.array_join(F.slice(text_lines(c), 1, n), "\n")


def sanitize_id(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), r"[^A-Z0-9\-]+", "")


def first_token_with_digit(c: Column) -> Column:
    return extract(F.upper(c), r"([A-Z0-9\-]*[0-9][A-Z0-9\-]*)")


def clean_party_name(c: Column) -> Column:
    """Drop a leading ``invoice #:`` and a leading number."""
    t = F.regexp_replace(c, r"(?iU)^\s*invoice\s*#?\s*:?\s*", "")
    return strip(collapse(F.regexp_replace(t, r"(?U)^\s*\d+\s+", "")))


def vendor_slug8(c: Column) -> Column:
    slug = F.substring(F.regexp_replace(F.upper(c), r"[^A-Z0-9]", ""), 1, 8)
    return F.coalesce(blank_to_null(slug), F.lit(UNKNOWN))


def hash12(*parts: Column) -> Column:
    """Twelve hex digits that identify the non-empty parts."""
    kept = F.filter(F.array(*[p.cast("string") for p in parts]), lambda p: p.isNotNull() & (p != ""))
    return F.upper(F.substring(F.sha1(F.array_join(F.transform(kept, strip), "|")), 1, 12))


def invoice_document_id(number_raw: Column, supplier: Column, client: Column, date_raw: Column, path: Column) -> Column:
    """``VENDOR8-number[-yyyymmdd]``, or a hash of stem, vendor and date without a number."""
    party = blank_to_null(clean_party_name(F.coalesce(blank_to_null(supplier), client)))
    slug = vendor_slug8(F.coalesce(party, strip(client)))
    number = first_token_with_digit(number_raw)
    day = dmy_to_yyyymmdd(date_raw)
    stem = path_stem(F.coalesce(blank_to_null(path), F.lit("unknown")))
    tail = F.when(number.isNotNull(), F.concat_ws("-", number, day)).otherwise(hash12(stem, slug, day))
    return sanitize_id(F.concat_ws("-", slug, tail))


def receipt_document_id(merchant: Column, stem: Column, txn_date: Column) -> Column:
    """``VENDOR8-stem-yyyymmdd`` with ``NA`` for what is missing."""
    return F.concat_ws("-", vendor_slug8(merchant), F.coalesce(blank_to_null(stem), F.lit("NA")), iso_to_yyyymmdd(txn_date))


def supplier_from_number_line(c: Column) -> Column:
    """Text after the number in a line such as ``1 Some Company``."""
    t = strip(F.regexp_replace(c, r"(?iU)^\s*invoice\s*(?:no\.?|number|#)\s*[:#]?\s*", ""))
    return blank_to_null(strip(collapse(F.regexp_extract(t, r"(?U)^\s*\S+\s+(.+)$", 1))))


def supplier_fallback(bill_from: Column, number_raw: Column, client: Column) -> Column:
    return F.coalesce(
        blank_to_null(clean_party_name(bill_from)),
        supplier_from_number_line(number_raw),
        blank_to_null(clean_party_name(client)),
    )


def normalize_merchant(c: Column) -> Column:
    return blank_to_null(F.upper(strip(collapse(F.regexp_replace(c, r"(?U)[^A-Za-z0-9\s\-&'.]", " ")))))


def document_number_token(c: Column) -> Column:
    """Joined leading digits, else the leading token, else the first token of two characters."""
    token = r"([A-Za-z0-9][A-Za-z0-9\-]{1,80})"
    digits = F.regexp_replace(F.regexp_extract(c, r"(?U)^\s*([0-9][0-9\-\s]{0,80})", 1), r"(?U)[\s\-]", "")
    digits = F.when(F.length(digits) <= 40, blank_to_null(digits))
    return F.upper(F.coalesce(digits, extract(c, rf"(?U)^\s*{token}"), extract(c, token)))


def detect_currency(c: Column) -> Column:
    found = F.lit(UNKNOWN)
    for code, sign, word in reversed(CURRENCIES):
        shown = c.rlike(rf"(?iU){re.escape(sign)}|\b{word}\b")
        found = F.when(shown, F.lit(code)).otherwise(found)
    return found


def default_currency(c: Column, default: str = "USD") -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


# Fixed value: names that need no tidying.
TIDY_NAME = r"\A(?!.*  )[A-Za-z'/&][A-Za-z '/&\-]*+(?<=[A-Za-z'/&])\z"


def item_name(c: Column) -> Column:
    """Letters and ``-'/&`` of a receipt line, tidied."""
    letters = F.regexp_replace(c, r"(?U)[^A-Za-z\s\-'/&]", " ")
    return F.btrim(collapse(strip(letters), 2), F.lit(NAME_TRIM))


def item_name_of(x: Column) -> Column:
    """:func:`item_name` of a value that is cheap to name several times, as a lambda variable or its field."""
    return F.when(x.rlike(TIDY_NAME), x).otherwise(item_name(x))


def name_like(c: Column) -> Column:
    name = item_name(c)
    return F.when(F.length(name) >= 3, name)


def keyword_score(c: Column) -> Column:
    """How many of the receipt words occur."""
    low = F.lower(c)
    score = F.lit(0)
    for word in RECEIPT_KEYWORDS:
        score = score + low.contains(word).cast("int")
    return score


def merchant_text_clean(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"[^A-Za-z0-9 '&\-/.]", ""))


def line_key(c: Column) -> Column:
    """Key under which two OCR lines count as the same."""
    return F.lower(collapse(strip(c)))


def normalize_line(c: Column) -> Column:
    return collapse(strip(c), 2)
