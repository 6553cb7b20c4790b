"""Row classifiers for table rows and receipt lines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of header and billing rows.
META_WORDS = (
    "invoice",
    "invoice #",
    "invoice no",
    "invoice number",
    "invoice date",
    "po #",
    "purchase order",
    "due date",
    "bill to",
    "bill from",
    "email",
    "@",
    "phone",
    "tel",
    "address",
)

# Words of summary rows.
SUMMARY_WORDS = ("subtotal", "tax", "amount due", "total:")

# Fixed value: receipt lines that cannot be items, by first letter: SUBTOTAL, TOTAL, TAX, DISCOUNT, GIVEN, CASH, DEBIT, CARD,
# CHANGE, # ITEMS SOLD, MANAGER, MGR, SURVEY, THANK, APPROVAL, ACCOUNT, TERMINAL, APPR, TC#, OP#, TE#, TR#, ST#.
EXCLUDED_LINE = (
    r"(?i)(?=[#acdgmost])(?:t(?:otal|ax|hank|erminal|[cer]#)|s(?:urvey|t#)|c(?:ash|ard|hange)|d(?:iscount|ebit)|given|"
    r"m(?:anager|gr)|a(?:ppr|ccount)|op#|#\s*items\s*sold)"
)


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    """The text holds one of the words in any case of ASCII letters; null text holds none.

    Lower case and plain search are far cheaper than a pattern without case. They tell the same: the only other characters
    whose lower case holds an ASCII letter are the Kelvin sign (k) and the dotted capital I (i and a dot above).
    """
    if any("k" in w or w.endswith("i") or not w.isascii() or w != w.lower() for w in words):
        return F.coalesce(c.rlike("(?i)" + "|".join(re.escape(w) for w in words)), F.lit(False))
    return holds_any(F.lower(c), words)


def holds_any(low: Column, words: tuple[str, ...]) -> Column:
    """The text, which is in lower case, holds one of the words; null text holds none."""
    # A word that holds another of them adds nothing.
    least = [w for w in dict.fromkeys(words) if not any(v != w and v in w for v in words)]
    found = F.lit(False)
    for w in least:
        found = found | low.contains(w)
    return F.coalesce(found, F.lit(False))


def is_meta_row(c: Column) -> Column:
    return contains_any(c, META_WORDS)


def is_summary_row(c: Column) -> Column:
    return contains_any(c, SUMMARY_WORDS)


def is_excluded_line(c: Column) -> Column:
    return c.rlike(EXCLUDED_LINE)


def is_valid_name(c: Column) -> Column:
    return c.rlike(r"[A-Za-z]{3,}")


def is_total_named(c: Column) -> Column:
    return c.rlike(r"(?i)SUBTOTAL|TOTAL|TAX")


def is_noise_item(item: Column, description: Column, *numbers: Column) -> Column:
    """Summary row, or a row without any text and without any number."""
    no_text = (F.coalesce(item, F.lit("")) == "") & (F.coalesce(description, F.lit("")) == "")
    no_numbers = F.lit(True)
    for n in numbers:
        no_numbers = no_numbers & n.isNull()
    return is_summary_row(item) | is_summary_row(description) | (no_text & no_numbers)


def is_distinct_from(c: Column, value) -> Column:
    """Null-safe inequality: null differs from every value."""
    return ~c.eqNullSafe(F.lit(value))
