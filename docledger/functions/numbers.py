"""Number, money, quantity and percent parsing and formatting."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from docledger.functions.text import strip

MONEY = "decimal(18,2)"
PERCENT = "decimal(9,4)"

# The number grammars of the extraction rules.
# Underscores stand between digits only. No group repeats: Java's matcher would recurse once for each of its turns.
FLOAT_TEXT = (
    r"(?Us)^(?!.*_(?!\d))\s*+([+-]?+(?:\d[\d_]*+(?:\.(?:\d[\d_]*+)?+)?+|\.\d[\d_]*+)(?:[eE][+-]?+\d[\d_]*+)?+)\s*+$"
)
NUMBER_ANY = r"[+-]?(?:\d{1,3}(?:[.,]\d{3})*(?:[.,]\d{2})|\d+(?:[.,]\d{2})|\d+)"
MONEY_TOKEN = r"\$?\d{1,3}(?:,\d{3})*(?:\.\d{2})"
PLAIN_NUMBER = r"\b\d+(?:\.\d+)?\b"
PRICE_DECIMAL = r"\d+[.,]\d{2}"
PERCENT_TOKEN = r"(\d{1,2}[.,]?\d{0,2})\s*%+"


def exact(value: float) -> Column:
    """A threshold as the decimal it was written as."""
    return F.lit(Decimal(str(value)))


# The parsers below name their input only once: inside a lambda nothing else keeps it from being worked out again.


def to_number_or_null(c: Column) -> Column:
    """Decimal or scientific text as double, anything else null (never NaN or infinity).

    Text that does not fit is null before the cast: an empty text there costs a caught exception a row.
    """
    fitting = F.get(F.regexp_extract_all(c.cast("string"), F.lit(FLOAT_TEXT), F.lit(1)), F.lit(0))
    return F.translate(fitting, "_", "").try_cast("double")


def money_invoice(c: Column) -> Column:
    """Keep digits, separators and minus; with both separators commas go, a lone comma is the decimal point."""
    t = F.regexp_replace(c.cast("string"), r"[^\d,.\-]", "")
    return to_number_or_null(F.when(t.contains("."), F.translate(t, ",", "")).otherwise(F.translate(t, ",", ".")))


# All dots if the last separator is a comma, all commas if it is a dot.
GROUPING = r"\.(?=.*,[^.]*$)|,(?=.*\.[^,]*$)"


def _later_separator_is_decimal(t: Column) -> Column:
    return to_number_or_null(F.translate(F.regexp_replace(t, GROUPING, ""), ",", "."))


def money_ocr(c: Column) -> Column:
    """Drop currency signs (``R`` included) and blanks; the later separator is the decimal point."""
    return _later_separator_is_decimal(F.translate(strip(c.cast("string")), "$€£R ", ""))


def money_silver(c: Column) -> Column:
    """As :func:`money_ocr`, but a currency sign makes the value unreadable."""
    return _later_separator_is_decimal(F.translate(strip(c.cast("string")), " ", ""))


def int_lenient(c: Column) -> Column:
    """Number text truncated towards zero."""
    return to_number_or_null(c).try_cast("bigint")


def tax_percent(c: Column) -> Column:
    """``6%``, ``6,00%`` or a fraction as percent; sizes up to 1 count as fractions."""
    v = to_number_or_null(F.translate(c.cast("string"), ",%", "."))
    return F.when(F.abs(v) <= 1, v * 100).otherwise(v)


def quantity_or_zero(c: Column) -> Column:
    return F.coalesce(money_silver(c), F.lit(0.0))


def fix_split_decimal(c: Column) -> Column:
    """Re-join a number that OCR split before its decimals: ``38 .68``."""
    return F.regexp_replace(c, r"(?U)(\d)\s+([.,]\d{2})", "$1$2")


def round2(c: Column) -> Column:
    """Two decimals, ties away from zero, by way of decimal so that binary noise does not decide."""
    return F.round(c.try_cast("decimal(28,8)"), 2).cast("double")


def clamp_negative_to_zero(c: Column) -> Column:
    zero = F.lit(0.0)
    return F.greatest(F.coalesce(c, zero), zero)


def fmt_money(c: Column) -> Column:
    return F.coalesce(F.format_number(c, 2), F.lit(""))


def fmt_pct(c: Column) -> Column:
    return F.coalesce(F.concat(F.round(c.cast("decimal(28,8)"), 2).cast("decimal(28,2)").cast("string"), F.lit("%")), F.lit(""))
