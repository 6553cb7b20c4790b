"""Whitespace and line helpers with the Unicode rules the document texts need.

Java's plain ``\\s`` and ``trim`` are ASCII only, so no-break spaces from OCR would survive them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character sequence that ends a line.
# It begins with one class of characters, so that a search passes all others by one look each.
LINE_BREAK = r"[\n\x0B\f\r\x1C-\x1E\x85\u2028\u2029](?:(?<=\r)\n)?+"

# Unicode whitespace as a character class (under the U flag) and as the characters it stands for.
WS = r"[\s\x1C-\x1F]"
WS_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


# Texts with whitespace at an end, and these or texts with a run of it.
OPEN_END = rf"(?Us)\A(?:{WS}|.*+(?<={WS}))"
UNTIDY = rf"(?Us){WS}{{2}}|\A{WS}|{WS}\z"


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(c, F.lit(WS_CHARS))


def collapse(c: Column, at_least: int = 1) -> Column:
    """Turn every whitespace run of ``at_least`` characters into one blank."""
    return F.regexp_replace(c, rf"(?U){WS}{{{at_least},}}", " ")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``; null when there is none or it is empty."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def text_lines(c: Column) -> Column:
    """All lines of a text, blank ones included."""
    return F.split(c, LINE_BREAK, -1)


def filled_lines(c: Column) -> Column:
    """Stripped, non-blank lines of a text in order."""
    stripped = lambda x: F.when(x.rlike(OPEN_END), strip(x)).otherwise(x)
    return F.filter(F.transform(text_lines(c), stripped), lambda x: x != "")


def tidy_lines(c: Column) -> Column:
    """All lines of a text, stripped, runs of whitespace as one blank. Only lines that need it are worked on."""
    tidy = lambda x: F.when(x.rlike(UNTIDY), collapse(strip(x), 2)).otherwise(x)
    return F.transform(text_lines(c), tidy)


def concat_lines(lines: Column) -> Column:
    return F.array_join(lines, "\n")
