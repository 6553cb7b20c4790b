"""Date expressions. Raw texts stay beside every parsed value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docledger.functions.text import extract, strip

# Fixed value: a day/month/year text as it follows a label.
LABEL_DATE = r"([0-9]{1,2}[/\-][0-9]{1,2}[/\-][0-9]{2,4})"

# Receipt time formats in the order they are tried, each with the shape it accepts.
RECEIPT_FORMATS = (
    ("yyyy-M-d H:m:s", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
    ("yyyy-M-d H:m", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$"),
    ("M/d/yyyy H:m:s", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$"),
    ("M/d/yyyy H:m", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$"),
    ("d/M/yyyy H:m:s", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$"),
    ("d/M/yyyy H:m", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$"),
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("d/M/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
)


def find_label_date(c: Column, label: str) -> Column:
    """Raw date after a label such as ``invoice date``."""
    words = r"\s*".join(label.split())
    return extract(c, rf"(?iU){words}[:\s]*{LABEL_DATE}")


def dmy_to_yyyymmdd(c: Column) -> Column:
    """Day first, two-digit years in this century; not checked against the calendar."""
    pattern = r"(\d{1,2})[/\-](\d{1,2})[/\-](\d{2,4})"
    day, month, year = (F.regexp_extract(c, pattern, g) for g in (1, 2, 3))
    number = year.try_cast("int")
    full = F.when(number < 100, number + 2000).otherwise(number).cast("string")
    return F.when(
        year != "", F.concat(F.lpad(full, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    )


def parse_receipt_datetime(c: Column) -> Column:
    """First of the receipt formats that fits, else null."""
    t = F.regexp_replace(strip(c), r"(?U)\s+", " ")
    return F.coalesce(
        *[F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(fmt))) for fmt, shape in RECEIPT_FORMATS]
    )


def iso_to_yyyymmdd(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyyMMdd"), F.lit("NA"))


def load_timestamp(run_ts: str) -> Column:
    """The stamp of a run, passed in so that a run can be repeated."""
    return F.lit(run_ts).cast("timestamp")
