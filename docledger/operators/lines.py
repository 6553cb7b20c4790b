"""Document texts as lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.functions.text import filled_lines, strip, text_lines


def explode_lines(df: DataFrame, text: str = "text", keep_blank: bool = False) -> DataFrame:
    """One row per line with its 0-based ``line_no``; blank lines only with ``keep_blank``."""
    lines = F.transform(text_lines(F.col(text)), strip) if keep_blank else filled_lines(F.col(text))
    return df.select(*[c for c in df.columns if c != text], F.posexplode(lines).alias("line_no", "line"))


def next_line_lookahead(df: DataFrame, text: str = "text") -> DataFrame:
    """Lines with their successor, taken inside the document's own row: nothing is shuffled."""
    lines = F.col("_lines")
    pairs = F.transform(lines, lambda line, i: F.struct(line.alias("line"), F.get(lines, i + 1).alias("next_line")))
    return (
        df.withColumn("_lines", filled_lines(F.col(text)))
        .select(*[c for c in df.columns if c != text], F.posexplode(pairs).alias("line_no", "_pair"))
        .select("*", "_pair.*")
        .drop("_pair")
    )


def head_lines(df: DataFrame, n: int, text: str = "text") -> DataFrame:
    """The first ``n`` non-blank lines of each document."""
    return _some_lines(df, text, lambda lines: F.slice(lines, 1, n), F.lit(0))


def tail_lines(df: DataFrame, n: int, text: str = "text") -> DataFrame:
    """The last ``n`` non-blank lines of each document."""
    start = F.greatest(F.size("_lines") - n, F.lit(0))
    return _some_lines(df, text, lambda lines: F.slice(lines, start + 1, F.lit(n)), start)


def _some_lines(df: DataFrame, text: str, pick, start: Column) -> DataFrame:
    kept = [c for c in df.columns if c != text]
    return (
        df.withColumn("_lines", filled_lines(F.col(text)))
        .select(*kept, start.alias("_start"), F.posexplode(pick(F.col("_lines"))).alias("_at", "line"))
        .select(*kept, (F.col("_start") + F.col("_at")).cast("int").alias("line_no"), "line")
    )


def concat_pages(df: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """Page texts of a document joined in page order.

    The one operator whose result is a whole document in one value; Spark's 2 GB string limit bounds it, as it
    bounds every document text of the data model.
    """
    return df.groupBy(key).agg(page_text(page, text).alias("text"))


def page_text(page: str, text: str) -> Column:
    """The aggregate behind :func:`concat_pages`."""
    return F.expr(f"listagg(coalesce({text}, ''), '\\n') WITHIN GROUP (ORDER BY {page})")


def dedup_lines_keep_first(df: DataFrame, keys: list[str], key: Column, order: list[str], line: str) -> DataFrame:
    """Each distinct line key once, with the first line that carries it.

    A grouped minimum instead of a window: repeated lines collapse before the shuffle and no key gathers a whole document.
    """
    first = F.min(F.struct(*[F.col(c) for c in order], F.col(line)))
    return df.groupBy(*keys, key.alias("line_key")).agg(first.alias("_first")).select(*keys, "line_key", "_first.*")


def first_match_wins(df: DataFrame, keys: list[str], order: str, **fields: tuple[Column, Column]) -> DataFrame:
    """Per field ``(condition, value)`` the value of the first row that meets the condition."""
    return df.groupBy(*keys).agg(
        *[F.min_by(value, F.when(cond, F.col(order))).alias(name) for name, (cond, value) in fields.items()]
    )


def last_match_wins(df: DataFrame, keys: list[str], order: str, **fields: tuple[Column, Column]) -> DataFrame:
    """Per field ``(condition, value)`` the value of the last row that meets the condition."""
    return df.groupBy(*keys).agg(
        *[F.max_by(value, F.when(cond, F.col(order))).alias(name) for name, (cond, value) in fields.items()]
    )


