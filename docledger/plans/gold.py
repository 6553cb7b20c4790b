"""Gold tables over ``documents`` and ``line_items``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.functions.numbers import exact
from docledger.functions.predicates import is_distinct_from


def _zero():
    return F.lit(0)


def overview_sums(documents: DataFrame, *by: str) -> DataFrame:
    """Document count, value and documents whose difference is not exactly zero (unknown counts as different)."""
    return documents.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("sum_line_total").cast("decimal(28,2)").alias("sum_value"),
        F.count_if(is_distinct_from(F.col("diff_sum_vs_subtotal"), 0)).alias("n_with_diff_subtotal"),
    )


def party_sums(documents: DataFrame, *by: str) -> DataFrame:
    return documents.groupBy(*by, "party_name").agg(F.sum("sum_line_total").cast("decimal(28,2)").alias("sum_value"), F.count(F.lit(1)).alias("count_docs"))


def item_sums(line_items: DataFrame, *by: str) -> DataFrame:
    """Quantity, a missing one counting as one, value and number of lines per item."""
    return line_items.groupBy(*by, "item").agg(
        F.sum(F.coalesce("quantity", F.lit(1).cast("decimal(14,3)"))).cast("decimal(28,3)").alias("total_quantity"),
        F.sum("line_total").cast("decimal(28,2)").alias("sum_value"),
        F.count(F.lit(1)).alias("count_rows"),
    )


def bucket_sums(documents: DataFrame, line_items: DataFrame) -> dict[str, DataFrame]:
    """The sums of the gold tables for rows with ``bucket``, to be kept and merged on reading."""
    return {
        "gold_overview": overview_sums(documents, "bucket"),
        "gold_parties": party_sums(documents, "bucket"),
        "gold_items": item_sums(line_items, "bucket"),
    }


def merged(sums: DataFrame, *by: str) -> DataFrame:
    """Sums of buckets and runs added up; what was missing everywhere stays missing."""
    rest = [f for f in sums.schema if f.name not in (*by, "run", "bucket")]
    return sums.groupBy(*by).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in rest])


def _overview(sums: DataFrame, run_ts: str | None) -> DataFrame:
    kinds = ("bigint", "decimal(28,2)", "bigint")
    df = sums.select(*[F.coalesce(c, F.lit(0)).cast(kind).alias(c) for c, kind in zip(("n_docs", "sum_value", "n_with_diff_subtotal"), kinds, strict=True)])
    return df if run_ts is None else df.withColumn("generated_ts", F.lit(run_ts).cast("timestamp"))


def _parties(sums: DataFrame) -> DataFrame:
    return sums.orderBy(F.desc_nulls_first("sum_value"), F.desc("count_docs"), "party_name")


def _by_frequency(sums: DataFrame) -> DataFrame:
    named = sums.select("item", "total_quantity", F.coalesce("sum_value", _zero()).cast("decimal(28,2)").alias("sum_value"))
    return named.orderBy(F.desc_nulls_first("total_quantity"), F.desc_nulls_first("sum_value"), "item")


def _by_value(sums: DataFrame) -> DataFrame:
    ordered = sums.orderBy(F.desc_nulls_first("sum_value"), F.desc("count_rows"), "item")
    return ordered.select("item", F.coalesce("sum_value", _zero().cast("decimal(28,2)")).alias("sum_value"), "count_rows")


def summary_overview(documents: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Document count, total value and documents whose difference is not exactly zero (unknown counts as different)."""
    return _overview(overview_sums(documents), run_ts)


def top_parties(documents: DataFrame) -> DataFrame:
    """Value and number of documents per party, both document types."""
    return _parties(party_sums(documents))


def top_items_by_frequency(line_items: DataFrame) -> DataFrame:
    """Quantity sold per item, a missing quantity counting as one."""
    return _by_frequency(item_sums(line_items))


def top_items_by_value(line_items: DataFrame) -> DataFrame:
    """Value and number of lines per item; items without any value come first."""
    return _by_value(item_sums(line_items))


def gold_tables(ledger, version, run_ts: str | None = None) -> dict[str, DataFrame]:
    """The gold views of a version of the ledger. Rankings and the overview come from the sums kept by bucket; no document or
    line item is read for them."""
    overview, parties, items = (ledger.read(f"gold_{name}", version) for name in ("overview", "parties", "items"))
    items = merged(items, "item")
    return {
        "v_summary_overview": _overview(merged(overview), run_ts),
        "v_top_parties": _parties(merged(parties, "party_name")),
        "v_top_items_by_frequency": _by_frequency(items),
        "v_top_items_by_value": _by_value(items),
        "v_consistency_diffs": consistency_diffs(ledger.tables(version)[0]),
    }


def consistency_diffs(documents: DataFrame) -> DataFrame:
    return documents.select(
        "document_id",
        "party_name",
        "sum_line_total",
        "subtotal_meta",
        "diff_sum_vs_subtotal",
        "extraction_flavor",
        "source_path",
    )


def consistency_outliers(documents: DataFrame, abs_threshold: float = 0.01, rel_threshold: float = 0.005) -> DataFrame:
    """Documents whose subtotal differs by more than both an absolute and a relative limit."""
    size = F.abs("diff_sum_vs_subtotal")
    # The relative limit is multiplied out: exact on decimals, where a division would round.
    limit = exact(rel_threshold) * F.greatest(
        F.abs("subtotal_meta"), F.lit(1).cast("decimal(18,2)")
    )
    return (
        documents.where(F.col("subtotal_meta").isNotNull())
        .where((size > exact(abs_threshold)) & (size > limit))
        .orderBy(F.desc(size), "document_id")
        .select(
            "document_id",
            "party_name",
            "sum_line_total",
            "subtotal_meta",
            "diff_sum_vs_subtotal",
            "total_meta",
            "extraction_flavor",
            "source_path",
        )
    )


def publish_gold(views: dict[str, DataFrame]) -> None:
    """(Re)define the gold views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
