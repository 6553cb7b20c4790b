"""Loading rules of the two tables: shape, types, defaults, constraints and keyed replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.functions.dates import load_timestamp
from docledger.functions.text import blank_to_null
from docledger.operators.lineage import read_from
from docledger.operators.positions import numbered
from docledger.schemas import DOCUMENTS_TABLE, ITEMS_TABLE, columns


def align_schema(df: DataFrame, schema: str) -> DataFrame:
    """The schema's columns in its order; columns the input lacks are null, empty strings count as null."""

    def column(name: str, kind: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(kind).alias(name)
        c = F.col(name)
        return (blank_to_null(c) if kind == "string" else c).alias(name)

    return df.select(*[column(name, kind) for name, kind in columns(schema)])


def cast_to_table_types(df: DataFrame, schema: str) -> DataFrame:
    """The table's types; money rounds half up and what does not fit becomes null."""
    return df.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in columns(schema)])


def default_document_number(c: Column) -> Column:
    return F.coalesce(blank_to_null(c), F.lit("Not Found"))


def default_receipt_party(doc_type: Column, party: Column) -> Column:
    missing = blank_to_null(party).isNull()
    return F.when((doc_type == "receipt") & missing, F.lit("End Customer")).otherwise(party)


def load_defaults(documents: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Defaults a document row gets on every insert, and the stamp of the run."""
    df = documents.withColumn("document_number", default_document_number(F.col("document_number"))).withColumn(
        "party_name", default_receipt_party(F.col("doc_type"), F.col("party_name"))
    )
    return df if run_ts is None else stamp_updated_at(df, run_ts)


def stamp_updated_at(df: DataFrame, run_ts: str) -> DataFrame:
    return df.withColumn("updated_at", load_timestamp(run_ts))


def document_rows(silver: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Silver documents as rows of the documents table."""
    return load_defaults(cast_to_table_types(align_schema(silver, DOCUMENTS_TABLE), DOCUMENTS_TABLE), run_ts)


def item_rows(silver: DataFrame) -> DataFrame:
    """Silver items as rows of the line item table."""
    return cast_to_table_types(align_schema(silver, ITEMS_TABLE), ITEMS_TABLE)


def assign_line_id(items: DataFrame, offset: int = 0) -> DataFrame:
    """Add a unique ``id`` above ``offset``, without gaps, so that any number of loads fits.

    The rows lie in files that :func:`~docledger.operators.lineage.spent` removes.
    """
    found = numbered(items, "id", compact=True)
    return read_from(found.select((F.col("id") + F.lit(offset)).alias("id"), *items.columns), found)


def distinct_keys(df: DataFrame, key: str = "document_id") -> DataFrame:
    return df.select(key).dropna().distinct()


def replace_by_key(target: DataFrame, batch: DataFrame, keys: DataFrame, key: str = "document_id") -> DataFrame:
    """Target without the rows of the batch's documents, then the batch.

    ``keys`` is the batch's key frame; both tables are replaced by the keys of the *documents* batch. Works the
    same inside ``foreachBatch``.
    """
    return target.join(distinct_keys(keys, key), key, "left_anti").unionByName(batch, allowMissingColumns=True)


def fk_violations(items: DataFrame, documents: DataFrame, key: str = "document_id") -> DataFrame:
    """Items whose document is missing."""
    return items.join(documents.select(key), key, "left_anti")


def cascade_delete(
    documents: DataFrame, items: DataFrame, doomed: DataFrame, key: str = "document_id"
) -> tuple[DataFrame, DataFrame]:
    """Both tables without the doomed documents."""
    keys = distinct_keys(doomed, key)
    return documents.join(keys, key, "left_anti"), items.join(keys, key, "left_anti")


def key_membership(df: DataFrame, keys: DataFrame, key: str = "document_id") -> DataFrame:
    """Rows whose key is in the key frame."""
    return df.join(distinct_keys(keys, key), key, "left_semi")


def duplicate_keys(df: DataFrame, key: str = "document_id") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def not_null_violations(df: DataFrame, *required: str) -> DataFrame:
    """Rows with a required column missing; ``missing`` names the first one."""
    checks = [F.when(F.col(name).isNull(), F.lit(name)) for name in required]
    return df.withColumn("missing", F.coalesce(*checks)).where(F.col("missing").isNotNull())


def split_failures(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Processed rows, and failed rows with their ``error``; one failing document stops no other."""
    marked = df.withColumn("error", error)
    return marked.where(F.col("error").isNull()).drop("error"), marked.where(F.col("error").isNotNull())


def load_status(loaded_docs: int, loaded_items: int) -> str:
    return "ok" if loaded_docs > 0 and loaded_items > 0 else "empty"


def ingest_summary(results: DataFrame, documents: DataFrame, items: DataFrame) -> DataFrame:
    """One row: processed and failed inputs, loaded documents and items, and whether there was anything to load."""
    counters = ("processed_count", "failed_count", "loaded_docs", "loaded_items")

    def counted(df: DataFrame, **counts: Column) -> DataFrame:
        return df.agg(*[F.count_if(counts.get(name, F.lit(False))).alias(name) for name in counters])

    parts = (
        counted(results, processed_count=F.col("error").isNull(), failed_count=F.col("error").isNotNull())
        .unionByName(counted(documents, loaded_docs=F.lit(True)))
        .unionByName(counted(items, loaded_items=F.lit(True)))
    )
    filled = (F.col("loaded_docs") > 0) & (F.col("loaded_items") > 0)
    return parts.agg(*[F.sum(name).alias(name) for name in counters]).withColumn(
        "status", F.when(filled, "ok").otherwise("empty")
    )
