"""Whole runs: extracted text and cells to silver, silver to checked tables, tables to reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docledger.functions.strings import invoice_document_id, normalize_path, text_sample
from docledger.functions.text import strip
from docledger.operators.cell_tables import choose_items, several_buckets
from docledger.operators.invoice_text import invoice_meta, invoice_parties
from docledger.operators.lineage import stored
from docledger.operators.lines import page_text
from docledger.operators.ocr_passes import choose_ocr_variant, merge_ocr_passes
from docledger.operators.receipt_text import exact_sum, explode_items, receipt_bronze
from docledger.operators.reconcile import (
    build_invoice_documents,
    build_receipt_documents,
    clean_invoice_items,
    clean_receipt_array,
    clean_receipt_items,
    prepend_key,
    receipt_silver,
    silver_columns,
    validate_documents,
    validation_summary,
)
from docledger.operators.tables import document_rows, item_rows, key_membership, load_status, split_failures
from docledger.plans.gold import gold_tables, publish_gold
from docledger.plans.loads import LoadRejected, load_batch, observed, run_identity  # noqa: F401
from docledger.plans.reports import (
    INVOICE_THRESHOLD,
    RECEIPT_THRESHOLD,
    TOP_N,
    invoice_overview,
    invoice_report,
    receipt_report,
)
from docledger.schemas import SILVER_DOCUMENTS, SILVER_ITEMS, names
from docledger.sources.files import export_overview_csv, read_bronze, read_silver, write_bronze, write_silver
from docledger.sources.ledger import Ledger


@dataclass
class Silver:
    """Silver documents and items of one run."""

    documents: DataFrame
    items: DataFrame
    validation: DataFrame | None = None


def invoice_bronze(pages: DataFrame, run_ts: str) -> DataFrame:
    """Bronze metadata of invoices from texts ``(doc_id, text, source_path, extraction_flavor)``."""
    pages = pages.withColumn("source_path", normalize_path(F.col("source_path")))
    return invoice_parties(invoice_meta(pages)).drop("text").withColumn("ingest_ts", F.lit(run_ts))


def invoice_batch(meta: DataFrame, items: DataFrame, run_ts: str) -> Silver:
    """Silver of all invoices from bronze metadata and items, joined on ``doc_id``."""
    ids = meta.select(
        "doc_id",
        invoice_document_id(
            F.col("document_number_raw"),
            F.col("bill_from_name"),
            F.col("client_or_supplier"),
            F.col("invoice_date"),
            F.col("source_path"),
        ).alias("document_id"),
    )
    return Silver(
        build_invoice_documents(meta, items, "doc_id", run_ts), prepend_key(clean_invoice_items(items), ids, "doc_id")
    )


def receipt_texts(passes: DataFrame) -> DataFrame:
    """Best text of each receipt from its OCR passes."""
    chosen = choose_ocr_variant(merge_ocr_passes(passes))
    return chosen.withColumn("extraction_flavor", F.concat(F.lit("ocr_mp:"), "extraction_flavor")).drop("score")


def receipt_meta(texts: DataFrame, run_ts: str) -> DataFrame:
    """Bronze metadata rows of receipts, with the item array beside them."""
    sampled = texts.withColumn("ocr_text_sample", text_sample(F.col("text")))
    return receipt_bronze(sampled).withColumn("ingest_ts", F.lit(run_ts))


def receipt_batch(bronze: DataFrame, run_ts: str) -> Silver:
    """Silver of all receipts from bronze metadata with its item array.

    Items are cleaned, and then added up, in their document's row, so nothing is shuffled.
    """
    cleaned = bronze.withColumn("items", clean_receipt_array(F.col("items"))).withColumn("items_count", F.size("items"))
    silver = receipt_silver(cleaned.withColumn("sum_line_total", exact_sum(F.col("items")).cast("double")), "doc_id")
    items = explode_items(silver.select("document_id", "items"))
    return Silver(silver_columns(silver, run_ts), items.select(*names(SILVER_ITEMS)), validate_documents(silver))


def staging_folder(root: str, run: str) -> str:
    """A fresh folder for the files of one attempt of a run."""
    return f"{root.rstrip('/')}/staging/{run}-{uuid.uuid4().hex[:8]}"


def _counting(processed: DataFrame, failed: DataFrame) -> tuple[DataFrame, DataFrame, Callable[[], dict[str, int]]]:
    """Both frames, counting their rows while they are written, and what gives the counts after that."""
    names = ("processed_count", "failed_count")
    watches = [Observation() for _ in names]
    counted = [df.observe(w, F.count(F.lit(1)).alias(n)) for df, w, n in zip((processed, failed), watches, names, strict=True)]
    return *counted, lambda: {k: v for w in watches for k, v in observed(w).items()}


def _load(spark: SparkSession, batch: Silver, failed: DataFrame, counts: dict[str, int], staging: str, root: str, run: str, run_ts: str, replace: bool) -> dict:
    """Silver to files, then into the tables; the gold views are those of the new version."""
    ledger = Ledger(spark, root)
    write_silver(batch.items, batch.documents, f"{staging}/silver")
    silver = Silver(*read_silver(spark, f"{staging}/silver"))
    version = load_batch(ledger, document_rows(silver.documents, run_ts), item_rows(silver.items), run, replace, counts)
    publish_gold(gold_tables(ledger, version, run_ts))
    documents, items = ledger.tables(version)
    summary = {name: version.summary.get(name, 0) for name in ("processed_count", "failed_count", "loaded_docs", "loaded_items")}
    rows = [(*summary.values(), load_status(summary["loaded_docs"], summary["loaded_items"]))]
    kinds = ", ".join(f"{name} bigint" for name in summary)
    return {
        "documents": documents,
        "line_items": items,
        "summary": spark.createDataFrame(rows, f"{kinds}, status string"),
        "failed": failed,
        "version": version,
    }


def ingest_invoices(
    spark: SparkSession,
    pages: DataFrame,
    cells: DataFrame,
    root: str,
    run_ts: str,
    replace: bool = True,
    threshold: float = INVOICE_THRESHOLD,
    top_n: int = TOP_N,
) -> dict:
    """Invoices from extracted text and cells to the ledger below ``root``, report sections, a summary and the failed documents.

    ``pages`` has one row per document, or one per page, numbered by ``page_no``. ``run_ts`` names the run: one that was
    loaded before changes no table.
    """
    if "page_no" in pages.columns:
        pages = join_pages(pages)
    run = run_identity("invoices", run_ts)
    staging = staging_folder(root, run)
    # Pages and texts are read by several steps: they are written once. Row numbers are looked up before cells are joined.
    processed, failed = split_failures(stored(pages), text_error(F.col("text")))
    several = several_buckets(cells)
    whole, bad, counts = _counting(invoice_bronze(processed, run_ts), failed.select("doc_id", "error"))
    # Bronze is written once: two tables are derived from it, and extraction is the costly part.
    write_bronze(choose_items(key_membership(cells, processed, "doc_id"), several), whole, f"{staging}/bronze")
    bad.write.parquet(f"{staging}/failed")
    meta, bronze_items = (spark.read.parquet(f"{staging}/bronze/{name}") for name in ("meta", "items"))
    meta = with_item_rows(meta, bronze_items, "doc_id")
    done = _load(spark, invoice_batch(meta, bronze_items, run_ts), spark.read.schema(bad.schema).parquet(f"{staging}/failed"), counts(), staging, root, run, run_ts, replace)
    export_overview_csv(invoice_overview(done["documents"]), f"{staging}/overview", run_ts)
    return {**done, "meta": meta, "overview_csv": f"{staging}/overview", "report": invoice_report(done["documents"], done["line_items"], threshold, top_n)}


def ingest_receipts(
    spark: SparkSession,
    passes: DataFrame,
    root: str,
    run_ts: str,
    replace: bool = True,
    threshold: float = RECEIPT_THRESHOLD,
    top_n: int = TOP_N,
    sources: DataFrame | None = None,
) -> dict:
    """Receipts from OCR passes to the ledger below ``root``, report sections, a summary, validations and the failed documents.

    ``sources`` may name each document's file as ``(doc_id, source_path, file_hash)``, as :func:`scan_documents` lists
    it; without it the document's id stands for its path. A run is named by ``run_ts``, see :func:`ingest_invoices`.
    """
    texts = receipt_texts(passes)
    if sources is None:
        texts = texts.withColumn("source_path", F.col("doc_id").cast("string"))
    else:
        texts = texts.join(sources.select("doc_id", "source_path", "file_hash"), "doc_id", "left")
    texts = texts.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("source_path", normalize_path(F.col("source_path")))
    run = run_identity("receipts", run_ts)
    staging = staging_folder(root, run)
    processed, failed = split_failures(stored(texts), text_error(F.col("text")))
    whole, bad, counts = _counting(receipt_meta(processed, run_ts), failed.select("doc_id", "error"))
    whole.write.parquet(f"{staging}/bronze")
    bad.write.parquet(f"{staging}/failed")
    batch = receipt_batch(spark.read.schema(whole.schema).parquet(f"{staging}/bronze"), run_ts)
    done = _load(spark, batch, spark.read.schema(bad.schema).parquet(f"{staging}/failed"), counts(), staging, root, run, run_ts, replace)
    batch.validation.write.parquet(f"{staging}/validation")
    validation = spark.read.schema(batch.validation.schema).parquet(f"{staging}/validation")
    return {
        **done,
        "bronze": f"{staging}/bronze",
        "validation": validation,
        "validation_summary": validation_summary(validation),
        "report": receipt_report(done["documents"], done["line_items"], threshold, top_n),
    }


def ingest_bronze_files(spark: SparkSession, files: str, doc_type: str, root: str, run_ts: str, replace: bool = True) -> dict:
    """Per-document bronze files below ``files`` to the ledger below ``root``.

    A document with a damaged or missing file is a failure, with its file and the reason, and nothing of it is loaded.
    """
    run = run_identity(f"{doc_type}-files", run_ts)
    staging = staging_folder(root, run)
    bronze = read_bronze(spark, files, doc_type)
    whole, bad, counts = _counting(bronze.meta, bronze.failed)
    write_bronze(bronze.items, whole, f"{staging}/bronze")
    bad.write.parquet(f"{staging}/failed")
    meta, items = (spark.read.schema(df.schema).parquet(f"{staging}/bronze/{name}") for name, df in (("meta", whole), ("items", bronze.items)))
    if doc_type == "invoice":
        batch = invoice_batch(meta.withColumnRenamed("doc_stem", "doc_id"), items.withColumnRenamed("doc_stem", "doc_id"), run_ts)
    else:
        documents = build_receipt_documents(meta, items, "doc_stem", run_ts)
        ids = receipt_silver(meta.withColumn("items_count", F.lit(0)).withColumn("sum_line_total", F.lit(0.0)), "doc_stem").select("doc_stem", "document_id")
        batch = Silver(documents, prepend_key(clean_receipt_items(items), ids, "doc_stem"))
    return _load(spark, batch, spark.read.schema(bad.schema).parquet(f"{staging}/failed"), counts(), staging, root, run, run_ts, replace)


def with_item_rows(meta: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Metadata with ``line_items_rows``, the number of the document's bronze items."""
    counted = items.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("line_items_rows"))
    return meta.join(counted, key, "left").withColumn("line_items_rows", F.coalesce("line_items_rows", F.lit(0)))


def join_pages(pages: DataFrame) -> DataFrame:
    """One text per document from its pages; the first page's other columns hold for all."""
    rest = [c for c in pages.columns if c not in ("doc_id", "page_no", "text")]
    first = F.min(F.struct("page_no", *rest)).alias("_first")
    return pages.groupBy("doc_id").agg(page_text("page_no", "text").alias("text"), first).select("doc_id", "text", *[f"_first.{c}" for c in rest])


def text_error(text: Column) -> Column:
    """Why a document cannot be processed, null if it can."""
    return F.when(F.coalesce(strip(text), F.lit("")) == "", "no text")
