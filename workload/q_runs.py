"""Whole runs into a ledger on disk: incremental loads, and both kinds of documents from their sources to the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docledger import schemas
from docledger.operators import tables
from docledger.operators.lineage import fresh_folder, spent, stored
from docledger.plans import gold, loads, pipelines
from docledger.sources.ledger import Ledger
from workload import views
from workload.q_loads import BATCH, INVOICE_SILVER, STAMP, TABLE, _batch
from workload.q_texts import RECEIPT_DOCS
from workload.registry import query

c = F.col
ITEMS = ", ".join(schemas.names(schemas.ITEMS_TABLE))
LATER = "2024-02-01T00:00:00"


def _two_loads(spark, sf) -> Ledger:
    """All documents, then the later batch of :func:`workload.q_loads._batch` with its items, described as changed."""
    ledger = Ledger(spark, fresh_folder(spark, "ledger"), buckets=16)
    documents = stored(tables.document_rows(views.documents(spark, sf), STAMP))
    items = stored(tables.item_rows(views.line_items(spark, sf)))
    loads.load_batch(ledger, documents, items, "first")
    batch = _batch(documents)
    changed = items.join(batch.select("document_id"), "document_id", "left_semi").withColumn("description", F.lit("Changed"))
    new = changed.withColumn("document_id", F.concat("document_id", F.lit("-new")))
    loads.load_batch(ledger, batch, changed.unionByName(new), "second")
    spent(documents, items)
    return ledger


LOADS = {
    **BATCH,
    "items": f"SELECT {ITEMS} FROM fx_line_items",
    "changed_items": "SELECT * REPLACE ('Changed' AS description) FROM items WHERE document_id IN (SELECT document_id FROM changed)",
    "all_items": """SELECT * FROM items WHERE document_id NOT IN (SELECT document_id FROM batch) UNION ALL SELECT * FROM changed_items
                    UNION ALL SELECT * REPLACE (document_id || '-new' AS document_id) FROM changed_items""",
}


@query("SELECT * FROM target WHERE document_id NOT IN (SELECT document_id FROM batch) UNION ALL SELECT * FROM batch", **LOADS)
def ledger_documents(spark, sf):
    """The documents table after two loads."""
    return _two_loads(spark, sf).tables()[0].drop("updated_at")


@query("SELECT * FROM all_items", **LOADS)
def ledger_line_items(spark, sf):
    return _two_loads(spark, sf).tables()[1].drop("id")


@query("SELECT item, coalesce(sum(line_total), 0) AS sum_value, count(*) AS count_rows FROM all_items GROUP BY item", **LOADS)
def ledger_item_values(spark, sf):
    """Item values after two loads, from the sums kept by bucket."""
    ledger = _two_loads(spark, sf)
    return gold.gold_tables(ledger, ledger.current())["v_top_items_by_value"]


def _invoice_run(spark, sf):
    pages = views.invoice_texts(spark, sf).select(c("document_id").alias("doc_id"), "text", "source_path", "extraction_flavor")
    return pipelines.ingest_invoices(spark, pages, views.table_cells(spark, sf), fresh_folder(spark, "ledger"), STAMP)


MONEY = ("sum_line_total", "subtotal_meta", "total_meta", "diff_sum_vs_subtotal", "diff_sum_vs_total")
# As text first: a number that is written with a last digit of five is rounded up, whatever its binary value is.
TYPED = ", ".join([*(f"CAST(CAST({name} AS VARCHAR) AS DECIMAL(18,2)) AS {name}" for name in MONEY), "CAST(tax_meta_pct AS DECIMAL(9,4)) AS tax_meta_pct"])


@query(f"SELECT {TABLE} FROM (SELECT * REPLACE ({TYPED}) FROM silver)", silver=INVOICE_SILVER)
def ingest_invoices_documents(spark, sf):
    """Invoices from page texts and table cells to the documents table."""
    return _invoice_run(spark, sf)["documents"].drop("updated_at")


@query("""SELECT s.document_id, f.item, f.description, f.quantity, CAST(f.unit_price AS DECIMAL(14,2)) AS unit_price,
           CAST(coalesce(CAST(f.line_total AS DOUBLE), CAST(f.unit_price AS DOUBLE) * CAST(f.quantity AS DOUBLE)) AS DECIMAL(14,2)) AS line_total
           FROM silver s JOIN fx_line_items f ON 'orders/' || f.order_key = s.source_path""", silver=INVOICE_SILVER)
def ingest_invoices_line_items(spark, sf):
    return _invoice_run(spark, sf)["line_items"].drop("id")


def _receipt_run(spark, sf):
    """Two passes of every receipt, the second with wider spaces."""
    texts = stored(views.receipt_texts(spark, sf))
    one = lambda no, text: F.struct(F.lit(0).alias("variant_no"), F.lit("gray").alias("variant"), F.lit(no).alias("pass_no"), F.lit(f"psm{no}").alias("cfg"), text.alias("text"))
    passes = texts.select("doc_id", F.inline(F.array(one(4, c("text")), one(6, F.regexp_replace("text", " ", "  ")))))
    sources = texts.select("doc_id", F.concat(F.lit("orders/"), F.regexp_extract("doc_id", "[0-9]+", 0)).alias("source_path"), F.lit(None).cast("string").alias("file_hash"))
    return pipelines.ingest_receipts(spark, passes, fresh_folder(spark, "ledger"), STAMP, sources=sources)


@query("""SELECT document_id, doc_type, 'Not Found' AS document_number, 'End Customer' AS party_name, supplier_name, currency,
                 CAST(total_meta AS DECIMAL(18,2)) AS total_meta, source_path FROM receipts""", receipts=RECEIPT_DOCS)
def ingest_receipts_documents(spark, sf):
    """Receipts from recognition passes to the documents table. Equal printed lines are one after passes are merged, so what
    depends on the number of items is left to the queries on receipt texts."""
    columns = ("document_id", "doc_type", "document_number", "party_name", "supplier_name", "currency", "total_meta", "source_path")
    return _receipt_run(spark, sf)["documents"].select(*columns)


@query("SELECT count(*) AS processed_count, 0 AS failed_count, count(*) AS loaded_docs FROM receipts", receipts=RECEIPT_DOCS)
def ingest_receipts_summary(spark, sf):
    return _receipt_run(spark, sf)["summary"].select("processed_count", "failed_count", "loaded_docs")
