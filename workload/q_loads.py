"""Reconciliation, loading rules and whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from docledger import schemas
from docledger.operators import reconcile, tables
from docledger.plans import pipelines
from docledger.sources import files
from workload import sql, views
from workload.registry import query

c = F.col
STAMP = "2024-01-01T00:00:00"

# Reconciliation


@query("""
SELECT order_key, line_total FROM (SELECT order_key, coalesce(CAST(line_total AS DOUBLE),
       CAST(unit_price AS DOUBLE) * CAST(quantity AS DOUBLE)) AS line_total FROM fx_line_items)""")
def fill_line_total_invoice(spark, sf):
    items = views.line_items(spark, sf).select("order_key", *[c(n).cast("double").alias(n) for n in ("quantity", "unit_price", "line_total")])
    return reconcile.fill_line_total_invoice(items).select("order_key", "line_total")


ZEROED = """SELECT order_key, CAST(quantity AS DOUBLE) AS quantity, CASE WHEN order_key % 5 = 0 THEN -1 ELSE 1 END * CAST(unit_price AS DOUBLE) AS unit_price,
       CASE WHEN order_key % 4 = 1 THEN 0 ELSE CAST(line_total AS DOUBLE) END AS line_total FROM fx_line_items"""


def _zeroed(spark, sf):
    """Items with some zero totals and some negative prices."""
    k = c("order_key")
    return views.line_items(spark, sf).select(
        "order_key",
        c("quantity").cast("double").alias("quantity"),
        (F.when(k % 5 == 0, -1).otherwise(1) * c("unit_price").cast("double")).alias("unit_price"),
        F.when(k % 4 == 1, 0.0).otherwise(c("line_total").cast("double")).alias("line_total"),
    )


@query("""SELECT order_key, CASE WHEN line_total IS NULL OR line_total = 0 THEN coalesce(unit_price, 0) * coalesce(quantity, 0)
          ELSE line_total END AS line_total FROM zeroed""", zeroed=ZEROED)
def fill_line_total_receipt(spark, sf):
    return reconcile.fill_line_total_receipt(_zeroed(spark, sf)).select("order_key", "line_total")


@query("""SELECT order_key, greatest(coalesce(quantity, 0), 0) AS quantity, greatest(unit_price, 0) AS unit_price,
                 greatest(CASE WHEN line_total IS NULL OR line_total = 0 THEN unit_price * coalesce(quantity, 0) ELSE line_total END, 0) AS line_total
          FROM zeroed""", zeroed=ZEROED)
def clean_receipt_items(spark, sf):
    return reconcile.clean_receipt_items(_zeroed(spark, sf))


@query("""SELECT document_id, CAST(count(*) AS INTEGER) AS items_count, CAST(sum(coalesce(line_total, 0)) AS DECIMAL(28,8)) AS sum_line_total
          FROM fx_line_items GROUP BY document_id""")
def document_rollup(spark, sf):
    return reconcile.document_rollup(views.line_items(spark, sf))


GAPS = """
SELECT document_id, order_key, CAST(sum_line_total AS DOUBLE) AS sum_line_total, CAST(subtotal_meta AS DOUBLE) AS subtotal_meta,
       CASE WHEN order_key % 4 = 0 THEN CAST(total_meta AS DOUBLE) END AS total_meta, CAST(tax_meta_pct AS DOUBLE) AS tax_meta_pct,
       CASE WHEN order_key % 2 = 0 THEN CAST(sum_line_total AS DOUBLE) END AS amount_due,
       CASE WHEN order_key % 7 = 1 THEN 12.5::DOUBLE END AS discount_meta_val,
       CASE WHEN order_key % 6 = 1 THEN 100.0::DOUBLE END AS tendered_meta,
       CASE WHEN order_key % 6 = 1 THEN 40.25::DOUBLE + order_key % 100 END AS change_due_meta,
       CAST(NULL AS DOUBLE) AS tax_meta_val, CAST(items_count AS BIGINT) - 3 AS items_sold_meta
FROM fx_documents"""


def _gaps(spark, sf):
    """Documents with gaps in their stated amounts."""
    k = c("order_key")
    d = lambda name: c(name).cast("double")
    return views.documents(spark, sf, names=False).select(
        "document_id",
        "order_key",
        d("sum_line_total").alias("sum_line_total"),
        d("subtotal_meta").alias("subtotal_meta"),
        F.when(k % 4 == 0, d("total_meta")).alias("total_meta"),
        d("tax_meta_pct").alias("tax_meta_pct"),
        F.when(k % 2 == 0, d("sum_line_total")).alias("amount_due"),
        F.when(k % 7 == 1, 12.5).alias("discount_meta_val"),
        F.when(k % 6 == 1, 100.0).alias("tendered_meta"),
        F.when(k % 6 == 1, 40.25 + k % 100).alias("change_due_meta"),
        F.lit(None).cast("double").alias("tax_meta_val"),
        (c("items_count").cast("bigint") - 3).alias("items_sold_meta"),
    )


@query("SELECT document_id, coalesce(total_meta, subtotal_meta * (1 + tax_meta_pct / 100), amount_due) AS total FROM gaps", gaps=GAPS)
def invoice_total_fallback(spark, sf):
    total = reconcile.invoice_total_fallback(c("total_meta"), c("subtotal_meta"), c("tax_meta_pct"), c("amount_due"))
    return _gaps(spark, sf).select("document_id", total.alias("total"))


FALLBACK = {
    "gaps": GAPS,
    "paid": """SELECT * REPLACE (
        coalesce(total_meta, CASE WHEN tendered_meta IS NOT NULL THEN greatest(0, tendered_meta - change_due_meta) END) AS total_meta,
        coalesce(subtotal_meta, greatest(0, sum_line_total - coalesce(discount_meta_val, 0))) AS subtotal_meta) FROM gaps""",
    "taxed": """SELECT * REPLACE (CAST(round(CAST(subtotal_meta * (tax_meta_pct / 100) AS DECIMAL(28,8)), 2) AS DOUBLE) AS tax_meta_val) FROM paid""",
    "filled": """SELECT * REPLACE (coalesce(total_meta,
        CAST(round(CAST(subtotal_meta + tax_meta_val - coalesce(discount_meta_val, 0) AS DECIMAL(28,8)), 2) AS DOUBLE)) AS total_meta) FROM taxed""",
}


def _filled(spark, sf):
    gaps = _gaps(spark, sf).withColumn("tax_meta_pct", c("tax_meta_pct") / 100)
    return reconcile.receipt_totals_fallback(gaps)


@query("SELECT document_id, subtotal_meta, tax_meta_val, total_meta FROM filled", **FALLBACK)
def receipt_totals_fallback(spark, sf):
    return _filled(spark, sf).select("document_id", "subtotal_meta", "tax_meta_val", "total_meta")


@query("SELECT document_id, sum_line_total - subtotal_meta AS diff_sum_vs_subtotal, sum_line_total - total_meta AS diff_sum_vs_total FROM filled", **FALLBACK)
def diff_metrics(spark, sf):
    return reconcile.diff_metrics(_filled(spark, sf)).select("document_id", "diff_sum_vs_subtotal", "diff_sum_vs_total")


@query("""SELECT document_id, items_sold_meta > 0 AS items_detected_gt_zero, coalesce(subtotal_meta, 0) >= 0 AS subtotal_nonneg,
                 coalesce(total_meta, 0) >= 0 AS total_nonneg, abs(coalesce(sum_line_total - subtotal_meta, 0)) <= 0.02 AS subtotal_close_to_sum
          FROM filled""", **FALLBACK)
def validate_documents(spark, sf):
    return reconcile.validate_documents(reconcile.diff_metrics(_filled(spark, sf)))


INVOICE_SILVER = f"""
SELECT regexp_replace({sql.slug('d.party_name')} || '-' || d.document_number || '-' || strftime(d.document_date, '%Y%m%d'), '[^A-Z0-9\\-]', '', 'g') AS document_id,
       'invoice' AS doc_type, d.document_number || ' ' || d.supplier_name AS document_number_raw, d.document_number, d.party_name,
       d.supplier_name, 'USD' AS currency, d.extraction_flavor, i.n AS items_count, i.v AS sum_line_total,
       CAST(d.subtotal_meta AS DOUBLE) AS subtotal_meta, p.pct AS tax_meta_pct,
       CAST(d.subtotal_meta AS DOUBLE) * (1 + p.pct / 100) AS total_meta,
       i.v - CAST(d.subtotal_meta AS DOUBLE) AS diff_sum_vs_subtotal,
       i.v - CAST(d.subtotal_meta AS DOUBLE) * (1 + p.pct / 100) AS diff_sum_vs_total, d.source_path
FROM fx_invoice_text t JOIN fx_ledger d ON d.document_id = t.document_id
JOIN (SELECT document_id, CASE WHEN tax_meta_pct <= 1 THEN CAST(tax_meta_pct AS DOUBLE) * 100 ELSE CAST(tax_meta_pct AS DOUBLE) END AS pct FROM fx_ledger) p
  ON p.document_id = t.document_id
JOIN (SELECT document_id, CAST(count(*) AS INTEGER) AS n,
             CAST(CAST(sum(CAST(coalesce(CAST(line_total AS DOUBLE), CAST(unit_price AS DOUBLE) * CAST(quantity AS DOUBLE), 0) AS DECIMAL(28,8))) AS DECIMAL(28,8)) AS DOUBLE) AS v
      FROM fx_line_items GROUP BY document_id) i ON i.document_id = t.document_id"""


def _invoice_bronze(spark, sf):
    texts = views.invoice_texts(spark, sf).withColumnRenamed("document_id", "doc_id")
    return pipelines.invoice_bronze(texts, STAMP)


@query(INVOICE_SILVER)
def build_invoice_documents(spark, sf):
    items = views.line_items(spark, sf).withColumnRenamed("document_id", "doc_id")
    documents = reconcile.build_invoice_documents(_invoice_bronze(spark, sf), items, "doc_id", STAMP)
    return documents.drop("ingest_ts", "silver_ts")


@query(f"""SELECT s.document_id, f.item, f.description, CAST(f.quantity AS DOUBLE) AS quantity, CAST(f.unit_price AS DOUBLE) AS unit_price,
           coalesce(CAST(f.line_total AS DOUBLE), CAST(f.unit_price AS DOUBLE) * CAST(f.quantity AS DOUBLE)) AS line_total
           FROM silver s JOIN fx_line_items f ON 'orders/' || f.order_key = s.source_path""", silver=INVOICE_SILVER)
def prepend_key(spark, sf):
    items = views.line_items(spark, sf).withColumnRenamed("document_id", "doc_id")
    return pipelines.invoice_batch(_invoice_bronze(spark, sf), items, STAMP).items


# Loading rules

TABLE = ", ".join(schemas.names(schemas.DOCUMENTS_TABLE))
LOADED = f"""
SELECT * REPLACE (coalesce(document_number, 'Not Found') AS document_number,
                  CASE WHEN doc_type = 'receipt' THEN coalesce(party_name, 'End Customer') ELSE party_name END AS party_name)
FROM (SELECT {TABLE} FROM fx_documents)"""


@query("""SELECT document_id, item, description, CAST(NULL AS DECIMAL(14,3)) AS quantity, CAST(NULL AS DECIMAL(14,2)) AS unit_price, line_total
          FROM fx_line_items""")
def align_schema(spark, sf):
    """Items that lack two columns and carry others, in the table's shape."""
    return tables.align_schema(views.line_items(spark, sf).drop("quantity", "unit_price"), schemas.ITEMS_TABLE)


@query("""SELECT order_key, CAST(round(v, 3) AS DECIMAL(14,3)) AS quantity, CAST(round(v, 2) AS DECIMAL(14,2)) AS line_total
          FROM (SELECT order_key, CAST(unit_price * quantity AS DECIMAL(20,5)) * 0.0625 AS v FROM fx_line_items)""")
def cast_to_table_types(spark, sf):
    v = F.expr("cast(unit_price * quantity as decimal(20,5)) * 0.0625")
    rows = views.line_items(spark, sf).select("order_key", v.alias("quantity"), v.alias("line_total"))
    return tables.cast_to_table_types(rows, "order_key bigint, quantity decimal(14,3), line_total decimal(14,2)")


@query(LOADED)
def load_defaults(spark, sf):
    return tables.document_rows(views.documents(spark, sf))


@query("SELECT count(*) AS n, count(*) AS n_ids, true AS above_offset FROM fx_line_items")
def assign_line_id(spark, sf):
    ids = tables.assign_line_id(views.line_items(spark, sf), 1000)
    return ids.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"), (F.min("id") > 1000).alias("above_offset")
    )


def _batch(documents):
    """A later batch: every fifth document with its supplier changed, and as many new ones."""
    changed = documents.where(F.substring_index("source_path", "/", -1).cast("bigint") % 5 == 0)
    new = changed.withColumn("document_id", F.concat("document_id", F.lit("-new")))
    return changed.unionByName(new).withColumn("supplier_name", F.lit("Changed"))


BATCH = {
    "target": LOADED,
    "changed": "SELECT * REPLACE ('Changed' AS supplier_name) FROM target WHERE CAST(split_part(source_path, '/', 2) AS BIGINT) % 5 = 0",
    "batch": "SELECT * FROM changed UNION ALL SELECT * REPLACE (document_id || '-new' AS document_id) FROM changed",
}


@query("""SELECT * FROM target WHERE document_id NOT IN (SELECT document_id FROM batch) UNION ALL SELECT * FROM batch""", **BATCH)
def replace_by_key(spark, sf):
    target = tables.document_rows(views.documents(spark, sf))
    batch = _batch(target)
    return tables.replace_by_key(target, batch, batch)


@query("SELECT document_id FROM batch GROUP BY document_id", **BATCH)
def distinct_keys(spark, sf):
    return tables.distinct_keys(_batch(tables.document_rows(views.documents(spark, sf))))


KEPT = "SELECT document_id FROM fx_documents WHERE order_key % 5 <> 0"


@query("SELECT document_id, item, line_total FROM fx_line_items WHERE order_key % 5 = 0")
def fk_violations(spark, sf):
    documents = views.documents(spark, sf, names=False).where(c("order_key") % 5 != 0)
    return tables.fk_violations(views.line_items(spark, sf), documents).select("document_id", "item", "line_total")


@query("""SELECT 'documents' AS name, count(*) AS n FROM fx_documents WHERE order_key % 5 <> 0
          UNION ALL SELECT 'items', count(*) FROM fx_line_items WHERE order_key % 5 <> 0""")
def cascade_delete(spark, sf):
    documents, items = views.documents(spark, sf, names=False), views.line_items(spark, sf)
    kept = tables.cascade_delete(documents, items, documents.where(c("order_key") % 5 == 0))
    counts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name, df in zip(("documents", "items"), kept)]
    return counts[0].unionByName(counts[1])


@query("SELECT document_id, item, line_total FROM fx_line_items WHERE order_key % 3 = 0")
def key_membership(spark, sf):
    receipts = views.documents(spark, sf, names=False).where(c("doc_type") == "receipt")
    return tables.key_membership(views.line_items(spark, sf), receipts).select("document_id", "item", "line_total")


@query("SELECT document_id, count(*) AS n_rows FROM fx_line_items GROUP BY document_id HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return tables.duplicate_keys(views.line_items(spark, sf))


@query("""SELECT document_id, CASE WHEN document_number IS NULL THEN 'document_number' ELSE 'party_name' END AS missing
          FROM fx_documents WHERE document_number IS NULL OR party_name IS NULL""")
def not_null_violations(spark, sf):
    found = tables.not_null_violations(views.documents(spark, sf), "document_number", "party_name")
    return found.select("document_id", "missing")


ERROR = "CASE WHEN subtotal_meta IS NULL THEN 'no subtotal' WHEN items_count = 0 THEN 'no items' END"


def _error():
    return F.when(c("subtotal_meta").isNull(), "no subtotal").when(c("items_count") == 0, "no items")


@query(f"SELECT document_id, coalesce({ERROR}, 'processed') AS status FROM fx_documents")
def split_failures(spark, sf):
    processed, failed = tables.split_failures(views.documents(spark, sf, names=False), _error())
    return processed.select("document_id", F.lit("processed").alias("status")).unionByName(
        failed.select("document_id", c("error").alias("status"))
    )


@query(f"""SELECT count(*) FILTER (WHERE {ERROR} IS NULL) AS processed_count, count(*) FILTER (WHERE {ERROR} IS NOT NULL) AS failed_count,
           count(*) AS loaded_docs, (SELECT count(*) FROM fx_line_items) AS loaded_items, 'ok' AS status FROM fx_documents""")
def ingest_summary(spark, sf):
    documents = views.documents(spark, sf, names=False)
    return tables.ingest_summary(documents.withColumn("error", _error()), documents, views.line_items(spark, sf))


@query("""SELECT document_id, doc_type, party_name, items_count FROM fx_documents""")
def union_doc_types(spark, sf):
    documents = views.documents(spark, sf).select("document_id", "doc_type", "party_name", "items_count")
    receipts = documents.where(c("doc_type") == "receipt").drop("party_name")
    return files.union_doc_types(documents.where(c("doc_type") == "invoice"), receipts)
