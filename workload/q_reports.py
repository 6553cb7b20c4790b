"""Gold tables and report sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from docledger.operators.lineage import stored
from docledger.plans import gold, reports
from workload import views
from workload.registry import query

WIDE = "DECIMAL(28,2)"


@query(f"""
SELECT count(*) AS n_docs, CAST(coalesce(sum(sum_line_total), 0) AS {WIDE}) AS sum_value,
       count(*) FILTER (WHERE diff_sum_vs_subtotal IS NULL OR diff_sum_vs_subtotal <> 0) AS n_with_diff_subtotal
FROM fx_documents""")
def v_summary_overview(spark, sf):
    return gold.summary_overview(views.documents(spark, sf, names=False))


@query(f"""
SELECT party_name, CAST(sum(sum_line_total) AS {WIDE}) AS sum_value, count(*) AS count_docs
FROM fx_documents GROUP BY party_name""")
def v_top_parties(spark, sf):
    return gold.top_parties(views.documents(spark, sf))


@query(f"""
SELECT item, CAST(sum(coalesce(quantity, 1)) AS DECIMAL(28,3)) AS total_quantity,
       CAST(coalesce(sum(line_total), 0) AS {WIDE}) AS sum_value
FROM fx_line_items GROUP BY item""")
def v_top_items_by_frequency(spark, sf):
    return gold.top_items_by_frequency(views.line_items(spark, sf))


@query(f"""
SELECT item, CAST(coalesce(sum(line_total), 0) AS {WIDE}) AS sum_value, count(*) AS count_rows
FROM fx_line_items GROUP BY item""")
def v_top_items_by_value(spark, sf):
    return gold.top_items_by_value(views.line_items(spark, sf))


@query("""
SELECT document_id, party_name, sum_line_total, subtotal_meta, diff_sum_vs_subtotal, extraction_flavor, source_path
FROM fx_documents""")
def consistency_diffs(spark, sf):
    return gold.consistency_diffs(views.documents(spark, sf))


OUTLIERS = """
SELECT document_id, party_name, sum_line_total, subtotal_meta, diff_sum_vs_subtotal, total_meta, extraction_flavor, source_path
FROM fx_documents
WHERE abs(diff_sum_vs_subtotal) > {a} AND abs(diff_sum_vs_subtotal) > {r} * greatest(abs(subtotal_meta), 1)"""


@query(OUTLIERS.format(a="0.01", r="0.005"))
def consistency_outliers(spark, sf):
    return gold.consistency_outliers(views.documents(spark, sf))


@query(OUTLIERS.format(a="0.001", r="0.0000001"), name="consistency_outliers_strict")
def _outliers_strict(spark, sf):
    return gold.consistency_outliers(views.documents(spark, sf), 0.001, 0.0000001)


INVOICE_LINES = """
SELECT d.document_id, d.party_name, coalesce(d.supplier_name, 'Unknown') AS supplier_name, l.item, l.quantity, l.line_total
FROM fx_documents d JOIN fx_line_items l ON l.document_id = d.document_id WHERE d.doc_type = 'invoice'"""
RECEIPT_LINES = INVOICE_LINES.replace("'invoice'", "'receipt'")


@query(f"""
SELECT count(*) AS total_documents, sum(CAST(doc_type = 'invoice' AS INT)) AS total_invoices,
       CAST(coalesce(sum(sum_line_total) FILTER (WHERE doc_type = 'invoice'), 0) AS {WIDE}) AS invoices_total_value
FROM fx_documents""")
def invoice_overview(spark, sf):
    return reports.invoice_overview(views.documents(spark, sf, names=False))


@query(f"""
SELECT party_name, CAST(coalesce(sum(line_total), 0) AS {WIDE}) AS total_value FROM lines
GROUP BY party_name ORDER BY total_value DESC, party_name LIMIT 5""", lines=INVOICE_LINES)
def invoice_top_parties(spark, sf):
    return reports.invoice_top_parties(views.documents(spark, sf), views.line_items(spark, sf))


@query(f"""
SELECT supplier_name, count(DISTINCT document_id) AS invoices, CAST(coalesce(sum(line_total), 0) AS {WIDE}) AS total_value
FROM lines GROUP BY supplier_name ORDER BY total_value DESC, supplier_name LIMIT 5""", lines=INVOICE_LINES)
def invoice_top_suppliers(spark, sf):
    return reports.invoice_top_suppliers(views.documents(spark, sf), views.line_items(spark, sf))


@query(f"""
SELECT item, count(*) AS lines, CAST(coalesce(sum(line_total), 0) AS {WIDE}) AS total_value
FROM invoiced GROUP BY item ORDER BY total_value DESC, item LIMIT 5""", invoiced=INVOICE_LINES)
def invoice_top_items_by_value(spark, sf):
    return reports.invoice_top_items_by_value(views.documents(spark, sf, names=False), views.line_items(spark, sf))


@query("""
SELECT item, CAST(sum(coalesce(quantity, 1)) AS DECIMAL(28,3)) AS quantity
FROM invoiced GROUP BY item ORDER BY 2 DESC, item LIMIT 5""", invoiced=INVOICE_LINES)
def invoice_top_items_by_frequency(spark, sf):
    return reports.invoice_top_items_by_frequency(views.documents(spark, sf, names=False), views.line_items(spark, sf))


@query("""
SELECT document_id, party_name, sum_line_total, subtotal_meta, tax_meta_pct, diff_sum_vs_subtotal, total_meta
FROM fx_documents WHERE doc_type = 'invoice' AND abs(diff_sum_vs_subtotal) > 0.01""")
def invoice_discrepancies(spark, sf):
    return reports.invoice_discrepancies(views.documents(spark, sf))


@query("""
SELECT count(*) AS docs, CAST(coalesce(sum(total_meta), 0) AS DECIMAL(18,2)) AS total_spent,
       CAST(round(sum(total_meta) / count(total_meta), 2) AS DECIMAL(18,2)) AS avg_ticket
FROM fx_documents WHERE doc_type = 'receipt'""")
def receipt_overview(spark, sf):
    return reports.receipt_overview(views.documents(spark, sf, names=False))


@query("""
SELECT coalesce(supplier_name, 'Unknown') AS merchant, CAST(sum(total_meta) AS DECIMAL(18,2)) AS total
FROM fx_documents WHERE doc_type = 'receipt' GROUP BY 1 ORDER BY total DESC NULLS LAST, merchant LIMIT 5""")
def receipt_top_merchants(spark, sf):
    return reports.receipt_top_merchants(views.documents(spark, sf))


@query("""
SELECT item, CAST(sum(line_total) AS DECIMAL(18,2)) AS total
FROM lines GROUP BY item ORDER BY total DESC NULLS LAST, item LIMIT 5""", lines=RECEIPT_LINES)
def receipt_top_items_by_value(spark, sf):
    return reports.receipt_top_items_by_value(views.documents(spark, sf, names=False), views.line_items(spark, sf))


@query("""
SELECT item, CAST(sum(coalesce(quantity, 1)) AS DECIMAL(28,3)) AS qty
FROM lines GROUP BY item ORDER BY qty DESC NULLS LAST, item LIMIT 5""", lines=RECEIPT_LINES)
def receipt_top_items_by_frequency(spark, sf):
    return reports.receipt_top_items_by_frequency(views.documents(spark, sf, names=False), views.line_items(spark, sf))


@query("""
SELECT document_id, coalesce(supplier_name, 'Unknown') AS merchant, sum_line_total, subtotal_meta, total_meta,
       CAST(round(diff_sum_vs_subtotal, 2) AS DECIMAL(18,2)) AS diff_sum_vs_subtotal
FROM fx_documents WHERE doc_type = 'receipt' AND abs(coalesce(diff_sum_vs_subtotal, 0)) >= 0.03
ORDER BY abs(diff_sum_vs_subtotal) DESC, document_id LIMIT 50""")
def receipt_discrepancies(spark, sf):
    return reports.receipt_discrepancies(views.documents(spark, sf))


def _money(x: str) -> str:
    return f"printf('%,.2f', CAST({x} AS DOUBLE))"


@query(f"""
SELECT section, CAST(rank AS BIGINT) AS rank, label, value FROM (
  SELECT 'invoice_overview' AS section, 1 AS rank, 'total_documents' AS label, CAST(count(*) AS VARCHAR) AS value FROM fx_documents
  UNION ALL SELECT 'invoice_overview', 2, 'total_invoices', CAST(count(*) AS VARCHAR) FROM fx_documents WHERE doc_type = 'invoice'
  UNION ALL SELECT 'invoice_overview', 3, 'invoices_total_value', {_money('sum(sum_line_total)')} FROM fx_documents WHERE doc_type = 'invoice'
  UNION ALL SELECT 'invoice_top_parties', row_number() OVER (ORDER BY v DESC, k), k, {_money('v')} FROM
    (SELECT party_name AS k, coalesce(sum(line_total), 0) AS v FROM ilines GROUP BY 1 ORDER BY v DESC, k LIMIT 5)
  UNION ALL SELECT 'invoice_top_suppliers', row_number() OVER (ORDER BY v DESC, k), k, {_money('v')} FROM
    (SELECT supplier_name AS k, coalesce(sum(line_total), 0) AS v FROM ilines GROUP BY 1 ORDER BY v DESC, k LIMIT 5)
  UNION ALL SELECT 'invoice_top_items_by_value', row_number() OVER (ORDER BY v DESC, k), k, {_money('v')} FROM
    (SELECT item AS k, coalesce(sum(line_total), 0) AS v FROM ilines GROUP BY 1 ORDER BY v DESC, k LIMIT 5)
  UNION ALL SELECT 'invoice_top_items_by_frequency', row_number() OVER (ORDER BY v DESC, k), k, CAST(v AS VARCHAR) FROM
    (SELECT item AS k, CAST(sum(coalesce(quantity, 1)) AS DECIMAL(28,3)) AS v FROM ilines GROUP BY 1 ORDER BY v DESC, k LIMIT 5)
  UNION ALL SELECT 'invoice_discrepancies', row_number() OVER (ORDER BY abs(diff_sum_vs_subtotal) DESC, document_id),
    document_id, {_money('diff_sum_vs_subtotal')}
    FROM fx_documents WHERE doc_type = 'invoice' AND abs(diff_sum_vs_subtotal) > 0.01
  UNION ALL SELECT 'receipt_overview', 1, 'docs', CAST(count(*) AS VARCHAR) FROM fx_documents WHERE doc_type = 'receipt'
  UNION ALL SELECT 'receipt_overview', 2, 'total_spent', CAST(CAST(sum(total_meta) AS DECIMAL(18,2)) AS VARCHAR) FROM fx_documents WHERE doc_type = 'receipt'
  UNION ALL SELECT 'receipt_overview', 3, 'avg_ticket', CAST(CAST(round(avg(total_meta), 2) AS DECIMAL(18,2)) AS VARCHAR) FROM fx_documents WHERE doc_type = 'receipt'
  UNION ALL SELECT 'receipt_top_merchants', row_number() OVER (ORDER BY v DESC, k), k, CAST(v AS VARCHAR) FROM
    (SELECT coalesce(supplier_name, 'Unknown') AS k, CAST(sum(total_meta) AS DECIMAL(18,2)) AS v FROM fx_documents
     WHERE doc_type = 'receipt' GROUP BY 1 ORDER BY v DESC NULLS LAST, k LIMIT 5)
  UNION ALL SELECT 'receipt_top_items_by_value', row_number() OVER (ORDER BY v DESC, k), k, CAST(v AS VARCHAR) FROM
    (SELECT item AS k, CAST(sum(line_total) AS DECIMAL(18,2)) AS v FROM rlines GROUP BY 1 ORDER BY v DESC, k LIMIT 5)
  UNION ALL SELECT 'receipt_top_items_by_frequency', row_number() OVER (ORDER BY v DESC, k), k, CAST(v AS VARCHAR) FROM
    (SELECT item AS k, CAST(sum(coalesce(quantity, 1)) AS DECIMAL(28,3)) AS v FROM rlines GROUP BY 1 ORDER BY v DESC, k LIMIT 5)
  UNION ALL SELECT 'receipt_discrepancies', row_number() OVER (ORDER BY abs(v) DESC, document_id), document_id, CAST(v AS VARCHAR) FROM
    (SELECT document_id, CAST(diff_sum_vs_subtotal AS DECIMAL(18,2)) AS v FROM fx_documents WHERE doc_type = 'receipt'
     AND abs(diff_sum_vs_subtotal) >= 0.03 ORDER BY abs(diff_sum_vs_subtotal) DESC, document_id LIMIT 50))""",
       ilines=INVOICE_LINES, rlines=RECEIPT_LINES)
def report_table(spark, sf):
    # The sections read both many times: they are written once, as a ledger's tables are.
    return reports.report_table(stored(views.documents(spark, sf)), stored(views.line_items(spark, sf)))


@query(f"""
SELECT document_id, party_name, {_money('sum_line_total')} AS sum_line_total, {_money('subtotal_meta')} AS subtotal_meta,
       printf('%.2f%%', CAST(tax_meta_pct AS DOUBLE)) AS tax_meta_pct,
       {_money('diff_sum_vs_subtotal')} AS diff_sum_vs_subtotal, {_money('total_meta')} AS total_meta
FROM fx_documents WHERE doc_type = 'invoice' AND abs(diff_sum_vs_subtotal) > 0.01""")
def invoice_report_discrepancies(spark, sf):
    return reports.invoice_report(views.documents(spark, sf), views.line_items(spark, sf))["discrepancies"]


@query("""
SELECT doc_type, count(*) AS n, CAST(sum(total_meta) AS DECIMAL(28,2)) AS total
FROM fx_documents WHERE doc_type = 'receipt' GROUP BY doc_type""")
def doc_type_filter(spark, sf):
    return (
        reports.of_type(views.documents(spark, sf, names=False), "receipt")
        .groupBy("doc_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_meta").cast("decimal(28,2)").alias("total"))
    )


@query(f"""
SELECT d.doc_type, count(*) AS n, CAST(sum(l.line_total) AS {WIDE}) AS total
FROM fx_documents d JOIN fx_line_items l ON l.document_id = d.document_id GROUP BY d.doc_type""")
def documents_join_line_items(spark, sf):
    docs, items = views.documents(spark, sf, names=False), views.line_items(spark, sf)
    per_document = items.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_total").alias("total")
    )
    return (
        per_document.join(docs.select("document_id", "doc_type"), "document_id")
        .groupBy("doc_type")
        .agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(28,2)").alias("total"))
    )
