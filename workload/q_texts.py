"""Lines, invoice texts, receipt texts and OCR passes.

Receipt statements do not repeat the extraction: they state what the texts were printed from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docledger import functions as fn
from docledger.functions.text import filled_lines
from docledger.operators import invoice_text, lines, ocr_passes, receipt_text
from docledger.operators.lineage import stored
from docledger.plans import pipelines
from workload import sql, views
from workload.registry import query

c = F.col


def _docs(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", "text")


# Lines


@query("SELECT doc_id, line_no, line FROM fx_doc_lines")
def explode_lines(spark, sf):
    return lines.explode_lines(_docs(spark, sf))


@query("SELECT doc_id, line_no, line, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS next_line FROM fx_doc_lines")
def next_line_lookahead(spark, sf):
    return lines.next_line_lookahead(_docs(spark, sf))


@query("SELECT doc_id, line_no, line FROM fx_doc_lines WHERE line_no < 10")
def head_lines(spark, sf):
    return lines.head_lines(_docs(spark, sf), 10)


@query("""SELECT doc_id, line_no, line FROM
          (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS back FROM fx_doc_lines) WHERE back <= 40""")
def tail_lines(spark, sf):
    return lines.tail_lines(_docs(spark, sf), 40)


MATCHES = {
    "number_line": ("line ~ '[0-9]{4}'", "[0-9]{4}"),
    "mail_line": ("contains(line, '@')", "@"),
}
MATCH_SQL = ", ".join(f"arg_{{0}}(line, line_no) FILTER (WHERE {cond}) AS {name}" for name, (cond, _) in MATCHES.items())
MATCH_SQL = MATCH_SQL.replace("line ~ '[0-9]{4}'", "regexp_matches(line, '[0-9]{{4}}')")


def _match_fields():
    return {name: (c("line").rlike(pattern), c("line")) for name, (_, pattern) in MATCHES.items()}


@query(f"SELECT doc_id, {MATCH_SQL.format('min')} FROM fx_doc_lines GROUP BY doc_id")
def first_match_wins(spark, sf):
    return lines.first_match_wins(lines.explode_lines(_docs(spark, sf)), ["doc_id"], "line_no", **_match_fields())


@query(f"SELECT doc_id, {MATCH_SQL.format('max')} FROM fx_doc_lines GROUP BY doc_id")
def last_match_wins(spark, sf):
    return lines.last_match_wins(lines.explode_lines(_docs(spark, sf)), ["doc_id"], "line_no", **_match_fields())


@query("SELECT conv_id, sha1(string_agg(coalesce(text, ''), chr(10) ORDER BY turn)) AS text FROM conversations GROUP BY conv_id")
def concat_pages(spark, sf):
    pages = views.table(spark, sf, "conversations")
    return lines.concat_pages(pages, "conv_id", "turn", "text").withColumn("text", F.sha1("text"))


# OCR passes

PASS_LINES = f"""
SELECT doc_id, variant_no, variant, pass_no, CAST(unnest(range(len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line
FROM (SELECT doc_id, variant_no, variant, pass_no, list_filter(list_transform(string_split(text, chr(10)),
      lambda x: {sql.strip('x')}), lambda x: x <> '') AS ls FROM fx_ocr_passes)"""
PASS_FIRST = f"""
SELECT * FROM (SELECT *, lower({sql.collapse('line')}) AS line_key, row_number() OVER
  (PARTITION BY doc_id, variant_no, lower({sql.collapse('line')}) ORDER BY pass_no, line_no) AS nth FROM pass_lines) WHERE nth = 1"""


def _score(x: str) -> str:
    words = ", ".join(f"'{w}'" for w in fn.RECEIPT_KEYWORDS)
    return f"CAST(len(list_filter(list_value({words}), lambda w: contains(lower({x}), w))) AS INTEGER)"


SCORED = f"SELECT doc_id, variant_no, variant, pass_no, cfg, {_score('text')} AS score FROM fx_ocr_passes"
RANKED = """
SELECT doc_id, variant_no, variant, cfg, score FROM
  (SELECT *, row_number() OVER (PARTITION BY doc_id, variant_no ORDER BY score DESC, pass_no) AS nth FROM scored) WHERE nth = 1"""
MERGED = f"""
SELECT r.doc_id, r.variant_no, r.variant, r.cfg, coalesce(t.text, '') AS text, {_score("coalesce(t.text, '')")} AS score
FROM ranked_passes r LEFT JOIN (SELECT doc_id, variant_no, string_agg(line, chr(10) ORDER BY pass_no, line_no) AS text
                         FROM pass_first GROUP BY doc_id, variant_no) t USING (doc_id, variant_no)"""
MERGING = {"pass_lines": PASS_LINES, "pass_first": PASS_FIRST, "scored": SCORED, "ranked_passes": RANKED, "merged": MERGED}


@query("SELECT doc_id, variant_no, variant, pass_no, line_no, line FROM pass_first",
       pass_lines=PASS_LINES, pass_first=PASS_FIRST)
def dedup_lines_keep_first(spark, sf):
    rows = lines.explode_lines(views.ocr_passes(spark, sf).drop("cfg"))
    return lines.dedup_lines_keep_first(
        rows, ocr_passes.VARIANT, fn.line_key(c("line")), ["pass_no", "line_no"], "line"
    ).drop("line_key")


@query("SELECT doc_id, variant_no, variant, cfg, score FROM ranked_passes", scored=SCORED, ranked_passes=RANKED)
def rank_ocr_pass(spark, sf):
    return ocr_passes.rank_ocr_pass(views.ocr_passes(spark, sf))


@query("SELECT doc_id, variant_no, variant, cfg, sha1(text) AS text, score FROM merged", **MERGING)
def merge_ocr_passes(spark, sf):
    return ocr_passes.merge_ocr_passes(views.ocr_passes(spark, sf)).withColumn("text", F.sha1("text"))


BEST_VARIANT = "(SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, variant_no) AS nth FROM merged) WHERE nth = 1"


@query(f"SELECT doc_id, variant, score FROM {BEST_VARIANT}", **MERGING)
def rank_ocr_variant(spark, sf):
    return ocr_passes.rank_ocr_variant(ocr_passes.merge_ocr_passes(views.ocr_passes(spark, sf)))


@query(
    f"""SELECT doc_id, variant AS ocr_input_variant, variant || ':' || cfg AS extraction_flavor, sha1(text) AS text, score
        FROM {BEST_VARIANT}""",
    **MERGING,
)
def choose_ocr_variant(spark, sf):
    merged = ocr_passes.merge_ocr_passes(views.ocr_passes(spark, sf))
    return ocr_passes.choose_ocr_variant(merged).withColumn("text", F.sha1("text"))


# Invoice texts


@query("""
SELECT t.document_id, d.document_number || ' ' || d.supplier_name AS document_number_raw, d.document_number,
       CAST(NULL AS VARCHAR) AS po_number_raw, CAST(NULL AS VARCHAR) AS po_number,
       strftime(d.document_date, '%d/%m/%Y') AS invoice_date, CAST(NULL AS VARCHAR) AS due_date,
       CAST(CAST(d.subtotal_meta * (100 + d.tax_meta_pct) * 0.01 AS DECIMAL(18,2)) AS VARCHAR) AS amount_due,
       CAST(d.subtotal_meta AS VARCHAR) AS subtotal, CAST(CAST(d.tax_meta_pct AS DECIMAL(9,2)) AS VARCHAR) || '%' AS tax,
       CAST(NULL AS VARCHAR) AS total, 'USD' AS currency
FROM fx_invoice_text t JOIN fx_ledger d ON d.document_id = t.document_id""")
def invoice_meta(spark, sf):
    texts = views.invoice_texts(spark, sf).select("document_id", "text")
    return invoice_text.invoice_meta(texts).drop("text")


@query("""
SELECT t.document_id, d.party_name AS bill_to_block, CAST(NULL AS VARCHAR) AS bill_from_block, d.party_name AS bill_to_name,
       CAST(NULL AS VARCHAR) AS bill_from_name, d.party_name AS client_or_supplier
FROM fx_invoice_text t JOIN fx_ledger d ON d.document_id = t.document_id""")
def invoice_parties(spark, sf):
    texts = views.invoice_texts(spark, sf).select("document_id", "text")
    return invoice_text.invoice_parties(texts).drop("text")


# Receipt texts


def _receipt(spark, sf):
    return views.receipt_texts(spark, sf).withColumn("lines", filled_lines(c("text")))


def _field(name: str, expression, oracle: str):
    query(f"SELECT document_id AS doc_id, {oracle} AS value FROM fx_receipts", name=name)(
        lambda spark, sf: _receipt(spark, sf).select("doc_id", expression().alias("value"))
    )


_field(
    "receipt_merchant",
    lambda: receipt_text.receipt_merchant(c("text"), c("lines")),
    "coalesce(upper(replace(supplier_name, '#', '')), 'PH ' || regexp_replace(phone, '[()]', '', 'g'))",
)
_field("receipt_tc_code", lambda: receipt_text.receipt_tc_code(c("lines")), "lpad(CAST(order_key AS VARCHAR), 12, '0')")
_field("receipt_datetime_raw", lambda: receipt_text.receipt_datetime_raw(c("lines")), "stamp")
_field("receipt_items_sold", lambda: receipt_text.receipt_items_sold(c("lines")), "CAST(items_count AS BIGINT)")
_field("receipt_phone_printed", lambda: receipt_text.receipt_phone(c("lines")), "phone")

PHONES = r"""
SELECT doc_id, line_no, CAST(unnest(range(len(ms))) AS INTEGER) AS match_no, unnest(ms) AS digits
FROM (SELECT doc_id, line_no, list_transform(regexp_extract_all(line, '\(?\s*(\d{3})\s*\)?\D*\s*(\d{3})\D*\s*(\d{4})'),
             lambda m: regexp_replace(m, '\D', '', 'g')) AS ms FROM fx_doc_lines WHERE line_no < 40)"""
MARKED = """
SELECT *, digits[1] IN ('0', '1') OR digits[4:6] = '000' OR digits[7:10] = '0000' AS bad,
       length(digits) - length(replace(digits, '0', '')) AS zeros FROM phones"""


@query("SELECT doc_id, line_no, match_no, bad, zeros, digits FROM marked", phones=PHONES, marked=MARKED)
def phone_candidates(spark, sf):
    rows = _docs(spark, sf).withColumn("lines", filled_lines(c("text")))
    found = rows.select("doc_id", F.inline(receipt_text.phone_candidates(c("lines"))))
    return found.select("doc_id", "line_no", "match_no", "bad", "zeros", F.concat("area", "office", "number").alias("digits"))


@query(
    """SELECT d.doc_id, CASE WHEN p.digits[1] NOT IN ('0', '1')
              THEN '(' || p.digits[1:3] || ') ' || p.digits[4:6] || '-' || p.digits[7:10] END AS phone
       FROM documents d LEFT JOIN (SELECT *, row_number() OVER
            (PARTITION BY doc_id ORDER BY bad, zeros, line_no, match_no) AS nth FROM marked) p
       ON p.doc_id = d.doc_id AND p.nth = 1""",
    phones=PHONES,
    marked=MARKED,
)
def receipt_phone(spark, sf):
    rows = _docs(spark, sf).withColumn("lines", filled_lines(c("text")))
    return rows.select("doc_id", receipt_text.receipt_phone(c("lines")).alias("phone"))


@query("""
SELECT document_id AS doc_id, CAST(NULL AS DOUBLE) AS discount_meta_val, CAST(subtotal_meta AS DOUBLE) AS subtotal_meta,
       CAST(NULL AS DOUBLE) AS total_meta, CAST(sum_line_total + 5 AS DOUBLE) AS tendered_meta, 5.0::DOUBLE AS change_due_meta,
       CAST(NULL AS DOUBLE) AS tax_meta_val, CAST(NULL AS DOUBLE) AS tax_meta_pct
FROM fx_receipts""")
def receipt_totals(spark, sf):
    return receipt_text.receipt_totals(_receipt(spark, sf)).drop("lines", "text")


@query("""
SELECT document_id AS doc_id, CAST(sum_line_total AS DOUBLE) AS total_meta, CAST(subtotal_meta AS DOUBLE) AS subtotal_meta,
       CAST(NULL AS DOUBLE) AS tax_meta_val
FROM fx_receipts""")
def derive_totals_from_text(spark, sf):
    totals = receipt_text.derive_totals_from_text(receipt_text.receipt_totals(_receipt(spark, sf)))
    return totals.select("doc_id", "total_meta", "subtotal_meta", "tax_meta_val")


ITEMS = f"""
SELECT document_id AS doc_id, {sql.item_name('upper(item)')} AS item, '' AS description,
       CASE WHEN line_no % 2 = 1 THEN CAST(quantity AS DOUBLE) ELSE 1 END AS quantity,
       CASE WHEN line_no % 2 = 1 THEN CAST(unit_price AS DOUBLE) ELSE CAST(line_total AS DOUBLE) END AS unit_price,
       CAST(line_total AS DOUBLE) AS line_total
FROM fx_receipt_items"""


@query(ITEMS)
def receipt_items(spark, sf):
    texts = views.receipt_texts(spark, sf)
    return receipt_text.explode_items(
        texts.select("doc_id", receipt_text.receipt_items(c("text")).alias("items"))
    ).drop("line_no")


@query("""
SELECT document_id AS doc_id, line_no, CASE WHEN line_no % 2 = 1 THEN upper(item) END AS name
FROM fx_receipt_items WHERE line_no % 2 = 1""")
def name_lookback(spark, sf):
    """Name found above each ``qty @ price`` line, by the printed line's number."""
    found = receipt_text.name_lookback(views.receipt_texts(spark, sf))
    items = views.line_items(spark, sf, numbered=True).where(
        (c("order_key") % 3 == 0) & c("quantity").isNotNull() & c("line_total").isNotNull() & (c("line_no") % 2 == 1)
    )
    seen = found.where(c("line").contains("@")).select("doc_id", "name")
    numbered = items.select(c("document_id").alias("doc_id"), "line_no", F.upper("item").alias("name"))
    return numbered.join(seen.distinct(), ["doc_id", "name"]).select("doc_id", "line_no", "name")


@query("""
SELECT d.document_id AS doc_id, coalesce(upper(replace(d.supplier_name, '#', '')), 'PH') AS merchant_name,
       lpad(CAST(d.order_key AS VARCHAR), 12, '0') AS tc_code, d.stamp AS txn_datetime_raw, d.phone,
       CAST(d.items_count AS BIGINT) AS items_sold_meta, CAST(coalesce(i.n, 0) AS INTEGER) AS items_detected,
       CAST(NULL AS DOUBLE) AS discount_meta_val, CAST(d.subtotal_meta AS DOUBLE) AS subtotal_meta,
       CAST(NULL AS DOUBLE) AS tax_meta_val, CAST(NULL AS DOUBLE) AS tax_meta_pct, CAST(d.sum_line_total AS DOUBLE) AS total_meta,
       CAST(d.sum_line_total + 5 AS DOUBLE) AS tendered_meta, 5.0::DOUBLE AS change_due_meta, sha1(t.text) AS ocr_text_sample
FROM fx_receipts d JOIN fx_receipt_text t ON t.doc_id = d.document_id
LEFT JOIN (SELECT document_id, count(*) AS n FROM fx_receipt_items GROUP BY document_id) i ON i.document_id = d.document_id""")
def receipt_meta(spark, sf):
    bronze = pipelines.receipt_meta(views.receipt_texts(spark, sf), "2024-01-01T00:00:00")
    return bronze.drop("items", "ingest_ts").withColumn("ocr_text_sample", F.sha1("ocr_text_sample"))


RECEIPT_DOCS = f"""
SELECT 'SUPPLIER-' || d.document_id || '-' || strftime(d.document_date, '%Y%m%d') AS document_id, 'receipt' AS doc_type,
       CAST(NULL AS VARCHAR) AS document_number_raw, CAST(NULL AS VARCHAR) AS document_number, CAST(NULL AS VARCHAR) AS party_name,
       {sql.merchant("replace(d.supplier_name, '#', '')")} AS supplier_name,
       'USD' AS currency, d.extraction_flavor, CAST(coalesce(i.n, 0) AS INTEGER) AS items_count,
       CAST(coalesce(i.v, 0) AS DOUBLE) AS sum_line_total,
       CAST(coalesce(d.subtotal_meta, i.v, 0) AS DOUBLE) AS subtotal_meta, CAST(NULL AS DOUBLE) AS tax_meta_pct,
       CAST(d.sum_line_total AS DOUBLE) AS total_meta,
       CAST(coalesce(i.v, 0) AS DOUBLE) - CAST(coalesce(d.subtotal_meta, i.v, 0) AS DOUBLE) AS diff_sum_vs_subtotal,
       CAST(coalesce(i.v, 0) AS DOUBLE) - CAST(d.sum_line_total AS DOUBLE) AS diff_sum_vs_total,
       d.source_path
FROM fx_receipts d
LEFT JOIN (SELECT document_id, count(*) AS n, sum(line_total) AS v FROM fx_receipt_items GROUP BY document_id) i
  ON i.document_id = d.document_id"""


def _receipt_bronze(spark, sf):
    texts = views.receipt_texts(spark, sf).withColumn("extraction_flavor", F.lit("lattice"))
    texts = texts.withColumn("source_path", F.concat(F.lit("orders/"), F.regexp_extract("doc_id", "[0-9]+", 0)))
    return pipelines.receipt_meta(texts, "2024-01-01T00:00:00")


@query(RECEIPT_DOCS)
def build_receipt_documents(spark, sf):
    """From text to silver without a join: items stay in their document's row."""
    return pipelines.receipt_batch(_receipt_bronze(spark, sf), "2024-01-01T00:00:00").documents.drop("ingest_ts", "silver_ts")


@query(RECEIPT_DOCS, name="build_receipt_documents_from_tables")
def _receipts_from_tables(spark, sf):
    """The same from separate metadata and item tables."""
    from docledger.operators import reconcile

    # Two tables are derived from bronze, and extraction is the costly part: it is written once.
    bronze = stored(_receipt_bronze(spark, sf))
    items = receipt_text.explode_items(bronze.select("doc_id", "items"))
    documents = reconcile.build_receipt_documents(bronze.drop("items"), items, "doc_id", "2024-01-01T00:00:00")
    return documents.drop("ingest_ts", "silver_ts")
