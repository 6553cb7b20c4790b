"""The views of :mod:`workload.views` as DuckDB common table expressions."""

from __future__ import annotations

from workload.views import LABEL_TEXT_SQL, MONEY_TEXT_SQL


def duck(sql: str) -> str:
    return sql.replace("AS STRING", "AS VARCHAR")


VIEWS: dict[str, str] = {
    "fx_line_items": """
SELECT 'ORD-' || CAST(l.l_orderkey AS VARCHAR) AS document_id, l.l_orderkey AS order_key,
       row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                          l.l_quantity, l.l_extendedprice, l.l_shipdate) AS line_no,
       p.p_name AS item, p.p_type || ' ' || p.p_brand AS description, l.l_suppkey AS supp_key,
       CASE WHEN l.l_orderkey % 13 = 5 THEN NULL ELSE CAST(l.l_quantity AS DECIMAL(14,3)) END AS quantity,
       CAST(p.p_retailprice AS DECIMAL(14,2)) AS unit_price,
       CASE WHEN l.l_orderkey % 7 = 3 THEN NULL
            ELSE CAST(CAST(l.l_quantity AS DECIMAL(14,3)) * CAST(p.p_retailprice AS DECIMAL(14,2)) AS DECIMAL(14,2)) END AS line_total
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "fx_ledger": """
WITH s AS (SELECT order_key, count(*) AS n, CAST(sum(coalesce(line_total, 0)) AS DECIMAL(18,2)) AS v,
                  min(CASE WHEN line_no = 1 THEN supp_key END) AS sk FROM fx_line_items GROUP BY order_key),
b AS (SELECT o.o_orderkey AS k, o.o_orderdate AS dt, c.c_name AS cn, u.s_name AS sn,
             CAST(coalesce(s.n, 0) AS INT) AS items_count, coalesce(s.v, CAST(0 AS DECIMAL(18,2))) AS v
      FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
      LEFT JOIN s ON s.order_key = o.o_orderkey LEFT JOIN supplier u ON u.s_suppkey = s.sk)
SELECT 'ORD-' || CAST(k AS VARCHAR) AS document_id,
       CASE WHEN k % 3 = 0 THEN 'receipt' ELSE 'invoice' END AS doc_type,
       CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS document_number,
       CASE WHEN k % 3 = 0 THEN NULL ELSE cn END AS party_name, sn AS supplier_name, 'USD' AS currency,
       items_count, v AS sum_line_total,
       CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN CAST(v + 25 AS DECIMAL(18,2))
            WHEN k % 10 = 2 THEN CAST(v - 0.01 AS DECIMAL(18,2)) ELSE v END AS subtotal_meta,
       CAST(k % 9 AS DECIMAL(9,4)) AS tax_meta_pct, 'orders/' || CAST(k AS VARCHAR) AS source_path,
       'lattice' AS extraction_flavor, dt AS document_date, k AS order_key
FROM b""",
    "fx_documents": """
SELECT *, CAST(sum_line_total - subtotal_meta AS DECIMAL(18,2)) AS diff_sum_vs_subtotal,
       CAST(sum_line_total - total_meta AS DECIMAL(18,2)) AS diff_sum_vs_total
FROM (SELECT *, CAST(subtotal_meta * (100 + tax_meta_pct) * 0.01 AS DECIMAL(18,2)) AS total_meta FROM fx_ledger)""",
    "fx_invoice_text": """
SELECT document_id, order_key, 'Invoice #: ' || document_number || ' ' || supplier_name || chr(10)
   || 'Bill To: ' || party_name || chr(10) || chr(10)
   || 'Invoice Date: ' || strftime(document_date, '%d/%m/%Y') || chr(10)
   || 'Subtotal: $' || CAST(subtotal_meta AS VARCHAR) || chr(10)
   || 'Tax: ' || CAST(CAST(tax_meta_pct AS DECIMAL(9,2)) AS VARCHAR) || '%' || chr(10)
   || 'Amount Due: $' || CAST(CAST(subtotal_meta * (100 + tax_meta_pct) * 0.01 AS DECIMAL(18,2)) AS VARCHAR) AS text,
   source_path, extraction_flavor
FROM fx_ledger
WHERE doc_type = 'invoice' AND document_number IS NOT NULL AND supplier_name IS NOT NULL AND subtotal_meta IS NOT NULL""",
    "fx_receipts": """
SELECT *, '(' || CAST(200 + order_key % 700 AS VARCHAR) || ') ' || CAST(200 + order_key % 800 AS VARCHAR) || '-'
          || lpad(CAST(1 + order_key % 9999 AS VARCHAR), 4, '0') AS phone,
       strftime(document_date, '%m/%d/%Y') || ' 12:' || lpad(CAST(order_key % 60 AS VARCHAR), 2, '0') AS stamp
FROM fx_ledger WHERE doc_type = 'receipt' AND items_count > 0""",
    "fx_receipt_items": """
SELECT f.* FROM fx_line_items f JOIN fx_receipts d ON d.document_id = f.document_id
WHERE f.quantity IS NOT NULL AND f.line_total IS NOT NULL""",
    "fx_receipt_lines": """
SELECT document_id, -2 AS a, 0 AS b, upper(supplier_name) AS line FROM fx_receipts WHERE supplier_name IS NOT NULL
 UNION ALL SELECT document_id, -1, 0, 'PH ' || phone FROM fx_receipts
 UNION ALL SELECT document_id, line_no, 0, CASE WHEN line_no % 2 = 0 THEN upper(item) || ' ' || CAST(line_total AS VARCHAR) ELSE upper(item) END FROM fx_receipt_items
 UNION ALL SELECT document_id, line_no, 1, CAST(CAST(quantity AS DECIMAL(14,2)) AS VARCHAR) || ' @ ' || CAST(unit_price AS VARCHAR) FROM fx_receipt_items WHERE line_no % 2 = 1
 UNION ALL SELECT document_id, (1::BIGINT << 50) + 0, 0, 'SUBTOTAL $' || CAST(subtotal_meta AS VARCHAR) FROM fx_receipts WHERE subtotal_meta IS NOT NULL
 UNION ALL SELECT document_id, (1::BIGINT << 50) + 1, 0, 'CASH TEND ' || CAST(CAST(sum_line_total + 5 AS DECIMAL(18,2)) AS VARCHAR) FROM fx_receipts
 UNION ALL SELECT document_id, (1::BIGINT << 50) + 2, 0, 'CHANGE DUE 5.00' FROM fx_receipts
 UNION ALL SELECT document_id, (1::BIGINT << 50) + 3, 0, '# ITEMS SOLD ' || CAST(items_count AS VARCHAR) FROM fx_receipts
 UNION ALL SELECT document_id, (1::BIGINT << 50) + 4, 0, 'TC# ' || lpad(CAST(order_key AS VARCHAR), 12, '0') FROM fx_receipts
 UNION ALL SELECT document_id, (1::BIGINT << 50) + 5, 0, stamp FROM fx_receipts""",
    "fx_receipt_text": """
SELECT document_id AS doc_id, string_agg(line, chr(10) ORDER BY a, b) AS text FROM fx_receipt_lines GROUP BY document_id""",
    "fx_table_cells": """
SELECT document_id AS doc_id, 0 AS table_no, 0 AS row_no, list_value('Item', 'Description', 'Qty', 'Unit Price', 'Total') AS cells
FROM fx_line_items WHERE line_no = 1
UNION ALL
SELECT document_id, 0, CAST(line_no AS INT), list_value(item, description, coalesce(CAST(quantity AS VARCHAR), ''),
       '$' || CAST(unit_price AS VARCHAR), coalesce(CAST(line_total AS VARCHAR), ''))
FROM fx_line_items
UNION ALL
SELECT document_id, 0, CAST(1 + max(line_no) AS INT), list_value('Subtotal', '', '', '', coalesce(CAST(CAST(sum(line_total) AS DECIMAL(18,2)) AS VARCHAR), ''))
FROM fx_line_items GROUP BY document_id""",
    "fx_ocr_passes": """
SELECT doc_id, v.variant_no, v.variant, v.pass_no, v.cfg,
       CASE v.pass_no WHEN 0 THEN text WHEN 1 THEN ' ' || text || chr(10) || 'SUBTOTAL 1.00'
                      ELSE text || chr(10) || 'TOTAL 1.00' || chr(10) || 'CHANGE DUE 0.00' END AS text
FROM documents CROSS JOIN (VALUES (0,'gray',0,'psm4'), (0,'gray',1,'psm6'), (1,'bin',0,'psm4'), (1,'bin',2,'psm11'))
     AS v(variant_no, variant, pass_no, cfg)""",
    "fx_money_text": duck(MONEY_TEXT_SQL),
    "fx_label_text": duck(LABEL_TEXT_SQL),
    "fx_doc_lines": """
SELECT doc_id, CAST(unnest(range(len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line
FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
             lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS ls FROM documents)""",
}

NEEDS: dict[str, tuple[str, ...]] = {
    "fx_ledger": ("fx_line_items",),
    "fx_documents": ("fx_ledger",),
    "fx_invoice_text": ("fx_ledger",),
    "fx_receipts": ("fx_ledger",),
    "fx_receipt_items": ("fx_receipts", "fx_line_items"),
    "fx_receipt_lines": ("fx_receipt_items", "fx_receipts"),
    "fx_receipt_text": ("fx_receipt_lines",),
    "fx_table_cells": ("fx_line_items",),
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the views it names, and theirs, in front."""
    extra = extra or {}
    wanted: set[str] = set()

    def visit(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in NEEDS.get(name, ()):
                visit(other)

    for text in (body, *extra.values()):
        for name in VIEWS:
            if name in text:
                visit(name)
    parts = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in wanted]
    parts += [f"{name} AS ({sql})" for name, sql in extra.items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body.strip()
