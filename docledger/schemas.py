"""Fixed schemas of the bronze, silver and table layers. Nothing is ever inferred."""

from __future__ import annotations

BRONZE_ITEMS = "item string, description string, quantity double, unit_price double, line_total double"

INVOICE_META = (
    "document_number_raw string, document_number string, po_number_raw string, po_number string, "
    "invoice_date string, due_date string, bill_to_name string, bill_to_block string, client_or_supplier string, "
    "bill_from_name string, bill_from_block string, amount_due string, subtotal string, tax string, total string, "
    "currency string, source_path string, extraction_flavor string, ingest_ts string, line_items_rows int"
)

RECEIPT_META = (
    "source_path string, file_hash string, ingest_ts string, extraction_flavor string, ocr_input_variant string, "
    "merchant_name string, tc_code string, txn_datetime_raw string, phone string, items_sold_meta bigint, "
    "items_detected int, discount_meta_val double, subtotal_meta double, tax_meta_val double, tax_meta_pct double, "
    "total_meta double, tendered_meta double, change_due_meta double, currency string, ocr_text_sample string"
)

SILVER_ITEMS = "document_id string, " + BRONZE_ITEMS

SILVER_DOCUMENTS = (
    "document_id string, doc_type string, document_number_raw string, document_number string, party_name string, "
    "supplier_name string, currency string, extraction_flavor string, items_count int, sum_line_total double, "
    "subtotal_meta double, tax_meta_pct double, total_meta double, diff_sum_vs_subtotal double, "
    "diff_sum_vs_total double, source_path string, ingest_ts string, silver_ts string"
)

DOCUMENTS_TABLE = (
    "document_id string, doc_type string, document_number string, party_name string, supplier_name string, "
    "currency string, items_count int, sum_line_total decimal(18,2), subtotal_meta decimal(18,2), "
    "tax_meta_pct decimal(9,4), total_meta decimal(18,2), diff_sum_vs_subtotal decimal(18,2), "
    "diff_sum_vs_total decimal(18,2), source_path string, extraction_flavor string"
)

ITEMS_TABLE = (
    "document_id string, item string, description string, quantity decimal(14,3), unit_price decimal(14,2), "
    "line_total decimal(14,2)"
)


def columns(schema: str) -> list[tuple[str, str]]:
    """``(name, type)`` pairs of a schema text."""
    parts, depth, start = [], 0, 0
    for pos, ch in enumerate(schema + ","):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            name, kind = schema[start:pos].strip().split(" ", 1)
            parts.append((name, kind))
            start = pos + 1
    return parts


def names(schema: str) -> list[str]:
    return [name for name, _ in columns(schema)]
