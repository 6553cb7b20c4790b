"""Invoice metadata from page text. One narrow projection: no shuffle, whatever the documents' sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.functions.dates import find_label_date
from docledger.functions.strings import detect_currency, document_number_token
from docledger.functions.text import blank_to_null, concat_lines, extract, filled_lines, strip

# Labels and value shapes of the invoice layout.
NUMBER_LINE = r"(?iU)invoice\s*(?:no\.?|number|#)\s*[:#]?\s*([^\n\r]+)"
PO_LINE = r"(?iU)\bpo\s*(?:no\.?|number|#)?\s*[:#]?\s*([^\n\r]+)"
BLOCK_END = r"(?:\n\s*\n|bill\s*from|bill\s*to|invoice|po\s*#?|due\s*date|invoice\s*date|$)"
AMOUNT_DUE = r"(?iU)amount\s*due\s*[:\s]*\$?([0-9,.\-]+)"
SUBTOTAL = r"(?iU)\bsubtotal\s*[:\s]*\$?([0-9,.\-]+)"
TAX = r"(?iU)\btax\s*[:\s]*([0-9,.\-%]+)"
TOTAL = r"(?iU)\btotal\s*[:\s]*\$?([0-9,.\-]+)"


def party_block(text: Column, label: str) -> Column:
    """Stripped lines between a label and the next label, blank line or end of the text."""
    words = r"\s*".join(label.split())
    block = F.regexp_extract(text, rf"(?isU){words}\s*:?\s*(.+?){BLOCK_END}", 1)
    return blank_to_null(concat_lines(filled_lines(block)))


def invoice_parties(df: DataFrame, text: str = "text") -> DataFrame:
    """Add name and block of both parties, and the client: bill-to, else bill-from."""
    first_line = lambda block: F.split_part(F.col(block), F.lit("\n"), F.lit(1))
    return (
        df.withColumn("bill_to_block", party_block(F.col(text), "bill to"))
        .withColumn("bill_from_block", party_block(F.col(text), "bill from"))
        .withColumn("bill_to_name", first_line("bill_to_block"))
        .withColumn("bill_from_name", first_line("bill_from_block"))
        .withColumn("client_or_supplier", F.coalesce("bill_to_name", "bill_from_name"))
    )


def invoice_meta(df: DataFrame, text: str = "text") -> DataFrame:
    """Add numbers, dates, amounts and currency; amounts stay raw text, silver parses them."""
    t = F.col(text)
    return (
        df.withColumn("document_number_raw", blank_to_null(strip(extract(t, NUMBER_LINE))))
        .withColumn("document_number", document_number_token(F.col("document_number_raw")))
        .withColumn("po_number_raw", blank_to_null(strip(extract(t, PO_LINE))))
        .withColumn("po_number", document_number_token(F.col("po_number_raw")))
        .withColumn("invoice_date", find_label_date(t, "invoice date"))
        .withColumn("due_date", find_label_date(t, "due date"))
        .withColumn("amount_due", extract(t, AMOUNT_DUE))
        .withColumn("subtotal", extract(t, SUBTOTAL))
        .withColumn("tax", extract(t, TAX))
        .withColumn("total", extract(t, TOTAL))
        .withColumn("currency", detect_currency(t))
    )
