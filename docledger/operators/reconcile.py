"""Bronze to silver: cleaned items, completed totals, differences and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.functions.numbers import (
    clamp_negative_to_zero,
    int_lenient,
    money_invoice,
    money_silver,
    quantity_or_zero,
    round2,
    tax_percent,
    to_number_or_null,
)
from docledger.functions.dates import parse_receipt_datetime
from docledger.functions.strings import (
    default_currency,
    first_token_with_digit,
    invoice_document_id,
    normalize_merchant,
    receipt_document_id,
    supplier_fallback,
)
from docledger.functions.text import blank_to_null
from docledger.schemas import SILVER_ITEMS, names

SUM_TYPE = "decimal(28,8)"


def fill_line_total_invoice(df: DataFrame) -> DataFrame:
    """A missing total is unit price times quantity, if both are known."""
    return df.withColumn("line_total", F.coalesce("line_total", F.col("unit_price") * F.col("quantity")))


def receipt_line_total(quantity: Column, unit_price: Column, total: Column) -> Column:
    """A missing *or zero* total is unit price times quantity, unknown factors counting as zero."""
    zero = F.lit(0)
    product = F.coalesce(unit_price, zero) * F.coalesce(quantity, zero)
    return F.when(total.isNull() | (total == 0), product).otherwise(total)


def fill_line_total_receipt(df: DataFrame) -> DataFrame:
    total = receipt_line_total(F.col("quantity"), F.col("unit_price"), F.col("line_total"))
    return df.withColumn("line_total", total)


def clean_receipt_array(items: Column) -> Column:
    """:func:`clean_receipt_items` for the items in a document's row. Numbers are read first, so each is parsed once."""
    parsed = F.transform(
        items,
        lambda x: F.struct(
            x["item"].alias("item"),
            x["description"].alias("description"),
            quantity_or_zero(x["quantity"]).alias("quantity"),
            money_silver(x["unit_price"]).alias("unit_price"),
            money_silver(x["line_total"]).alias("line_total"),
        ),
    )
    filled = lambda x: receipt_line_total(x["quantity"], x["unit_price"], x["line_total"])
    return F.transform(
        parsed,
        lambda x: F.struct(
            x["item"].alias("item"),
            x["description"].alias("description"),
            clamp_negative_to_zero(x["quantity"]).alias("quantity"),
            clamp_negative_to_zero(x["unit_price"]).alias("unit_price"),
            clamp_negative_to_zero(filled(x)).alias("line_total"),
        ),
    )


def clean_receipt_items(df: DataFrame) -> DataFrame:
    """Parse the numbers, fill totals, then null and negative values become zero."""
    df = fill_line_total_receipt(
        df.withColumn("quantity", quantity_or_zero(F.col("quantity")))
        .withColumn("unit_price", money_silver(F.col("unit_price")))
        .withColumn("line_total", money_silver(F.col("line_total")))
    )
    for name in ("quantity", "unit_price", "line_total"):
        df = df.withColumn(name, clamp_negative_to_zero(F.col(name)))
    return df


def clean_invoice_items(df: DataFrame) -> DataFrame:
    return fill_line_total_invoice(
        df.withColumn("quantity", to_number_or_null(F.col("quantity")))
        .withColumn("unit_price", money_invoice(F.col("unit_price")))
        .withColumn("line_total", money_invoice(F.col("line_total")))
    )


def document_rollup(items: DataFrame, key: str = "document_id") -> DataFrame:
    """Item count and total per document, null as 0. Decimal sums do not depend on the order of the rows."""
    amount = F.coalesce(F.col("line_total").cast(SUM_TYPE), F.lit(0).cast(SUM_TYPE))
    return items.groupBy(key).agg(
        F.count(F.lit(1)).cast("int").alias("items_count"), F.sum(amount).cast(SUM_TYPE).alias("sum_line_total")
    )


def invoice_total_fallback(total: Column, subtotal: Column, tax_pct: Column, amount_due: Column) -> Column:
    """Stated total, else subtotal with tax, else the amount due."""
    return F.coalesce(total, subtotal * (F.lit(1.0) + tax_pct / 100), amount_due)


def receipt_totals_fallback(df: DataFrame) -> DataFrame:
    """Complete total, subtotal and tax, in this order, then the total once more.

    Expects ``sum_line_total``, the stated amounts and ``tax_meta_pct`` (a fraction for receipts). The discount is
    taken off the subtotal *and* off a total derived from it.
    """
    zero = F.lit(0.0)
    subtotal, discount = F.col("subtotal_meta"), F.coalesce("discount_meta_val", zero)
    paid = F.col("tendered_meta") - F.col("change_due_meta")
    return (
        df.withColumn("total_meta", F.coalesce("total_meta", F.when(paid.isNotNull(), F.greatest(paid, zero))))
        .withColumn("subtotal_meta", F.coalesce("subtotal_meta", F.greatest(F.col("sum_line_total") - discount, zero)))
        .withColumn("tax_meta_val", F.coalesce("tax_meta_val", round2(subtotal * F.col("tax_meta_pct"))))
        .withColumn(
            "total_meta",
            F.coalesce("total_meta", round2(subtotal + F.coalesce("tax_meta_val", zero) - discount)),
        )
    )


def diff_metrics(df: DataFrame) -> DataFrame:
    """Signed differences of the item sum from subtotal and total; null without a target."""
    return df.withColumn("diff_sum_vs_subtotal", F.col("sum_line_total") - F.col("subtotal_meta")).withColumn(
        "diff_sum_vs_total", F.col("sum_line_total") - F.col("total_meta")
    )


def validate_documents(df: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Four checks per document; the tolerance is an absolute amount."""
    value = lambda name: F.coalesce(name, F.lit(0))
    return df.select(
        "document_id",
        (value("items_sold_meta") > 0).alias("items_detected_gt_zero"),
        (value("subtotal_meta") >= 0).alias("subtotal_nonneg"),
        (value("total_meta") >= 0).alias("total_nonneg"),
        (F.abs(value("diff_sum_vs_subtotal")) <= F.lit(tolerance)).alias("subtotal_close_to_sum"),
    )


def validation_summary(checks: DataFrame) -> DataFrame:
    """One row: the number of documents, of those that pass each check of :func:`validate_documents`, and of those that pass all."""
    rules = [c for c in checks.columns if c != "document_id"]
    passed = [F.count_if(F.col(c)).alias(c) for c in rules]
    everything = F.lit(True)
    for c in rules:
        everything = everything & F.col(c)
    return checks.agg(F.count(F.lit(1)).alias("documents"), *passed, F.count_if(everything).alias("all_passed"))


def _with_rollup(meta: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Metadata with item count and sum; a document without items keeps its row."""
    return (
        meta.join(document_rollup(items, key), key, "left")
        .withColumn("items_count", F.coalesce("items_count", F.lit(0)))
        .withColumn("sum_line_total", F.coalesce(F.col("sum_line_total").cast("double"), F.lit(0.0)))
    )


def invoice_silver(meta: DataFrame) -> DataFrame:
    """Silver document columns from bronze metadata that already carries ``items_count`` and ``sum_line_total``."""
    number_raw = F.col("document_number_raw")
    subtotal, tax = money_invoice(F.col("subtotal")), tax_percent(F.col("tax"))
    df = meta.select(
        "*",
        invoice_document_id(
            number_raw, F.col("bill_from_name"), F.col("client_or_supplier"), F.col("invoice_date"), F.col("source_path")
        ).alias("document_id"),
        F.lit("invoice").alias("doc_type"),
        F.col("client_or_supplier").alias("party_name"),
        supplier_fallback(F.col("bill_from_name"), number_raw, F.col("client_or_supplier")).alias("supplier_name"),
        subtotal.alias("subtotal_meta"),
        tax.alias("tax_meta_pct"),
        invoice_total_fallback(money_invoice(F.col("total")), subtotal, tax, money_invoice(F.col("amount_due"))).alias(
            "total_meta"
        ),
    ).withColumn("document_number", first_token_with_digit(number_raw))
    return diff_metrics(df)


def receipt_silver(meta: DataFrame, stem: str, currency: str = "USD") -> DataFrame:
    """Silver document columns from bronze metadata that already carries ``items_count`` and ``sum_line_total``."""
    merchant = normalize_merchant(F.col("merchant_name"))
    txn_date = parse_receipt_datetime(F.col("txn_datetime_raw"))
    df = meta.withColumn("supplier_name", merchant)
    if "currency" not in meta.columns:
        df = df.withColumn("currency", F.lit(None).cast("string"))
    for name in ("subtotal_meta", "total_meta", "tendered_meta", "change_due_meta", "discount_meta_val", "tax_meta_val"):
        df = df.withColumn(name, money_silver(F.col(name)))
    df = (
        df.withColumn("document_id", receipt_document_id(F.col("supplier_name"), F.col(stem), txn_date))
        .withColumn("doc_type", F.lit("receipt"))
        .withColumn("document_number_raw", F.lit(None).cast("string"))
        .withColumn("document_number", F.lit(None).cast("string"))
        .withColumn("party_name", F.lit(None).cast("string"))
        .withColumn("currency", default_currency(F.col("currency"), currency))
        .withColumn("items_sold_meta", int_lenient(F.col("items_sold_meta")))
    )
    # Differences use the exact sum; only the stored one is rounded.
    return diff_metrics(receipt_totals_fallback(df)).withColumn("sum_line_total", round2(F.col("sum_line_total")))


def silver_columns(df: DataFrame, silver_ts: str) -> DataFrame:
    return df.select(
        "document_id",
        "doc_type",
        "document_number_raw",
        "document_number",
        "party_name",
        "supplier_name",
        "currency",
        "extraction_flavor",
        F.col("items_count").cast("int").alias("items_count"),
        "sum_line_total",
        "subtotal_meta",
        "tax_meta_pct",
        "total_meta",
        "diff_sum_vs_subtotal",
        "diff_sum_vs_total",
        "source_path",
        "ingest_ts",
        F.lit(silver_ts).alias("silver_ts"),
    )


def build_invoice_documents(meta: DataFrame, items: DataFrame, key: str, silver_ts: str) -> DataFrame:
    """Silver documents of all invoices; ``key`` joins bronze metadata and bronze items."""
    return silver_columns(invoice_silver(_with_rollup(meta, clean_invoice_items(items), key)), silver_ts)


def build_receipt_documents(meta: DataFrame, items: DataFrame, key: str, silver_ts: str) -> DataFrame:
    """Silver documents of all receipts; ``key`` is the receipt's stem and part of its document id."""
    return silver_columns(receipt_silver(_with_rollup(meta, clean_receipt_items(items), key), key), silver_ts)


def prepend_key(items: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Items with their document's id in front; ``documents`` maps ``key`` to ``document_id``."""
    ids = documents.select(key, "document_id")
    return items.join(ids, key).select(*names(SILVER_ITEMS))


def only_filled(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither missing nor empty."""
    return df.where(blank_to_null(F.col(column)).isNotNull())
