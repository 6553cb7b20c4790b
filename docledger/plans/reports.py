"""Invoice and receipt report sections, each a DataFrame, and their common long form.

Rankings join line items to documents. Line items are summed up per document (and item) *before* that join, so a
document with very many lines comes to it as a few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions.numbers import exact, fmt_money, fmt_pct
from docledger.operators.positions import ranked

WIDE = "decimal(28,2)"
MONEY = "decimal(18,2)"
INVOICE_THRESHOLD, RECEIPT_THRESHOLD, TOP_N, AUDIT_ROWS = 0.01, 0.03, 5, 50


def of_type(documents: DataFrame, doc_type: str) -> DataFrame:
    """Documents of one type; prunes partitions where the table is partitioned by type."""
    return documents.where(F.col("doc_type") == doc_type)


def _top(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The ``n`` largest values; equal ones in key order."""
    return df.orderBy(F.desc_nulls_last(value), F.asc_nulls_last(key)).limit(n)


def _sum(name: str) -> Column:
    return F.sum(name).cast(WIDE)


def _zero_sum(name: str) -> Column:
    return F.coalesce(_sum(name), F.lit(0).cast(WIDE))


def _document_values(line_items: DataFrame) -> DataFrame:
    return line_items.groupBy("document_id").agg(_sum("line_total").alias("value"))


def _items_of(documents: DataFrame, line_items: DataFrame, doc_type: str, value: Column) -> DataFrame:
    """``value`` per item over the documents of a type, with the number of lines."""
    rows = line_items.join(of_type(documents, doc_type).select("document_id"), "document_id", "left_semi")
    return rows.groupBy("item").agg(F.count(F.lit(1)).alias("lines"), value.alias("value"))


def _quantity() -> Column:
    return F.sum(F.coalesce("quantity", F.lit(1).cast("decimal(14,3)"))).cast("decimal(28,3)")


def invoice_overview(documents: DataFrame) -> DataFrame:
    """All documents, invoices, and the value of the invoices."""
    is_invoice = F.col("doc_type") == "invoice"
    return documents.agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.count_if(is_invoice).alias("total_invoices"),
        F.coalesce(F.sum(F.when(is_invoice, F.col("sum_line_total"))).cast(WIDE), F.lit(0).cast(WIDE)).alias(
            "invoices_total_value"
        ),
    )


def invoice_top_parties(documents: DataFrame, line_items: DataFrame, n: int = TOP_N) -> DataFrame:
    invoices = of_type(documents, "invoice").select("document_id", "party_name")
    totals = (
        _document_values(line_items)
        .join(invoices, "document_id")
        .groupBy("party_name")
        .agg(_zero_sum("value").alias("total_value"))
    )
    return _top(totals, "total_value", "party_name", n)


def invoice_top_suppliers(documents: DataFrame, line_items: DataFrame, n: int = TOP_N) -> DataFrame:
    supplier = F.coalesce("supplier_name", F.lit("Unknown")).alias("supplier_name")
    invoices = of_type(documents, "invoice").select("document_id", supplier)
    totals = (
        _document_values(line_items)
        .join(invoices, "document_id")
        .groupBy("supplier_name")
        .agg(F.count(F.lit(1)).alias("invoices"), _zero_sum("value").alias("total_value"))
    )
    return _top(totals, "total_value", "supplier_name", n)


def invoice_top_items_by_value(documents: DataFrame, line_items: DataFrame, n: int = TOP_N) -> DataFrame:
    totals = _items_of(documents, line_items, "invoice", _zero_sum("line_total"))
    totals = totals.withColumnRenamed("value", "total_value")
    return _top(totals, "total_value", "item", n)


def invoice_top_items_by_frequency(documents: DataFrame, line_items: DataFrame, n: int = TOP_N) -> DataFrame:
    totals = _items_of(documents, line_items, "invoice", _quantity()).select("item", F.col("value").alias("quantity"))
    return _top(totals, "quantity", "item", n)


def _diff_size() -> Column:
    return F.abs(F.coalesce("diff_sum_vs_subtotal", F.lit(0).cast(MONEY)))


def invoice_discrepancies(documents: DataFrame, threshold: float = INVOICE_THRESHOLD) -> DataFrame:
    """Invoices whose subtotal is off by *more than* the threshold, largest first."""
    return (
        of_type(documents, "invoice")
        .where(_diff_size() > exact(threshold))
        .orderBy(F.desc(_diff_size()), "document_id")
        .select(
            "document_id",
            "party_name",
            "sum_line_total",
            "subtotal_meta",
            "tax_meta_pct",
            "diff_sum_vs_subtotal",
            "total_meta",
        )
    )


def receipt_overview(documents: DataFrame) -> DataFrame:
    return of_type(documents, "receipt").agg(
        F.count(F.lit(1)).alias("docs"),
        F.coalesce(F.sum("total_meta"), F.lit(0)).cast(MONEY).alias("total_spent"),
        F.avg("total_meta").cast(MONEY).alias("avg_ticket"),
    )


def receipt_top_merchants(documents: DataFrame, n: int = TOP_N) -> DataFrame:
    """Stated totals per merchant, without the line items."""
    totals = (
        of_type(documents, "receipt")
        .groupBy(F.coalesce("supplier_name", F.lit("Unknown")).alias("merchant"))
        .agg(F.sum("total_meta").cast(MONEY).alias("total"))
    )
    return _top(totals, "total", "merchant", n)


def receipt_top_items_by_value(documents: DataFrame, line_items: DataFrame, n: int = TOP_N) -> DataFrame:
    totals = _items_of(documents, line_items, "receipt", F.sum("line_total").cast(MONEY))
    totals = totals.select("item", F.col("value").alias("total"))
    return _top(totals, "total", "item", n)


def receipt_top_items_by_frequency(documents: DataFrame, line_items: DataFrame, n: int = TOP_N) -> DataFrame:
    totals = _items_of(documents, line_items, "receipt", _quantity()).select("item", F.col("value").alias("qty"))
    return _top(totals, "qty", "item", n)


def receipt_discrepancies(
    documents: DataFrame, threshold: float = RECEIPT_THRESHOLD, rows: int = AUDIT_ROWS
) -> DataFrame:
    """Receipts whose subtotal is off by *at least* the threshold, the ``rows`` largest."""
    return (
        of_type(documents, "receipt")
        .where(_diff_size() >= exact(threshold))
        .orderBy(F.desc(_diff_size()), "document_id")
        .limit(rows)
        .select(
            "document_id",
            F.coalesce("supplier_name", F.lit("Unknown")).alias("merchant"),
            "sum_line_total",
            "subtotal_meta",
            "total_meta",
            F.round("diff_sum_vs_subtotal", 2).cast(MONEY).alias("diff_sum_vs_subtotal"),
        )
    )


def invoice_report(
    documents: DataFrame, line_items: DataFrame, threshold: float = INVOICE_THRESHOLD, top_n: int = TOP_N
) -> dict[str, DataFrame]:
    """The six invoice sections; money and percent columns written as text, as on the page."""

    def written(df: DataFrame, *money: str) -> DataFrame:
        for name in money:
            df = df.withColumn(name, fmt_money(F.col(name)))
        return df

    discrepancies = written(
        invoice_discrepancies(documents, threshold),
        "sum_line_total",
        "subtotal_meta",
        "diff_sum_vs_subtotal",
        "total_meta",
    ).withColumn("tax_meta_pct", fmt_pct(F.col("tax_meta_pct")))
    return {
        "overview": written(invoice_overview(documents), "invoices_total_value"),
        "top_parties": written(invoice_top_parties(documents, line_items, top_n), "total_value"),
        "top_suppliers": written(invoice_top_suppliers(documents, line_items, top_n), "total_value"),
        "top_items_by_value": written(invoice_top_items_by_value(documents, line_items, top_n), "total_value"),
        "top_items_by_frequency": invoice_top_items_by_frequency(documents, line_items, top_n),
        "discrepancies": discrepancies,
    }


def receipt_report(
    documents: DataFrame, line_items: DataFrame, threshold: float = RECEIPT_THRESHOLD, top_n: int = TOP_N
) -> dict[str, DataFrame]:
    """The five receipt sections."""
    return {
        "overview": receipt_overview(documents),
        "top_merchants": receipt_top_merchants(documents, top_n),
        "top_items_by_value": receipt_top_items_by_value(documents, line_items, top_n),
        "top_items_by_frequency": receipt_top_items_by_frequency(documents, line_items, top_n),
        "discrepancies": receipt_discrepancies(documents, threshold),
    }


SORT = "decimal(38,3)"


def _entry(section: str, value: Column, key: Column, written: Column, when: Column) -> Column:
    """One line of the long form, null where the section has no such line; lines are ranked by value, then by key."""
    line = F.struct(F.lit(section).alias("section"), value.cast(SORT).alias("sort"), key.alias("label"), written.alias("value"))
    return F.when(when, line)


def _document_entries(documents: DataFrame, line_items: DataFrame) -> DataFrame:
    """Lines of the overviews and of the rankings by party, supplier and merchant.

    Documents meet the sums of their items once; one aggregate with grouping sets then makes all of these groups.
    """
    col, lit = F.col, F.lit
    kept = ["document_id", "doc_type", "party_name", "sum_line_total", "total_meta"]
    sums = line_items.groupBy("document_id").agg(_sum("line_total").alias("items_value"), lit(1).alias("has_items"))
    # The type is there twice: a column of the grouping sets is null in those that leave it out.
    rows = documents.select(*kept, col("doc_type").alias("of_type"), F.coalesce("supplier_name", lit("Unknown")).alias("supplier"), lit(1).alias("n")).join(sums, "document_id", "left")
    # A row that counts for nothing, so that the overviews of no documents are zeros and not missing.
    none = documents.sparkSession.range(1).select(lit(0).alias("n"))
    rows = rows.unionByName(none, allowMissingColumns=True)
    invoice, receipt = col("doc_type") == "invoice", col("doc_type") == "receipt"
    groups = rows.groupingSets([[], ["doc_type", "party_name"], ["doc_type", "supplier"]], "doc_type", "party_name", "supplier").agg(
        F.grouping_id().alias("level"),
        F.sum("n").cast("bigint").alias("docs"),
        F.count_if(col("of_type") == "invoice").alias("invoices"),
        F.count_if(col("of_type") == "receipt").alias("receipts"),
        F.sum(F.when(col("of_type") == "invoice", col("sum_line_total"))).cast(WIDE).alias("invoiced"),
        F.sum(F.when(col("of_type") == "receipt", col("total_meta"))).alias("spent"),
        F.avg(F.when(col("of_type") == "receipt", col("total_meta"))).cast(MONEY).alias("ticket"),
        F.sum("has_items").alias("with_items"),
        _zero_sum("items_value").alias("items_value"),
    )
    # Bits of the level: which of the three columns are not grouped by.
    overall, by_party, by_supplier = (col("level") == level for level in (7, 1, 2))
    zero = lit(0).cast(WIDE)
    written = [
        ("invoice_overview", 1, "total_documents", col("docs").cast("string")),
        ("invoice_overview", 2, "total_invoices", col("invoices").cast("string")),
        ("invoice_overview", 3, "invoices_total_value", fmt_money(F.coalesce("invoiced", zero))),
        ("receipt_overview", 1, "docs", col("receipts").cast("string")),
        ("receipt_overview", 2, "total_spent", F.coalesce("spent", lit(0)).cast(MONEY).cast("string")),
        ("receipt_overview", 3, "avg_ticket", col("ticket").cast("string")),
    ]
    lines = [_entry(section, lit(-place), lit(label), text, overall) for section, place, label, text in written]
    money, merchant = fmt_money(col("items_value")), col("spent").cast(MONEY)
    lines += [
        _entry("invoice_top_parties", col("items_value"), col("party_name"), money, by_party & invoice & (col("with_items") > 0)),
        _entry("invoice_top_suppliers", col("items_value"), col("supplier"), money, by_supplier & invoice & (col("with_items") > 0)),
        _entry("receipt_top_merchants", merchant, col("supplier"), merchant.cast("string"), by_supplier & receipt),
    ]
    return groups.select(F.inline(F.filter(F.array(*lines), lambda x: x.isNotNull())))


def _item_entries(documents: DataFrame, line_items: DataFrame) -> DataFrame:
    """Lines of the item rankings of both types, by value and by quantity, from one aggregate."""
    col = F.col
    rows = line_items.join(documents.select("document_id", "doc_type").where(col("doc_type").isin("invoice", "receipt")), "document_id")
    groups = rows.groupBy("doc_type", "item").agg(_sum("line_total").alias("total"), _quantity().alias("quantity"))
    invoice, receipt = col("doc_type") == "invoice", col("doc_type") == "receipt"
    value, spent = F.coalesce("total", F.lit(0).cast(WIDE)), col("total").cast(MONEY)
    count = col("quantity").cast("string")
    lines = [
        _entry("invoice_top_items_by_value", value, col("item"), fmt_money(value), invoice),
        _entry("invoice_top_items_by_frequency", col("quantity"), col("item"), count, invoice),
        _entry("receipt_top_items_by_value", spent, col("item"), spent.cast("string"), receipt),
        _entry("receipt_top_items_by_frequency", col("quantity"), col("item"), count, receipt),
    ]
    return groups.select(F.inline(F.filter(F.array(*lines), lambda x: x.isNotNull())))


def report_table(
    documents: DataFrame,
    line_items: DataFrame,
    invoice_threshold: float = INVOICE_THRESHOLD,
    receipt_threshold: float = RECEIPT_THRESHOLD,
    top_n: int = TOP_N,
) -> DataFrame:
    """Both reports as one long table ``(section, rank, label, value)``, values as text.

    Items are read twice: once for the sums of documents, once for the sums of items. All bounded sections are ranked by one
    window, which Spark limits before its exchange; the invoice discrepancies, of any number, by :func:`ranked`.
    """
    col = F.col
    off = receipt_discrepancies(documents, receipt_threshold, max(AUDIT_ROWS, top_n)).select(
        F.lit("receipt_discrepancies").alias("section"),
        F.abs("diff_sum_vs_subtotal").cast(SORT).alias("sort"),
        col("document_id").alias("label"),
        col("diff_sum_vs_subtotal").cast("string").alias("value"),
    )
    lines = _document_entries(documents, line_items).unionByName(_item_entries(documents, line_items)).unionByName(off)
    order = [F.desc_nulls_last("sort"), F.asc_nulls_last("label")]
    placed = lines.withColumn("rank", F.row_number().over(Window.partitionBy("section").orderBy(*order)))
    long = col("section").isin("invoice_overview", "receipt_overview", "receipt_discrepancies")
    placed = placed.where(col("rank") <= max(AUDIT_ROWS, top_n)).where(long | (col("rank") <= top_n))
    bounded = placed.select("section", col("rank").cast("bigint").alias("rank"), "label", "value")
    found = invoice_discrepancies(documents, invoice_threshold).select(
        F.abs("diff_sum_vs_subtotal").alias("sort"), col("document_id").alias("label"), fmt_money(col("diff_sum_vs_subtotal")).alias("value")
    )
    audited = ranked(found, [F.desc_nulls_last("sort"), F.asc_nulls_last("label")])
    return bounded.unionByName(audited.select(F.lit("invoice_discrepancies").alias("section"), "rank", "label", "value"))
