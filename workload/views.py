"""Invoices, receipts, table cells and OCR passes derived from the given tables.

Every view covers whole tables. Views whose rows have an order are numbered in buckets of line numbers, so that no
window sees a whole order of many lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.operators.lineage import stored
from docledger.operators.positions import bucket_of, number_rows

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _numbered(lineitem: DataFrame) -> DataFrame:
    """Line items with ``line_no`` in their order."""
    return number_rows(lineitem, ["l_orderkey"], LINE_ORDER, bucket_of(F.col("l_linenumber")), "_pos").withColumn(
        "line_no", F.col("_pos") + 1
    )


def line_items(spark: SparkSession, sf: str, numbered: bool = False) -> DataFrame:
    """Line items of every order; some quantities and totals are missing on purpose."""
    lineitem = table(spark, sf, "lineitem")
    rows = _numbered(lineitem) if numbered else lineitem
    key = F.col("l_orderkey")
    quantity = F.col("l_quantity").cast("decimal(14,3)")
    price = F.col("p_retailprice").cast("decimal(14,2)")
    extra = ["line_no"] if numbered else []
    return rows.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("ORD-"), key).alias("document_id"),
        key.alias("order_key"),
        *extra,
        F.col("p_name").alias("item"),
        F.concat_ws(" ", "p_type", "p_brand").alias("description"),
        F.col("l_suppkey").alias("supp_key"),
        F.when(key % 13 != 5, quantity).alias("quantity"),
        price.alias("unit_price"),
        F.when(key % 7 != 3, (quantity * price).cast("decimal(14,2)")).alias("line_total"),
    )


def ledger(spark: SparkSession, sf: str, names: bool = True) -> DataFrame:
    """One document per order; every third is a receipt. Without ``names`` both parties and their joins are left out."""
    key = F.col("l_orderkey")
    value = (F.col("l_quantity").cast("decimal(14,3)") * F.col("p_retailprice").cast("decimal(14,2)")).cast("decimal(14,2)")
    sums = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(key % 7 != 3, value).otherwise(F.lit(0).cast("decimal(14,2)"))).alias("v"),
            *([F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey"))["l_suppkey"].alias("sk")] if names else []),
        )
    )
    zero = F.lit(0).cast("decimal(18,2)")
    k, v = F.col("o_orderkey"), F.col("sum_line_total")
    off = lambda by: (v + F.lit(by).cast("decimal(18,2)")).cast("decimal(18,2)")
    orders = table(spark, sf, "orders").join(sums, F.col("l_orderkey") == k, "left")
    parties = []
    if names:
        customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
        orders = orders.join(
            customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"), "left"
        ).join(supplier.select("s_suppkey", "s_name"), F.col("sk") == F.col("s_suppkey"), "left")
        parties = [F.when(k % 3 != 0, F.col("c_name")).alias("party_name"), F.col("s_name").alias("supplier_name")]
    return (
        orders.withColumn("sum_line_total", F.coalesce(F.col("v").cast("decimal(18,2)"), zero))
        .select(
            F.concat(F.lit("ORD-"), k).alias("document_id"),
            F.when(k % 3 == 0, "receipt").otherwise("invoice").alias("doc_type"),
            F.when(k % 11 != 0, k.cast("string")).alias("document_number"),
            *parties,
            F.lit("USD").alias("currency"),
            F.coalesce("n", F.lit(0)).cast("int").alias("items_count"),
            "sum_line_total",
            F.when(k % 10 == 0, F.lit(None))
            .when(k % 10 == 1, off("25"))
            .when(k % 10 == 2, off("-0.01"))
            .otherwise(v)
            .alias("subtotal_meta"),
            (k % 9).cast("decimal(9,4)").alias("tax_meta_pct"),
            F.concat(F.lit("orders/"), k).alias("source_path"),
            F.lit("lattice").alias("extraction_flavor"),
            F.col("o_orderdate").alias("document_date"),
            k.alias("order_key"),
        )
    )


def documents(spark: SparkSession, sf: str, names: bool = True) -> DataFrame:
    """The documents table: the ledger with totals and differences."""
    money = lambda c: c.cast("decimal(18,2)")
    with_tax = F.expr("cast(subtotal_meta * (100 + tax_meta_pct) * 0.01 as decimal(18,2))")
    df = ledger(spark, sf, names).withColumn("total_meta", with_tax)
    v = F.col("sum_line_total")
    return df.withColumn("diff_sum_vs_subtotal", money(v - F.col("subtotal_meta"))).withColumn(
        "diff_sum_vs_total", money(v - F.col("total_meta"))
    )


def invoice_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Page text of each invoice that has a number, a supplier and a subtotal."""
    subtotal, pct = F.col("subtotal_meta"), F.col("tax_meta_pct")
    due = F.expr("cast(subtotal_meta * (100 + tax_meta_pct) * 0.01 as decimal(18,2))")
    text = F.concat(
        F.concat_ws(" ", F.lit("Invoice #:"), "document_number", "supplier_name"),
        F.lit("\nBill To: "),
        "party_name",
        F.lit("\n\nInvoice Date: "),
        F.date_format("document_date", "dd/MM/yyyy"),
        F.lit("\nSubtotal: $"),
        subtotal.cast("string"),
        F.lit("\nTax: "),
        pct.cast("decimal(9,2)").cast("string"),
        F.lit("%\nAmount Due: $"),
        due.cast("string"),
    )
    complete = F.col("document_number").isNotNull() & F.col("supplier_name").isNotNull() & subtotal.isNotNull()
    return (
        ledger(spark, sf)
        .where((F.col("doc_type") == "invoice") & complete)
        .select("document_id", "order_key", text.alias("text"), "source_path", "extraction_flavor")
    )


def receipt_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Printed lines of each receipt as ``(document_id, at, line)``, ordered by ``at``."""
    heads = ledger(spark, sf).where((F.col("doc_type") == "receipt") & (F.col("items_count") > 0))
    k, name = F.col("order_key"), F.upper("item")
    line = lambda at, text: F.struct(F.lit(at).cast("bigint").alias("at"), text.alias("line"))
    cash = (F.col("sum_line_total") + F.lit("5").cast("decimal(18,2)")).cast("decimal(18,2)")
    phone = F.concat(
        F.lit("PH ("), 200 + k % 700, F.lit(") "), 200 + k % 800, F.lit("-"), F.lpad((1 + k % 9999).cast("string"), 4, "0")
    )
    stamp = F.concat(F.date_format("document_date", "MM/dd/yyyy"), F.lit(" 12:"), F.lpad((k % 60).cast("string"), 2, "0"))
    last = 1 << 50
    frame = F.array(
        line(-2, F.upper("supplier_name")),
        line(-1, phone),
        line(last, F.concat(F.lit("SUBTOTAL $"), F.col("subtotal_meta").cast("string"))),
        line(last + 1, F.concat(F.lit("CASH TEND "), cash.cast("string"))),
        line(last + 2, F.lit("CHANGE DUE 5.00")),
        line(last + 3, F.concat(F.lit("# ITEMS SOLD "), "items_count")),
        line(last + 4, F.concat(F.lit("TC# "), F.lpad(k.cast("string"), 12, "0"))),
        line(last + 5, stamp),
    )
    framing = heads.select("document_id", F.inline(frame)).where(F.col("line").isNotNull())
    items = line_items(spark, sf, numbered=True).where(
        (k % 3 == 0) & F.col("quantity").isNotNull() & F.col("line_total").isNotNull()
    )
    no = F.col("line_no")
    total, counted = (F.concat_ws(" ", name, F.col("line_total").cast("string")), F.concat_ws(
        " @ ", F.col("quantity").cast("decimal(14,2)").cast("string"), F.col("unit_price").cast("string")
    ))
    at = lambda half, text: F.struct((2 * no + half).cast("bigint").alias("at"), text.alias("line"))
    printed = F.when(no % 2 == 0, F.array(at(0, total))).otherwise(F.array(at(0, name), at(1, counted)))
    body = items.select("document_id", F.inline(printed))
    return framing.unionByName(body)


def receipt_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Recognised text of each receipt."""
    return (
        receipt_lines(spark, sf)
        .groupBy(F.col("document_id").alias("doc_id"))
        .agg(F.expr("listagg(line, '\\n') WITHIN GROUP (ORDER BY at)").alias("text"))
    )


def table_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Detected table of each order: a header row, its items, a summary row. Written once, as detected cells are."""
    items = line_items(spark, sf, numbered=True)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    doc, no = F.col("document_id").alias("doc_id"), F.col("line_no")
    row = lambda number, cells: (
        doc,
        F.lit(0).alias("table_no"),
        number.cast("int").alias("row_no"),
        cells.alias("cells"),
    )
    header = F.array(*[F.lit(x) for x in ("Item", "Description", "Qty", "Unit Price", "Total")])
    body = F.array(
        "item", "description", text("quantity"), F.concat(F.lit("$"), F.col("unit_price").cast("string")), text("line_total")
    )
    first = F.when(no == 1, F.array(F.struct(F.lit(0).alias("row_no"), header.alias("cells"))))
    each = F.struct(no.cast("int").alias("row_no"), body.alias("cells"))
    rows = items.select(doc, F.lit(0).alias("table_no"), F.inline(F.concat(F.coalesce(first, F.array()), F.array(each))))
    empty = F.lit("")
    sums = line_items(spark, sf).groupBy("document_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_total").cast("decimal(18,2)").alias("line_total")
    )
    summary = sums.select(*row(F.col("n") + 1, F.array(F.lit("Subtotal"), empty, empty, empty, text("line_total"))))
    return stored(rows.unionByName(summary))


def ocr_passes(spark: SparkSession, sf: str) -> DataFrame:
    """Two image variants with two passes each of every document text, with repeated and added lines."""
    text = F.col("text")
    passes = [
        (0, "gray", 0, "psm4", text),
        (0, "gray", 1, "psm6", F.concat(F.lit(" "), text, F.lit("\nSUBTOTAL 1.00"))),
        (1, "bin", 0, "psm4", text),
        (1, "bin", 2, "psm11", F.concat(text, F.lit("\nTOTAL 1.00\nCHANGE DUE 0.00"))),
    ]
    rows = [
        F.struct(
            F.lit(variant_no).alias("variant_no"),
            F.lit(variant).alias("variant"),
            F.lit(pass_no).alias("pass_no"),
            F.lit(cfg).alias("cfg"),
            t.alias("text"),
        )
        for variant_no, variant, pass_no, cfg, t in passes
    ]
    return table(spark, sf, "documents").select("doc_id", F.inline(F.array(*rows)))


def money_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals written in many ways, some of them unreadable."""
    return spark.sql(MONEY_TEXT_SQL.replace("orders", "{orders}"), orders=table(spark, sf, "orders"))


# Written once for both engines.
MONEY_TEXT_SQL = """
SELECT k AS order_key, CASE k % 13
    WHEN 0 THEN '$' || p WHEN 1 THEN '€ ' || replace(p, '.', ',')
    WHEN 2 THEN th || ',' || un || '.' || ct WHEN 3 THEN th || '.' || un || ',' || ct
    WHEN 4 THEN CAST(i AS STRING) WHEN 5 THEN '(' || p || ')' WHEN 6 THEN th || ',' || un || ',000'
    WHEN 7 THEN 'R$ ' || p WHEN 8 THEN '-' || p WHEN 9 THEN '' WHEN 10 THEN 'n/a' WHEN 11 THEN '1e3'
    ELSE NULL END AS text
FROM (SELECT k, i, p, CAST(CAST(floor(i / 1000) AS BIGINT) AS STRING) AS th,
             lpad(CAST(i % 1000 AS STRING), 3, '0') AS un, substr(p, length(p) - 1, 2) AS ct
      FROM (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS i,
                   CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING) AS p FROM orders) AS a) AS b
"""


def label_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Number lines, party names, dates, tax texts and paths of every order, with gaps."""
    return spark.sql(
        LABEL_TEXT_SQL.replace("orders", "{orders}").replace("customer", "{customer}"),
        orders=table(spark, sf, "orders"),
        customer=table(spark, sf, "customer"),
    )


LABEL_TEXT_SQL = """
SELECT k AS order_key,
    CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Invoice #: ' || ks || '  ' || n WHEN 2 THEN ks || ' - 7 ' || n
        WHEN 3 THEN 'INV-' || ks || ' ' || n WHEN 4 THEN n ELSE 'no number' END AS number_raw,
    CASE k % 4 WHEN 0 THEN 'Invoice #: ' || ks || ' ' || n WHEN 1 THEN n WHEN 2 THEN '  12   ' || n || ' & Sons.'
        ELSE NULL END AS supplier,
    n AS client,
    CASE k % 5 WHEN 0 THEN d || '/' || m || '/' || y WHEN 1 THEN d || '-' || m || '-' || substr(y, 3, 2)
        WHEN 2 THEN '7/13/' || y WHEN 3 THEN 'on ' || d || '/' || m || '/' || y || ' net' ELSE NULL END AS date_raw,
    CASE k % 9 WHEN 0 THEN y || '-' || m || '-' || d || ' 08:' || mi || ':07' WHEN 1 THEN y || '-' || m || '-' || d || ' 8:' || mi
        WHEN 2 THEN m || '/' || d || '/' || y || ' 20:' || mi || ':00' WHEN 3 THEN d || '/' || m || '/' || y || ' 20:' || mi
        WHEN 4 THEN y || '-' || m || '-' || d WHEN 5 THEN d || '/' || m || '/' || y WHEN 6 THEN m || '-' || d || '-' || y
        WHEN 7 THEN m || '/' || d || '/' || y || ' 08:' || mi || 'PM' ELSE NULL END AS time_raw,
    CASE k % 7 WHEN 0 THEN t || '%' WHEN 1 THEN t || ',50%' WHEN 2 THEN '0.0' || t WHEN 3 THEN t || '.25 %'
        WHEN 4 THEN '' WHEN 5 THEN 'n/a' ELSE NULL END AS tax_raw,
    CASE k % 4 WHEN 0 THEN 'data' || chr(92) || 'in' || chr(92) || 'Doc ' || ks || '.final.pdf' WHEN 1 THEN 'in/' || ks || '.JPG'
        WHEN 2 THEN 'in/Été_' || ks WHEN 3 THEN NULL END AS path
FROM (SELECT o_orderkey AS k, CAST(o_orderkey AS STRING) AS ks, c_name AS n, CAST(o_orderkey % 9 AS STRING) AS t,
             CAST(year(o_orderdate) AS STRING) AS y, lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m,
             lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d, lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') AS mi
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey) AS a
"""
