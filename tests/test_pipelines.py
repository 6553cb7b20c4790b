"""Files, loading rules and whole runs, with the shapes and totals a user of the reports knows."""

import json
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docledger import schemas
from docledger.operators import reconcile, tables
from docledger.plans import gold, pipelines, reports
from docledger.sources import files
from docledger.sources.ledger import Ledger

STAMP = "2024-01-01T00:00:00"


def invoice_text(number, supplier, client, day, subtotal, tax, due):
    return (
        f"Invoice #: {number} {supplier}\nBill From: {supplier}\nBill To: {client}\n\nInvoice Date: {day}\n"
        f"Subtotal: ${subtotal}\nTax: {tax}\nAmount Due: ${due}\nPO: 12 34-5 Some Street"
    )


@pytest.fixture
def invoices(spark):
    pages = spark.createDataFrame(
        [
            ("a", invoice_text(1, "ABC Supplies Ltd.", "Edge Inc.", "27/08/2025", "31,350.00", "6,00%", "33,231.00"), "in/a.pdf", "lattice"),
            ("b", invoice_text(2, "ABC Supplies Ltd.", "Edge Inc.", "28/08/2025", "40.00", "", "41.00"), "in/b.pdf", "stream"),
            ("c", "", "in/c.pdf", "none"),
        ],
        "doc_id string, text string, source_path string, extraction_flavor string",
    )
    head = ["Item", "Description", "Qty", "Unit Price", "Total"]
    rows = [("a", 0, i, r) for i, r in enumerate([head, ["Mix", "hot", "330", "$95.00", ""], ["Subtotal", "", "", "", "31,350.00"]])]
    rows += [("b", 0, i, r) for i, r in enumerate([head, ["Mesh", "", "2", "$10.00", "20.00"], ["Mix", "", "", "", "15.00"]])]
    return pages, spark.createDataFrame(rows, "doc_id string, table_no int, row_no int, cells array<string>")


def test_invoice_run(spark, invoices, tmp_path):
    pages, cells = invoices
    run = pipelines.ingest_invoices(spark, pages, cells, str(tmp_path / "ledger"), STAMP)
    documents = {r.source_path: r for r in run["documents"].collect()}
    a = documents["in/a.pdf"]
    assert (a.document_id, a.document_number, a.party_name, a.supplier_name) == ("ABCSUPPL-1-20250827", "1", "Edge Inc.", "ABC Supplies Ltd.")
    assert (a.items_count, a.sum_line_total, a.subtotal_meta, a.tax_meta_pct) == (1, Decimal("31350.00"), Decimal("31350.00"), Decimal("6.0000"))
    assert (a.total_meta, a.diff_sum_vs_subtotal, a.diff_sum_vs_total) == (Decimal("33231.00"), Decimal("0.00"), Decimal("-1881.00"))
    b = documents["in/b.pdf"]
    assert (b.total_meta, b.diff_sum_vs_subtotal, b.extraction_flavor) == (Decimal("41.00"), Decimal("-5.00"), "stream")
    assert set(documents) == {"in/a.pdf", "in/b.pdf"}
    assert [tuple(r) for r in run["failed"].collect()] == [("c", "no text")]
    report = {name: [tuple(r) for r in df.collect()] for name, df in run["report"].items()}
    assert report["overview"] == [(2, 2, "31,385.00")]
    assert report["top_suppliers"] == [("ABC Supplies Ltd.", 2, "31,385.00")]
    assert report["top_items_by_frequency"] == [("Mix", Decimal("331.000")), ("Mesh", Decimal("2.000"))]
    assert report["discrepancies"] == [(b.document_id, "Edge Inc.", "35.00", "40.00", "", "-5.00", "41.00")]
    assert tuple(run["summary"].first()) == (2, 1, 2, 3, "ok")
    assert {r.document_id for r in spark.table("v_consistency_diffs").collect()} == {r.document_id for r in documents.values()}
    assert sorted((r.doc_id, r.line_items_rows) for r in run["meta"].collect()) == [("a", 1), ("b", 2)]
    assert [r.invoices_total_value for r in spark.read.csv(run["overview_csv"], header=True).collect()] == ["31385.00"]


def test_replacing_and_appending(spark, invoices, tmp_path):
    pages, cells = invoices
    root = str(tmp_path / "ledger")
    first = pipelines.ingest_invoices(spark, pages, cells, root, STAMP)
    before = {r.id for r in first["line_items"].collect()}
    later = pages.where(F.col("doc_id") == "a"), cells.where(F.col("doc_id") == "a")
    second = pipelines.ingest_invoices(spark, *later, root, "2024-02-01T00:00:00")
    assert second["documents"].count() == 2 and second["line_items"].count() == 3
    assert tuple(second["summary"].first()) == (1, 0, 1, 1, "ok")
    assert second["documents"].select("updated_at").distinct().count() == 2
    new = {r.id for r in second["line_items"].collect()} - before
    assert len(new) == 1 and min(new) > max(before)
    with pytest.raises(pipelines.LoadRejected, match="duplicate"):
        pipelines.ingest_invoices(spark, *later, root, "2024-03-01T00:00:00", replace=False)
    assert Ledger(spark, root).tables()[0].count() == 2


def test_pages_are_joined_and_paths_normalised(spark, invoices, tmp_path):
    pages, cells = invoices
    text = invoice_text(7, "ABC Supplies Ltd.", "Edge Inc.", "27/08/2025", "20.00", "", "20.00").split("\n")
    rows = [("b", 2, "\n".join(text[4:]), "in\\b.pdf", "stream"), ("b", 1, "\n".join(text[:4]), "in\\b.pdf", "stream")]
    numbered = spark.createDataFrame(rows, "doc_id string, page_no int, text string, source_path string, extraction_flavor string")
    run = pipelines.ingest_invoices(spark, numbered, cells, str(tmp_path / "ledger"), STAMP)
    document = run["documents"].first()
    assert (document.source_path, document.document_id, document.items_count) == ("in/b.pdf", "ABCSUPPL-7-20250827", 2)
    assert run["line_items"].count() == 2  # cells of documents that are not in the batch are left out


def test_receipt_sums_are_those_of_the_cleaned_items(spark):
    text = "WAL*MART\nWIDGET\n2.00 @ 3.00 0.00\nBOLT 4.00\nSUBTOTAL 10.00\nTOTAL 10.00\n26/01/2015"
    bronze = pipelines.receipt_meta(spark.createDataFrame([("00", text, "p", "f")], "doc_id string, text string, source_path string, extraction_flavor string"), STAMP)
    silver = pipelines.receipt_batch(bronze, STAMP)
    document, items = silver.documents.first(), silver.items.collect()
    again = reconcile.build_receipt_documents(bronze, bronze.select("doc_id", F.inline("items")), "doc_id", STAMP).first()
    assert document.sum_line_total == sum(r.line_total for r in items) == again.sum_line_total
    assert (document.sum_line_total, document.diff_sum_vs_subtotal) == (10.0, 0.0) == (again.sum_line_total, again.diff_sum_vs_subtotal)


def test_receipt_run(spark, tmp_path):
    text = "WAL*MART\nBANANAS\n0.41 lb @ 0.49\nFRAP 5.48 N\nDISCOUNT GIVEN 0.57\nSUBTOTAL 5.11\nTOTAL 5.11\nCASH TEND 11.00\nCHANGE DUE 5.89\n26/01/2015"
    cafe = "MOMI & TOY'S\nTOTAL 175, 000"
    rows = [(d, 0, "gray", p, f"psm{p}", t) for d, t in (("00", text), ("06", cafe)) for p in (4, 6)]
    passes = spark.createDataFrame(rows, "doc_id string, variant_no int, variant string, pass_no int, cfg string, text string")
    sources = spark.createDataFrame([("00", "in/00.jpg", "abc")], "doc_id string, source_path string, file_hash string")
    run = pipelines.ingest_receipts(spark, passes, str(tmp_path / "ledger"), STAMP, sources=sources)
    bronze = {r.doc_id: r for r in spark.read.parquet(run["bronze"]).collect()}
    assert (bronze["00"].file_hash, bronze["00"].ocr_input_variant, bronze["00"].items_detected) == ("abc", "gray", 2)
    found = {r.document_id: r for r in run["documents"].collect()}
    walmart = found["WALMART-00-20150126"]
    assert (walmart.party_name, walmart.document_number, walmart.currency) == ("End Customer", "Not Found", "USD")
    assert (walmart.items_count, walmart.sum_line_total, walmart.subtotal_meta) == (2, Decimal("5.68"), Decimal("5.11"))
    assert (walmart.extraction_flavor, walmart.source_path) == ("ocr_mp:gray:psm4", "in/00.jpg")
    empty = found["MOMITOYS-06-NA"]
    assert (empty.items_count, empty.total_meta, empty.diff_sum_vs_total) == (0, Decimal("175.00"), Decimal("-175.00"))
    # No stated subtotal: the item sum, which is zero here.
    assert (empty.subtotal_meta, empty.diff_sum_vs_subtotal) == (Decimal("0.00"), Decimal("0.00"))
    overview = run["report"]["overview"].first()
    assert tuple(overview) == (2, Decimal("180.11"), Decimal("90.06"))
    checks = {r.document_id: tuple(r)[1:] for r in run["validation"].collect()}
    assert checks == {"WALMART-00-20150126": (False, True, True, False), "MOMITOYS-06-NA": (False, True, True, True)}
    assert tuple(run["validation_summary"].first()) == (2, 0, 2, 2, 1, 0)


def test_silver_receipts_follow_the_stated_rules(spark):
    meta = spark.createDataFrame(
        [("00", "WAL*MART", None, 5.11, None, 11.0, 5.89, 0.57, None), ("01", None, 0.1, None, None, None, None, 1.0, None)],
        "doc_id string, merchant_name string, tax_meta_pct double, subtotal_meta double, total_meta double, tendered_meta double, "
        "change_due_meta double, discount_meta_val double, tax_meta_val double",
    )
    for name in ("txn_datetime_raw", "items_sold_meta", "extraction_flavor", "source_path", "ingest_ts"):
        meta = meta.withColumn(name, F.lit(None).cast("string"))
    items = spark.createDataFrame(
        [("00", "a", "", "0.41", "0.49", "0"), ("00", "b", "", "", "-2", "5.48"), ("01", "c", "", "2", "10", None)],
        "doc_id string, item string, description string, quantity string, unit_price string, line_total string",
    )
    rows = {r.document_id: r for r in reconcile.build_receipt_documents(meta, items, "doc_id", STAMP).collect()}
    first = rows["WALMART-00-NA"]
    assert (first.items_count, first.sum_line_total, first.total_meta) == (2, 5.68, 5.11)
    assert first.diff_sum_vs_subtotal == pytest.approx(0.5709)
    second = rows["UNKNOWN-01-NA"]
    # subtotal = 20 - 1, tax = 1.9, total = 19 + 1.9 - 1: the discount counts twice
    assert (second.subtotal_meta, second.total_meta) == (19.0, 19.9)


def documents_frame(spark, rows):
    return spark.createDataFrame(rows, "document_id string, doc_type string, party_name string, supplier_name string, sum_line_total decimal(18,2), "
                                 "subtotal_meta decimal(18,2), tax_meta_pct decimal(9,4), total_meta decimal(18,2), diff_sum_vs_subtotal decimal(18,2), "
                                 "extraction_flavor string, source_path string")


def test_thresholds_and_null_rules(spark):
    d = Decimal
    rows = [
        ("i1", "invoice", "p", None, d(10), d(10), None, d(10), d("0.01"), "f", "s"),
        ("i2", "invoice", None, "s", d(10), d(10), None, d(10), d("-0.02"), "f", "s"),
        ("i3", "invoice", None, "s", None, None, None, None, None, "f", "s"),
        ("r1", "receipt", "p", None, d(10), d(100), None, d(10), d("0.03"), "f", "s"),
        ("r2", "receipt", "p", "m", d(0), d(0), None, d(5), d(0), "f", "s"),
    ]
    docs = documents_frame(spark, rows)
    assert [r.document_id for r in reports.invoice_discrepancies(docs).collect()] == ["i2"]
    assert [r.document_id for r in reports.receipt_discrepancies(docs).collect()] == ["r1"]
    assert [r.document_id for r in reports.receipt_discrepancies(docs, 0.0).collect()] == ["r1", "r2"]
    assert tuple(gold.summary_overview(docs).first()) == (5, d("30.00"), 4)
    assert [r.party_name for r in gold.top_parties(docs).collect()] == ["p", None]
    assert [r.document_id for r in gold.consistency_outliers(docs, 0.005, 0.0001).collect()] == ["r1", "i2", "i1"]
    assert [r.document_id for r in gold.consistency_outliers(docs).collect()] == []
    assert [tuple(r) for r in reports.receipt_top_merchants(docs).collect()] == [("Unknown", d("10.00")), ("m", d("5.00"))]


def test_views_put_missing_values_first(spark):
    items = spark.createDataFrame(
        [("a", None, None), ("b", Decimal(2), Decimal(3)), ("b", None, Decimal(1))], "item string, quantity decimal(14,3), line_total decimal(14,2)"
    )
    assert [tuple(r) for r in gold.top_items_by_value(items).collect()] == [("a", Decimal("0.00"), 1), ("b", Decimal("4.00"), 2)]
    assert [tuple(r) for r in gold.top_items_by_frequency(items).collect()] == [("b", Decimal("3.000"), Decimal("4.00")), ("a", Decimal("1.000"), Decimal("0.00"))]


def test_constraints(spark):
    docs = spark.createDataFrame([("a", "invoice"), ("a", "invoice"), ("b", None), (None, "receipt")], "document_id string, doc_type string")
    items = spark.createDataFrame([("a", "x"), ("z", "y")], "document_id string, item string")
    assert [tuple(r) for r in tables.duplicate_keys(docs).collect()] == [("a", 2)]
    assert sorted(r.missing for r in tables.not_null_violations(docs, "document_id", "doc_type").collect()) == ["doc_type", "document_id"]
    assert [r.item for r in tables.fk_violations(items, docs).collect()] == ["y"]
    kept = tables.cascade_delete(docs, items, docs.where("document_id = 'a'"))
    assert (kept[0].count(), kept[1].count()) == (2, 1)
    assert sorted(r[0] for r in tables.distinct_keys(docs).collect()) == ["a", "b"]


def test_empty_strings_are_null_in_tables(spark):
    silver = spark.createDataFrame([("a", "receipt", "", 1.005)], "document_id string, doc_type string, party_name string, sum_line_total double")
    row = tables.document_rows(silver, STAMP).first()
    assert (row.party_name, row.document_number, row.supplier_name, row.sum_line_total) == ("End Customer", "Not Found", None, Decimal("1.01"))


def test_bronze_and_silver_files(spark, tmp_path):
    for stem, body in (("one", "Mix,hot,2.0,10.0,\n"), ("two", "")):
        folder = tmp_path / "bronze" / stem
        folder.mkdir(parents=True)
        (folder / "invoice_line_items.csv").write_text("item,description,quantity,unit_price,line_total\n" + body)
        (folder / "invoice_meta.json").write_text(json.dumps({"document_number_raw": "7 ABC", "tax": "6%", "source_path": f"in/{stem}.pdf"}, indent=2))
    root = str(tmp_path / "bronze")
    items, meta = files.read_bronze_items(spark, root, "invoice"), files.read_bronze_meta(spark, root, "invoice")
    assert [tuple(r) for r in items.collect()] == [("one", "Mix", "hot", 2.0, 10.0, None)]
    assert sorted((r.doc_stem, r.tax, r.subtotal) for r in meta.collect()) == [("one", "6%", None), ("two", "6%", None)]
    documents = reconcile.build_invoice_documents(meta, items, "doc_stem", STAMP)
    assert sorted((r.items_count, r.sum_line_total) for r in documents.collect()) == [(0, 0.0), (1, 20.0)]
    files.write_silver(items.withColumnRenamed("doc_stem", "document_id"), documents, str(tmp_path / "silver"))
    assert spark.read.parquet(str(tmp_path / "silver" / "documents")).where("doc_type = 'invoice'").count() == 2
    files.write_bronze(items, meta, str(tmp_path / "again"))
    assert spark.read.parquet(str(tmp_path / "again" / "items")).count() == 1
    with pytest.raises(AnalysisException, match="ALREADY_EXISTS"):
        files.write_bronze(items, meta, str(tmp_path / "again"))


def test_silver_pair_priority(spark, tmp_path):
    header = ",".join(schemas.names(schemas.SILVER_ITEMS)) + "\n"
    docs_header = ",".join(schemas.names(schemas.SILVER_DOCUMENTS)) + "\n"

    def put(prefix, item):
        (tmp_path / f"{prefix}_items.csv").write_text(header + f"d,{item},,1,2,3\n")
        (tmp_path / f"{prefix}_documents.csv").write_text(docs_header)

    with pytest.raises(FileNotFoundError):
        (tmp_path / "x.csv").write_text("a\n")
        files.read_silver_pair(spark, str(tmp_path))
    for prefix in ("other", "receipt", "invoice"):
        put(prefix, prefix)
        items, documents = files.read_silver_pair(spark, str(tmp_path))
        assert items.first().item == prefix and documents.count() == 0


def test_scanning_documents(spark, tmp_path):
    for name in ("b.pdf", "a.pdf", "c.jpg", "d.jpeg"):
        (tmp_path / name).write_bytes(name.encode())
    pdfs = files.sorted_inputs(files.scan_documents(spark, str(tmp_path)))
    assert [r.stem for r in pdfs.collect()] == ["a", "b"]
    images = files.scan_documents(spark, str(tmp_path), files.RECEIPT_GLOB)
    import hashlib

    assert {r[0] for r in images.select(files.content_hash(F.col("content"))).collect()} == {
        hashlib.sha256(n.encode()).hexdigest() for n in ("c.jpg", "d.jpeg")
    }
    with pytest.raises(ValueError, match="no"):
        files.scan_documents(spark, str(tmp_path), "*.png")


def test_overview_export(spark, tmp_path):
    docs = documents_frame(spark, [("i1", "invoice", "p", None, Decimal(10), None, None, None, None, "f", "s")])
    files.export_overview_csv(reports.invoice_overview(docs), str(tmp_path / "o"), STAMP)
    rows = spark.read.csv(str(tmp_path / "o"), header=True).collect()
    assert [tuple(r) for r in rows] == [(STAMP, "1", "1", "10.00")]


def test_replace_works_per_micro_batch(spark, tmp_path):
    """The keyed replacement as a `foreachBatch` body."""
    source, state = tmp_path / "in", {}
    batch = spark.createDataFrame([("a", 1), ("b", 1)], "document_id string, v int")
    batch.write.parquet(str(source))
    spark.createDataFrame([("b", 2), ("c", 2)], batch.schema).write.mode("append").parquet(str(source))
    state["table"] = spark.createDataFrame([("z", 0)], batch.schema)

    def replace(df, _):
        target = str(tmp_path / f"v{len(state)}")
        tables.replace_by_key(state["table"], df.groupBy("document_id").agg(F.max("v").alias("v")), df).write.parquet(target)
        state[target] = state["table"] = spark.read.parquet(target)

    stream = spark.readStream.schema(batch.schema).parquet(str(source))
    stream.writeStream.foreachBatch(replace).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination(120)
    assert sorted(tuple(r) for r in state["table"].collect()) == [("a", 1), ("b", 2), ("c", 2), ("z", 0)]
