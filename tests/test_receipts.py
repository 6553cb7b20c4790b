"""Receipt texts and OCR passes against small texts and a sequential reading of generated ones."""

import random
import re

from pyspark.sql import functions as F

from docledger.functions.predicates import EXCLUDED_LINE
from docledger.functions.text import filled_lines
from docledger.operators import lines, ocr_passes
from docledger.operators import receipt_text as rt
from docledger.plans import pipelines

STOP = re.compile(EXCLUDED_LINE)


def with_lines(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    return df.withColumn("lines", filled_lines(F.col("text")))


def field(spark, expression, texts):
    rows = with_lines(spark, texts).select("doc_id", expression.alias("y")).orderBy("doc_id")
    return [r.y for r in rows.collect()]


def test_merchant(spark):
    made = rt.receipt_merchant(F.col("text"), F.col("lines"))
    texts = ["x\nWAL*MART\n", "Trader Joes", "ab\nThank you\n***\nThornton #629\n", "", "\n".join(["--"] * 10 + ["Late Shop"])]
    assert field(spark, made, texts) == ["WALMART", "TRADER JOE'S", "Thornton 629", None, None]


def test_tc_code_comes_from_the_tail(spark):
    long = "TC# 1111 1111 1111\n" + "x\n" * 40
    texts = [long, "x\nTC# 1234  5678 9012\nTC# 9999 9999 99", "TC# 123"]
    assert field(spark, rt.receipt_tc_code(F.col("lines")), texts) == [None, "1234 5678 9012", None]


def test_phone_takes_the_least_bad(spark):
    texts = [
        "Store #403 - (469) 334-0614",
        "(015) 986 - 1783\n679 348 and 7928",
        "(100) 200-3000",
        "200 000 1234\n300 100 1000",
        "none",
        "x\n" * 40 + "469 334 0614",
    ]
    assert field(spark, rt.receipt_phone(F.col("lines")), texts) == [
        "(469) 334-0614", "(679) 348-7928", None, "(300) 100-1000", None, None,
    ]


def test_last_date_wins(spark):
    texts = ["01/02/2014\n06-28-2014 12:34PM 0403", "01/02/14 9:05:07 am x\nnone", "1/2/2014"]
    assert field(spark, rt.receipt_datetime_raw(F.col("lines")), texts) == ["06-28-2014 12:34PM", "01/02/14 9:05:07 am", None]


def test_items_sold(spark):
    texts = ["# ITEMS SOLD 12", "ITEMS SOLD\nx 7 y", "ITEMS 22 Higgins", "ITEMS SOLD =\nnone\nITEMS SOLD: 5", "none"]
    assert field(spark, rt.receipt_items_sold(F.col("lines")), texts) == [12, 7, 22, 5, None]


def totals(spark, text):
    df = rt.derive_totals_from_text(rt.receipt_totals(with_lines(spark, [text])))
    return df.drop("doc_id", "text", "lines").first().asDict()


def test_totals(spark):
    found = totals(spark, "DISCOUNT GIVEN 0.57\nSUBTOTAL\nSUBTOTAL 5.11\nTOTAL $38 .68\nCASH TEND 11.00\nCHANGE DUE 5.89\nTAX 1 7.750 % 3.46")
    assert found == {
        "discount_meta_val": 0.57, "subtotal_meta": 5.11, "total_meta": 38.68, "tendered_meta": 11.0,
        "change_due_meta": 5.89, "tax_meta_val": 1.0, "tax_meta_pct": 7.5,
    }


def test_totals_are_derived_in_order(spark):
    assert totals(spark, "SUBTOTAL 10.00\nTAX 0.60")["total_meta"] == 10.6
    assert totals(spark, "SUBTOTAL 10.00\n SUB TOTAL 12.00\nNON TAXABLE 3.00")["tax_meta_val"] == 2.0
    assert totals(spark, "CARD 20\nCHANGE 4.5")["total_meta"] == 16.0
    assert totals(spark, "TOTAL 175, 000")["total_meta"] == 175.0


def test_discount_completes_totals(spark):
    df = spark.createDataFrame(
        [(None, None, None, 2.0, None, None, 10.0), (None, None, None, 20.0, None, None, 10.0), (None, 1.0, None, 2.0, None, None, 10.0),
         (None, None, None, None, 5.0, 1.0, 10.0), (None, None, None, None, None, None, 10.0)],
        "subtotal_meta double, tax_meta_val double, total_meta double, discount_meta_val double, tendered_meta double, change_due_meta double, s double",
    )
    found = [(r.subtotal_meta, r.total_meta) for r in rt.derive_totals_from_items(df, F.col("s")).collect()]
    assert found == [(8.0, 8.0), (0.0, 0.0), (8.0, 9.0), (None, 4.0), (None, None)]


def letters(text):
    return re.sub(r"\s{2,}", " ", re.sub(r"[^A-Za-z\s\-'/&]", " ", text).strip()).strip(" .-:|,")


def read_items(text):
    """One line after the other, keeping the index of the next line to look at."""
    rows = [re.sub(r"\s{2,}", " ", x.strip()) for x in text.split("\n")]
    name_of = lambda x: letters(x) if len(letters(x)) >= 3 else None
    valid = lambda n: bool(n and re.search("[A-Za-z]{3,}", n))
    nums = lambda x: [float(n.replace(",", ".")) for n in re.findall(r"\d+[.,]\d{2}", x)]

    def counted(name, values, at):
        total = values[-1] if len(values) > 2 else values[0] * values[1]
        return (at, name, values[0], values[1], round(total + 1e-9, 2))

    found, at = [], 0
    while at < len(rows):
        row, here, at = rows[at], at, at + 1
        if not row or STOP.search(row):
            continue
        if "@" in row and len(nums(row)) > 1:
            above = [rows[k] for k in (here - 1, here - 2) if k >= 0]
            above = [name_of(x) for x in above if x and not STOP.search(x) and "@" not in x]
            name = name_of(row) or next((n for n in above if n), None)
            if valid(name):
                found.append(counted(name, nums(row), here))
                continue
        if at < len(rows) and "@" in rows[at] and valid(name_of(row)) and len(nums(rows[at])) > 1:
            found.append(counted(name_of(row), nums(rows[at]), here))
            at += 1
            continue
        priced = re.search(r"^(.+?)\s+(\d+[.,]\d{2})(?:\s*[A-Za-z])?$", row)
        if priced and valid(letters(priced.group(1))):
            price = float(priced.group(2).replace(",", "."))
            found.append((here, letters(priced.group(1)), 1.0, price, price))
    return [x for x in found if not re.search("SUBTOTAL|TOTAL|TAX", x[1], re.I)]


def test_items_like_a_sequential_reading(spark):
    rng = random.Random(11)
    pool = ["BANANAS", "0.41 lb @ 0.49", "2.00 @ 1.50 3.00", "MILK 2,50 F", "MILK", "a b @ 1.00 2.00", "LIMES 2.00 @ 0.25", "", "  ", "TAX 1.00",
            "TOTAL @ 1.00 2.00", "x", "@ 3.00", "CARD 5.00", "oTAL 9.99", "12.00", "EGGS - 3.10", "A-B'C 1.00 2.00", "@ 1.00 2.00", "ab 1.00"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    found = {}
    for r in rt.explode_items(df.select("doc_id", rt.receipt_items(F.col("text")).alias("items"))).collect():
        found.setdefault(r.doc_id, []).append((r.line_no, r.item, r.quantity, r.unit_price, r.line_total))
    expected = {i: read_items(t) for i, t in enumerate(texts)}
    assert found == {i: x for i, x in expected.items() if x}


def test_receipt_work_needs_no_shuffle(spark):
    df = spark.createDataFrame([("d", "MILK 2.50")], "doc_id string, text string")
    df = df.withColumn("source_path", F.lit("p")).withColumn("extraction_flavor", F.lit("f"))
    silver = pipelines.receipt_batch(pipelines.receipt_meta(df, "2024-01-01T00:00:00"), "2024-01-01T00:00:00")
    for part in (silver.documents, silver.items):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()


def test_passes_merge_and_rank(spark):
    rows = [
        ("d", 0, "gray", 0, "a", "Total 1\n x "),
        ("d", 0, "gray", 1, "b", "total  1\nTAX 2\ny"),
        ("d", 1, "bin", 0, "a", "X"),
        ("e", 0, "gray", 0, "a", ""),
        ("e", 1, "bin", 0, "a", ""),
    ]
    passes = spark.createDataFrame(rows, "doc_id string, variant_no int, variant string, pass_no int, cfg string, text string")
    merged = {(r.doc_id, r.variant): (r.cfg, r.text, r.score) for r in ocr_passes.merge_ocr_passes(passes).collect()}
    assert merged == {
        ("d", "gray"): ("b", "Total 1\nx\nTAX 2\ny", 2), ("d", "bin"): ("a", "X", 0), ("e", "gray"): ("a", "", 0), ("e", "bin"): ("a", "", 0),
    }
    chosen = {r.doc_id: (r.ocr_input_variant, r.extraction_flavor) for r in ocr_passes.choose_ocr_variant(ocr_passes.merge_ocr_passes(passes)).collect()}
    assert chosen == {"d": ("gray", "gray:b"), "e": ("gray", "gray:a")}


def test_head_and_tail_lines(spark):
    df = with_lines(spark, ["a\n\nb\nc"]).drop("lines")
    pairs = lambda d: [(r.line_no, r.line) for r in d.orderBy("line_no").collect()]
    assert pairs(lines.head_lines(df, 2)) == [(0, "a"), (1, "b")]
    assert pairs(lines.tail_lines(df, 2)) == [(1, "b"), (2, "c")]
    assert pairs(lines.explode_lines(df, keep_blank=True)) == [(0, "a"), (1, ""), (2, "b"), (3, "c")]
    assert [(r.line, r.name) for r in rt.name_lookback(spark.createDataFrame([("d", "MILK\n2\n@ 1.00")], "doc_id string, text string")).collect()] == [
        ("MILK", None), ("2", "MILK"), ("@ 1.00", "MILK"),
    ]


def test_merging_passes_takes_one_exchange(spark, sf):
    from workload import views

    chosen = ocr_passes.choose_ocr_variant(ocr_passes.merge_ocr_passes(views.ocr_passes(spark, sf)))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_tables_from_one_reading_of_the_texts(spark, tmp_path):
    from datetime import date

    from workload import catalog

    tables = {
        "lineitem": ([(3, 1, 1, 1, 2.0, 9.0, date(2024, 1, 2))], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate date"),
        "part": ([(1, "mint lace", "TIN", "B", 4.5)], "p_partkey bigint, p_name string, p_type string, p_brand string, p_retailprice double"),
        "orders": ([(3, 1, date(2024, 1, 1))], "o_orderkey bigint, o_custkey bigint, o_orderdate date"),
        "customer": ([(1, "C")], "c_custkey bigint, c_name string"),
        "supplier": ([(1, "Some Shop")], "s_suppkey bigint, s_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = catalog.QUERIES["build_receipt_documents_from_tables"](spark, str(tmp_path))
    assert "listagg" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.supplier_name for r in found.collect()] == ["SOME SHOP"]


def test_lines_are_tidied_as_by_strip(spark):
    from docledger.functions.strings import normalize_line
    from docledger.functions.text import filled_lines, strip, text_lines, tidy_lines

    text = "a\r\n b  c  \n\n x\x1cd\te\x85f\r\rg   \nh i"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    old = F.split("t", r"\R|[\x1C-\x1E]", -1)
    row = df.select(
        text_lines(F.col("t")).eqNullSafe(old).alias("a"),
        tidy_lines(F.col("t")).eqNullSafe(F.transform(old, normalize_line)).alias("b"),
        filled_lines(F.col("t")).eqNullSafe(F.filter(F.transform(old, strip), lambda x: x != "")).alias("c"),
    )
    assert row.distinct().collect() == [(True, True, True)]
