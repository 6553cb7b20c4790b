"""Cell tables against a sequential reading of generated tables, in small buckets and in one."""

import random
import re

import pytest

from docledger import functions as fn
from docledger.operators import cell_tables, positions

MONEY = re.compile(r"\$?\d{1,3}(?:,\d{3})*(?:\.\d{2})")
PLAIN = re.compile(r"\b\d+(?:\.\d+)?\b")


def amount(token):
    digits = re.sub(r"[^\d,.\-]", "", token)
    return float(digits.replace(",", "") if "." in digits else digits.replace(",", "."))


def has(text, words):
    return any(word in text.lower() for word in words)


def numbers_in(text):
    money = list(MONEY.finditer(text))
    if not money:
        return None, None, None
    plain = [m for m in PLAIN.finditer(text) if not any(m.start() >= x.start() and m.end() <= x.end() for x in money)]
    total = amount(money[-1].group()) if len(money) > 1 else None
    between = [m for m in plain if m.start() >= money[0].end() and m.end() <= money[-1].start()] if len(money) > 1 else []
    choice = between or [m for m in plain if m.start() >= money[0].end()] or plain
    return amount(money[0].group()), float(choice[0].group()) if choice else None, total


def tidy(items):
    kept = []
    for item, description, quantity, unit, total in items:
        summary = has(item, fn.SUMMARY_WORDS) or has(description, fn.SUMMARY_WORDS)
        if summary or (item == description == "" and quantity is unit is total is None):
            continue
        if total is None and unit is not None and quantity is not None:
            total = unit * quantity
        kept.append((item, description, quantity, unit, total))
    return kept


def read_pairs(rows):
    items, at = [], 0
    while at < len(rows):
        cells = rows[at]
        text = " ".join(cells).strip()
        item, description = cells[0].strip(), cells[1].strip()
        at += 1
        if has(text, fn.META_WORDS) or (has(text, ["item"]) and has(text, ["description"])):
            continue
        if any(has(x, fn.META_WORDS) or has(x, fn.SUMMARY_WORDS) for x in (item, description)):
            continue
        unit, quantity, total = numbers_in(text)
        if (quantity is None or total is None) and at < len(rows):
            below = " ".join(rows[at]).strip()
            if not has(below, fn.META_WORDS):
                money = MONEY.findall(below)
                plain = [n for n in PLAIN.findall(below) if not MONEY.search(n)]
                if quantity is None and plain:
                    quantity = float(plain[0])
                if total is None and money:
                    total = amount(money[0])
                at += bool(money or plain)
        items.append((item, description, quantity, unit, total))
    return tidy(items)


def make_tables(seed, n):
    rng = random.Random(seed)
    words = ["Cement", "Sand", "Hotel night", "Mesh", "", "Tax", "Subtotal", "Rope 12", "Bolt"]
    values = ["", "", "3", "12.5", "$4.00", "1,200.50", "12345.67", "7 x 2", "e-mail: a@b", "n/a"]
    tables = {}
    for doc in range(n):
        size = 90 if doc == 0 else rng.randint(1, 12)
        tables[(f"d{doc}", 0)] = [[rng.choice(words), rng.choice(["", "grey", "fine"]), rng.choice(values), rng.choice(values)] for _ in range(size)]
    return tables


def frame(spark, tables):
    rows = [(doc, table, i, cells) for (doc, table), body in tables.items() for i, cells in enumerate(body)]
    return spark.createDataFrame(rows, "doc_id string, table_no int, row_no int, cells array<string>")


def collected(items):
    out = {}
    for r in items.orderBy("doc_id", "table_no", "pos").collect():
        out.setdefault((r.doc_id, r.table_no), []).append((r.item, r.description, r.quantity, r.unit_price, r.line_total))
    return out


@pytest.mark.parametrize("bucket_rows", [3, 8192])
def test_pairs_like_a_sequential_reading(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(positions, "BUCKET_ROWS", bucket_rows)
    tables = make_tables(5, 60)
    found = collected(cell_tables.line_pairs_to_items(cell_tables.table_rows(frame(spark, tables))))
    expected = {key: read_pairs(body) for key, body in tables.items()}
    assert found == {key: items for key, items in expected.items() if items}


HEADERS = {
    "plain": [["Item", "Description", "Qty", "Unit Price", "Total"]],
    "two rows": [["Product", "", "", "", ""], ["", "Desc", "Quantity", "Unit  Price ", "Total"]],
    "behind a title": [["Big Invoice", "", "", "", ""], ["", "", "", "", ""], ["ITEM NAME", "details", "QTY", "RATE", "AMOUNT"]],
}


@pytest.mark.parametrize("bucket_rows", [2, 8192])
@pytest.mark.parametrize("kind", HEADERS)
def test_headers(spark, monkeypatch, kind, bucket_rows):
    monkeypatch.setattr(positions, "BUCKET_ROWS", bucket_rows)
    body = [["Mix", "hot", "40", "$95.00", "3,800.00"], ["Stone", "", "2", "30,5", ""], ["", "", "", "", ""], ["Subtotal", "", "", "", "9.00"]]
    rows = cell_tables.table_rows(frame(spark, {("d", 0): HEADERS[kind] + body}))
    header = cell_tables.detect_header_row(rows).collect()
    assert [(r.header_pos, r.two_rows) for r in header] == [{"plain": (0, False), "two rows": (0, True), "behind a title": (1, True)}[kind]]
    found = collected(cell_tables.header_table_to_items(rows))
    assert found == {("d", 0): [("Mix", "hot", 40.0, 95.0, 3800.0), ("Stone", "", 2.0, 30.5, 61.0)]}


def test_amount_is_quantity_and_total_when_alone(spark):
    table = [["Item", "Description", "Amount"], ["Rope", "x", "12"]]
    rows = cell_tables.table_rows(frame(spark, {("d", 0): table}))
    assert collected(cell_tables.header_table_to_items(rows)) == {("d", 0): [("Rope", "x", 12.0, None, 12.0)]}


def test_late_heading_counts_below_two_hits(spark):
    table = [["a", "b"]] * 70 + [["Item name", "b"], ["Qty", "c"], ["Rope", "x"]]
    rows = cell_tables.table_rows(frame(spark, {("d", 0): table, ("e", 0): [["a", "b"], ["c", "d"]]}))
    assert [(r.doc_id, r.header_pos, r.two_rows) for r in cell_tables.detect_header_row(rows).collect()] == [("d", 70, True)]


def test_null_rows_do_not_count(spark):
    table = [[None, None, None], ["Item", "Description", "Total"], [None, None, None], ["Rope", "x", "5.00"]]
    rows = cell_tables.table_rows(frame(spark, {("d", 0): table}))
    assert sorted(r.pos for r in rows.collect()) == [0, 1]
    assert collected(cell_tables.header_table_to_items(rows)) == {("d", 0): [("Rope", "x", None, None, 5.0)]}


@pytest.mark.parametrize("bucket_rows", [2, 8192])
def test_best_table_of_a_document(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(positions, "BUCKET_ROWS", bucket_rows)
    head = HEADERS["plain"][0]
    full = ["Mix", "hot", "4", "$95.00", "380.00"]
    loose = ["Sand", "fine", "$4.00", "3", "$12.00"]
    tables = {
        ("pairs win", 0): [loose, loose],
        ("header wins", 0): [loose],
        ("header wins", 1): [head, full, full],
        ("first on a tie", 0): [head, full],
        ("first on a tie", 1): [head, ["Other", "hot", "4", "$95.00", "380.00"]],
        ("pairs after empty header", 0): [head, ["", "", "", "", ""]],
        ("pairs after empty header", 1): [loose] * 5,
    }
    found = collected(cell_tables.choose_items(frame(spark, tables)))
    mix, sand = ("Mix", "hot", 4.0, 95.0, 380.0), ("Sand", "fine", 3.0, 4.0, 12.0)
    assert found == {
        ("pairs win", 0): [sand] * 2,
        ("header wins", 1): [mix] * 2,
        ("first on a tie", 0): [mix],
        ("pairs after empty header", 1): [sand] * 5,
    }


def test_same_line_numbers_use_spans(spark):
    texts = ["Rope 2 $4.00 3 $12.00", "12345.67", "$5.00 7", "8 $5.00", "1.50 2.50 3.50", "none 5"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [tuple(r)[2:] for r in cell_tables.same_line_numbers(df, "t").orderBy("i").select("i", "t", "unit_price", "quantity", "line_total").collect()]
    assert found == [numbers_in(t) for t in texts]


def test_joins_keep_to_buckets(spark):
    """A table of any size meets its header by bucket, never by table alone."""
    rows = cell_tables.table_rows(frame(spark, {("d", 0): HEADERS["plain"]}))
    plan = cell_tables.apply_header(rows)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert joins and all("_bucket" in line for line in joins)


def test_same_line_numbers_like_a_loop(spark):
    import random

    draw = random.Random(3)
    parts = ["7", "12.5", "$4.00", "1,000.00", "$1,234.56", "1234.56", "99.999", "x2", " ", "  ", "-", ".", ",", "a", "$"]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(draw.randrange(12))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [tuple(r)[1:] for r in cell_tables.same_line_numbers(df, "t").orderBy("i").select("i", "unit_price", "quantity", "line_total").collect()]
    wrong = [(t, f, numbers_in(t)) for t, f in zip(texts, found) if f != numbers_in(t)]
    assert not wrong, wrong[:3]


def test_many_tokens_in_a_row(spark):
    """Time is linear in the matches of a row: 100,000 of them take a few seconds."""
    import time

    times = {}
    for n in (10, 25_000):
        df = spark.createDataFrame([("7 $1,000.00 " * n,)], "t string")
        start = time.time()
        row = cell_tables.same_line_numbers(df, "t").first()
        assert (row.unit_price, row.quantity, row.line_total) == (1000.0, 7.0, 1000.0)
        times[n] = time.time() - start
    assert times[25_000] < times[10] + 15, times


def shown(rows, *columns):
    return sorted(map(str, rows.select(*columns).toLocalIterator()))


def test_tables_of_one_bucket_need_one_exchange(spark):
    """Without rows beyond the first bucket the same items come without a join; null keys and nameless tables included."""
    cells = [
        ("a", 0, 0, ["Item", "Qty", "Total"]), ("a", 0, 1, ["pen", "2", "$3.00"]), ("a", 0, 2, ["Subtotal", "", "3.00"]), ("a", 0, 3, [None, None, None]),
        ("a", 1, 0, ["ink 2 $3.00 6.00", "", ""]), ("a", 1, 1, ["cap $1.00", "", ""]), ("a", 1, 2, ["4 9.00", "", ""]), ("a", 1, 4, ["lid 7 2.00", "", ""]),
        ("b", 0, 5, ["Product", "Rate", ""]), ("b", 0, 6, ["", "Price", "Amount"]), ("b", 0, 9, ["mug", "5.00", "x"]), ("b", 0, 10, ["cup", "n/a", "1"]),
        (None, 0, 0, ["Item", "Qty", "Total"]), (None, 0, 1, ["pen", "2", "$3.00"]),
    ]
    cells = spark.createDataFrame(cells, "doc_id string, table_no int, row_no int, cells array<string>")
    assert not cell_tables.several_buckets(cells) and cell_tables.several_buckets(cells.selectExpr("cast(null as int) as row_no"))
    one, many = (cell_tables.table_rows(cells, several) for several in (False, True))
    plan = cell_tables.apply_header(one)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join [" not in plan
    columns = ["doc_id", "table_no", "pos", "item", "description", *cell_tables.NUMBERS]
    assert shown(one, "doc_id", "pos", "cells", "next_cells", "has_next") == shown(many, "doc_id", "pos", "cells", "next_cells", "has_next")
    for parse in (cell_tables.header_table_to_items, cell_tables.line_pairs_to_items):
        assert shown(parse(one), *columns) == shown(parse(many), *columns)
    assert shown(cell_tables.union_candidates(one), *columns, "path") == shown(cell_tables.union_candidates(many), *columns, "path")
    assert shown(cell_tables.choose_items(cells), *columns) == shown(cell_tables.choose_items(cells, True), *columns)


def test_column_places_are_found_once_a_table(spark, monkeypatch):
    """No filter works fields out again, and no generated method is longer than the JVM compiles (8,000 bytes)."""
    cells = [
        ("a", 0, 0, ["Item", "Details", "", "Unit Price", ""]), ("a", 0, 1, ["", "x", " QTY ", "", "Total"]), ("a", 0, 2, ["pen", "blue", "2", "$1.50", ""]),
        ("b", 0, 0, ["Item Name", "Colour", None]), ("b", 0, 1, ["", "", "Price"]), ("b", 0, 2, ["ink", "red", "$4.00"]), ("b", 0, 3, ["Subtotal", "", "4.00"]),
        ("c", 0, 0, ["Amount", "Rate", None]), ("c", 0, 1, ["3", "2.00", "x"]), (None, 0, 0, ["Item", "Qty"]), (None, 0, 1, ["pen", "2"]),
    ]
    cells = spark.createDataFrame(cells, "doc_id string, table_no int, row_no int, cells array<string>")
    rows = cell_tables.table_rows(cells, False)
    headed = cell_tables.apply_header(rows)
    places = [f"{target}_at" for target in cell_tables.HEADER_WORDS]
    again = cell_tables.map_columns(headed.drop("_columns"))
    assert shown(cell_tables.map_columns(headed), "doc_id", "pos", *places) == shown(again, "doc_id", "pos", *places)
    items = cell_tables.header_table_to_items(rows)
    found = {(r.doc_id, r.item, r.description, r.quantity, r.unit_price, r.line_total) for r in items.collect()}
    assert found == {("a", "pen", "blue", 2.0, 1.5, 3.0), ("b", "ink", "", None, 4.0, None), ("c", "", "", 3.0, 2.0, 3.0)}, found
    filters = [x for x in items._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
    assert filters and not any("array_position" in x or "regexp" in x for x in filters), filters

    written = []
    monkeypatch.setattr(cell_tables, "stored", lambda df: written.append(df) or df)
    cell_tables.union_candidates(rows)
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (items, *written):
            plan = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
            code = plan.codegenString(df.select("*")._jdf.queryExecution().executedPlan())
            sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)]
            assert sizes and max(sizes) < 8000, sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
