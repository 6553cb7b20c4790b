"""Each expression against small literals, with the quirks that results depend on."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docledger import functions as fn
from docledger.functions.text import collapse, filled_lines, strip, text_lines


def values(spark, make, inputs, kind="string"):
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


CASES = {
    "money_invoice": (
        fn.money_invoice,
        ["$1,234.56", "1.234,56", "1,234", "1,234,567", "33,231.00", "-5.5", "12 EUR", "", "abc", None, "1-2"],
        [1234.56, 1.23456, 1.234, None, 33231.0, -5.5, 12.0, None, None, None, None],
    ),
    "money_ocr": (
        fn.money_ocr,
        ["$1,234.56", "1.234,56", "€ 7,5", "R$ 3.20", "1,234,567", "1.234.567,89", "x", "175,00", " 5 ", "1.234,567.89", "1,234.567,89"],
        [1234.56, 1234.56, 7.5, 3.2, None, 1234567.89, None, 175.0, 5.0, None, None],
    ),
    "money_silver": (fn.money_silver, ["$5", "1.234,56", "1,5", "1 234", "nan", "1e3", "1_000", ""], [None, 1234.56, 1.5, 1234.0, None, 1000.0, 1000.0, None]),
    "to_number_or_null": (fn.to_number_or_null, ["1.5", "1.5f", " 2 ", ".5", "5.", "+3", "1e", "1__0"], [1.5, None, 2.0, 0.5, 5.0, 3.0, None, None]),
    "int_lenient": (fn.int_lenient, ["22", "22.9", "-1.5", "x", None], [22, 22, -1, None, None]),
    "tax_percent": (fn.tax_percent, ["6%", "6,00%", "0.06", "1", "7.5 %", "", "x"], [6.0, 6.0, 6.0, 100.0, 7.5, None, None]),
    "fix_split_decimal": (fn.fix_split_decimal, ["$38 .68", "1 2 ,50", "3 4"], ["$38.68", "1 2,50", "3 4"]),
    "sanitize_id": (fn.sanitize_id, ["abc-1/2 x"], ["ABC-12X"]),
    "first_token_with_digit": (fn.first_token_with_digit, ["1 ABC", "inv-2025-001 ACME", "no digits", "", None], ["1", "INV-2025-001", None, None, None]),
    "clean_party_name": (fn.clean_party_name, ["Invoice #: 1 ABC  Supplies", "12  Acme", "INVOICE Foo", "Plain"], ["ABC Supplies", "Acme", "Foo", "Plain"]),
    "vendor_slug8": (fn.vendor_slug8, ["Abc Construction", "--", "", None, "M&M"], ["ABCCONST", "UNKNOWN", "UNKNOWN", "UNKNOWN", "MM"]),
    "supplier_from_number_line": (fn.supplier_from_number_line, ["1 ABC  Ltd.", "Invoice #: 7 Foo Bar", "single", None], ["ABC Ltd.", "Foo Bar", None, None]),
    "normalize_merchant": (fn.normalize_merchant, ["Thornton #629", "Momi & Toy's", "***"], ["THORNTON 629", "MOMI & TOY'S", None]),
    "document_number_token": (fn.document_number_token, ["123 456-789 Rd", "inv-7 x", "# A1", "#", None], ["123456789", "INV-7", "A1", None, None]),
    "detect_currency": (
        fn.detect_currency,
        ["$5 and €4", "5 gbp", "R$ 5", "$5", "usd", "europe", "none", "neurusd"],
        ["EUR", "GBP", "BRL", "USD", "USD", "UNKNOWN", "UNKNOWN", "UNKNOWN"],
    ),
    "name_like": (fn.name_like, ["R-CARROTS 10 OZ", "12.99", "ab", " -Mini/Pearl. 3", "A   B C"], ["R-CARROTS OZ", None, None, "Mini/Pearl", "A B C"]),
    "keyword_score": (fn.keyword_score, ["SUBTOTAL 5\nTOTAL", "Thank You manager", ""], [2, 2, 0]),
    "merchant_text_clean": (fn.merchant_text_clean, ["Thornton #629 ", "™"], ["Thornton 629", ""]),
    "line_key": (fn.line_key, ["  A \t b ", "a b"], ["a b", "a b"]),
    "normalize_line": (fn.normalize_line, ["  a   b\tc "], ["a b\tc"]),
    "path_stem": (fn.path_stem, ["data/in/s_01.pdf", "a/b.c.jpg", "x", ".rc", "orders/12"], ["s_01", "b.c", "x", ".rc", "12"]),
    "safe_stem": (fn.safe_stem, ["in/My Doc (1).pdf", "in/é.pdf"], ["my-doc-1-", "-"]),
    "normalize_path": (fn.normalize_path, ["a\\b\\c"], ["a/b/c"]),
    "dmy_to_yyyymmdd": (fn.dmy_to_yyyymmdd, ["27/08/2025", "1-2-25", "7/13/2024", "x", None, "on 3/4/2020."], ["20250827", "20250201", "20241307", None, None, "20200403"]),
    "find_label_date": (lambda c: fn.find_label_date(c, "invoice date"), ["Invoice Date: 27/08/2025", "INVOICEDATE 1-2-25", "Due Date: 1/1/2020"], ["27/08/2025", "1-2-25", None]),
    "is_meta_row": (fn.is_meta_row, ["Hotel night", "a@b", "Cement", None, "Purchase Order 5"], [True, True, False, False, True]),
    "is_summary_row": (fn.is_summary_row, ["Subtotal", "TAX", "total", "total:", None], [True, True, False, True, False]),
    "is_excluded_line": (fn.is_excluded_line, ["ST# 5", "# ITEMS  SOLD 3", "Milk", "oTAL"], [True, True, False, False]),
    "is_valid_name": (fn.is_valid_name, ["abc", "a b cd", "12"], [True, False, False]),
    "strip": (strip, ["  a b \n"], ["a b"]),
    "collapse": (collapse, ["a  b\tc d"], ["a b c d"]),
}


@pytest.mark.parametrize("name", CASES)
def test_expression(spark, name):
    make, inputs, expected = CASES[name]
    assert values(spark, make, inputs) == expected


def test_lines_split_like_a_text_reader(spark):
    text = "a\r\n b \n\n c\x0bd\n"
    assert values(spark, lambda c: F.array_join(filled_lines(c), "|"), [text]) == ["a|b|c|d"]
    assert values(spark, lambda c: F.size(text_lines(c)), ["a\n\nb"]) == [3]


def test_receipt_times(spark):
    texts = ["2015-01-26 08:05:09", "1/2/2015 10:00", "13/2/2015 10:00", "1/2/2015", "13/2/2015", "31/02/2015", "06-28-2014", "06/28/2014 12:34PM", None]
    expected = [
        datetime(2015, 1, 26, 8, 5, 9), datetime(2015, 1, 2, 10), datetime(2015, 2, 13, 10), datetime(2015, 2, 1),
        datetime(2015, 2, 13), None, None, None, None,
    ]
    assert values(spark, fn.parse_receipt_datetime, texts) == expected
    assert values(spark, lambda c: fn.iso_to_yyyymmdd(fn.parse_receipt_datetime(c)), texts[:1] + [None]) == ["20150126", "NA"]


def test_number_formats(spark):
    numbers = [1234.5, 0.005, -3.0, None]
    assert values(spark, fn.fmt_money, numbers, "decimal(18,3)".replace("decimal(18,3)", "double"))[0] == "1,234.50"
    assert values(spark, fn.fmt_money, [None], "double") == [""]
    assert values(spark, fn.fmt_pct, [6.0, 7.125, None], "double") == ["6.00%", "7.13%", ""]
    assert values(spark, fn.round2, [2.675, 0.125, -0.125, None], "double") == [2.68, 0.13, -0.13, None]
    assert values(spark, fn.clamp_negative_to_zero, [-1.0, None, 2.0], "double") == [0.0, 0.0, 2.0]


def test_document_ids(spark):
    df = spark.createDataFrame(
        [
            ("1 ABC Supplies", "Invoice #: 1 ABC Construction", "Edge Inc.", "27/08/2025", "in/sample_01.pdf"),
            (None, None, "Edge Inc.", None, "in/sample_01.pdf"),
            ("no number", "", None, "27/08/2025", None),
        ],
        "number string, supplier string, client string, day string, path string",
    )
    made = fn.invoice_document_id(*[F.col(c) for c in df.columns])
    ids = [r[0] for r in df.select(made).collect()]
    import hashlib

    digest = lambda *parts: hashlib.sha1("|".join(parts).encode()).hexdigest()[:12].upper()
    assert ids == [
        "ABCCONST-1-20250827",
        "EDGEINC-" + digest("sample_01", "EDGEINC"),
        "UNKNOWN-" + digest("unknown", "UNKNOWN", "20250827"),
    ]
    receipt = spark.sql("select 'MOMI & TOYS' m, '06' s, timestamp'2015-01-26 00:00:00' t union all select null, '07', null")
    made = fn.receipt_document_id(F.col("m"), F.col("s"), F.col("t"))
    assert sorted(r[0] for r in receipt.select(made).collect()) == ["MOMITOYS-06-20150126", "UNKNOWN-07-NA"]


def test_supplier_order(spark):
    df = spark.createDataFrame(
        [("Invoice #: 1 ABC", "2 Foo", "C"), ("", "2 Foo", "C"), (None, "2", "C")], "b string, n string, c string"
    )
    assert [r[0] for r in df.select(fn.supplier_fallback(F.col("b"), F.col("n"), F.col("c"))).collect()] == ["ABC", "Foo", "C"]


def test_long_digit_runs_are_read_in_linear_time(spark):
    from docledger.functions.numbers import money_ocr, to_number_or_null

    texts = ["1" * 1_000_000, "1_" * 300_000 + "1", "1_" * 300_000, "." + "5" * 500_000, " " * 300_000 + "7", "1__2", "_1", "1_.5", "1_000.5_0e1_0"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: r.v for r in rows.select("i", to_number_or_null(rows.t).alias("v")).collect()}
    assert found[0] == float("inf") and found[2] is None and found[4] == 7.0
    assert [found[i] for i in (5, 6, 7)] == [None] * 3 and found[8] == 1000.5e10 and abs(found[3] - 5 / 9) < 1e-12
    assert rows.select(money_ocr(rows.t)).count() == len(texts)


def test_words_in_any_case(spark):
    """Plain search on lower case tells what the pattern without case tells, also beside letters of other scripts."""
    import re

    from docledger.functions import predicates

    old = r"(?i)(SUBTOTAL|TOTAL|TAX|DISCOUNT|GIVEN|CASH|DEBIT|CARD|CHANGE|#\s*ITEMS\s*SOLD|MANAGER|MGR|SURVEY|THANK|APPROVAL|ACCOUNT|TERMINAL|APPR|TC#|OP#|TE#|TR#|ST#)"
    words = "subtotal tax Discount gıven given cash DEBIT card chan change # ITEMS SOLD #itemssold manager mgr survey THANK THAN\u212a approval appr account terminal TC# op# te# tr# ST# s# invoice \u0130nvoice İtem Unit Price PO # bill to @".split(" ")
    texts = [None, "", *words, *(" ".join(words[i : i + 2]) for i in range(len(words))), *(w.upper() for w in words), *(w + "x" for w in words)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    sets = [predicates.META_WORDS, predicates.SUMMARY_WORDS, ("item",), ("unit price", "price"), ("thank",), ("taxi",)]
    pattern = lambda ws: F.coalesce(F.col("t").rlike("(?i)" + "|".join(map(re.escape, ws))), F.lit(False))
    both = [(predicates.contains_any(F.col("t"), ws), pattern(ws)) for ws in sets] + [(predicates.is_excluded_line(F.col("t")), F.col("t").rlike(old))]
    for i, (new, was) in enumerate(both):
        assert df.where(~new.eqNullSafe(was)).collect() == [], i
