import hashlib
import random
import re

import pytest
from brute import sha
from pyspark.sql import functions as F

from docledger.llm import fill_in_middle, queries
from docledger.llm.fill_in_middle import restored, transform
from workload import check


def by_hand(doc, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return doc, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def agree(docs, rows):
    cut = transform(docs)
    found = cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", restored(F.col("output"), F.col("form"))).collect()
    expected = [(*by_hand(i, t), t or "") for i, t, *_ in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_like_a_loop_over_units(make):
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab Zé漢🎉\n<PSM>0") for _ in range(draw.randrange(60))) for _ in range(400)]
    rows = list(enumerate(texts)) + [(1000 + i, t) for i, t in enumerate(["<", "<<S", "a<P", "P>", "x<P>y", "<S>", "a <M> b", "\n", "é", "word"])]
    agree(make(rows), rows)
    assert {r["form"] for r in transform(make(rows)).select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_odd_rows(make, odd_rows):
    agree(make(odd_rows), odd_rows)
    assert transform(make([])).count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1 << 20])
def test_blocks_change_nothing(block):
    draw = random.Random(block)
    for _ in range(60):
        text = "".join(draw.choice("abcdefg  .é") for _ in range(draw.randrange(90)))
        ends = [m.end() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text)]
        units = fill_in_middle.Units(text, block)
        assert units.n == len(ends) and [units.end(k) for k in range(len(ends) + 1)] == [0, *ends]


def test_very_long_texts(make):
    """A text that a single match would not get through, and one unit of a million letters."""
    rows = [(1, "ab, cé " * 3_000_000), (2, "x" * 5_000_000), (3, "." * 3_000_000)]
    cut = transform(make(rows, extra=False))
    found = cut.select("doc_id", "n", F.sha2(F.col("output").cast("binary"), 256), F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256))
    expected = []
    for i, t in rows:
        _, n, _, _, _, output = by_hand(i, t)
        expected.append((i, n, sha(output.encode()), sha(t.encode())))
    assert sorted(map(tuple, found.collect())) == expected


def test_statement(spark, sf):
    assert check.compare(queries.QUERIES["op11_fill_in_middle"](spark, sf), check.connect(sf), queries.ORACLES["op11_fill_in_middle"]) is None
