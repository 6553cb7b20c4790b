import random

import brute
from brute import prose

from docledger.llm import mixing


def taken(df):
    out = {}
    for r in df.collect():
        held = out.setdefault(r["source"], [0, r["source_size"], r["target"], 0])
        held[0] += r["size"]
        held[3] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    return out


def test_targets_are_met(spark, make):
    draw = random.Random(8)
    sources = {"b": 300, "a": 20, "Ä": 60, "Z": 5, None: 40, "empty": 3}
    rows = [(i, "" if s == "empty" else prose(i, draw.randrange(1, 60)), "en", s) for s, n in sources.items() for i in range(n)]
    labels = spark.createDataFrame([(i, draw.choice([0, 1, None]), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    found = taken(mixing.mix(make(rows), mixing.quality_weights(labels)))
    sizes = {s: sum(len((r[1] or "").split()) for r in rows if r[3] == s) for s in ["Z", "a", "b", "empty", "Ä", None]}
    expected = brute.targets(sizes, mixing.SOURCE_WEIGHTS, 1.5, 2.0)
    for s, (size, source_size, target, got) in found.items():
        assert size == source_size == sizes[s]
        assert abs(target - expected[s]) < 1e-6 and abs(got - target) <= 0.5


def test_reruns_agree_and_order_of_rows_does_not_matter(make):
    rows = [(i, prose(i, 5 + i % 40), "en", f"s{i % 3}") for i in range(200)]
    first, again = (sorted(map(tuple, mixing.mix(make(r)).collect())) for r in (rows, rows[::-1]))
    assert first == again


def test_quality_raises_the_chance(spark, make):
    rows = [(i, "ten words of text that are all of one size", "en", "a" if i < 2000 else "b") for i in range(4000)]
    quality = spark.createDataFrame([(i, 2.0 if i % 2 else 0.5) for i in range(4000)], "doc_id long, weight double")
    found = mixing.mix(make(rows, extra=False), quality, weights=(1.0,), share=1.2).where("source = 'a'").toPandas()
    extra = found.taken - found.epochs * found["size"]
    assert extra[found.doc_id % 2 == 1].sum() > 1.5 * extra[found.doc_id % 2 == 0].sum() > 0


def test_odd_rows(make, odd_rows):
    found = mixing.mix(make(odd_rows))
    assert sorted(r["size"] for r in found.collect()) == sorted(len(brute.WORD.findall(t or "")) for _, t in odd_rows)
    assert mixing.mix(make([])).count() == 0 and mixing.mix(make([(1, None, "en", None)])).collect()[0]["taken"] == 0
