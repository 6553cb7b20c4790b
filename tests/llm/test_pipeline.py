import random

import corpus_pipeline
import pytest
from brute import prose

import __spark_entry__ as contract
from docledger.llm import queries


def test_stages_keep_the_columns(spark, make, odd_rows, sf):
    for rows in (odd_rows, []):
        docs = make(rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, sf)
            assert found.columns == docs.columns, name
            assert found.count() <= len(rows)
        mixed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
        assert set(docs.columns) | {"size", "source_size", "target", "taken"} == set(mixed.columns)
        assert mixed.count() <= len(rows)


def test_mixing_replaces_columns_of_its_names_in_any_case(spark, make, sf, tmp_path):
    docs = make([(i, prose(i, 30)) for i in range(8)], extra=False).selectExpr("*", "'x' AS Size", "'x' AS TAKEN")
    mixed = corpus_pipeline.mix_sources(spark, docs, sf)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken"]
    mixed.write.parquet(str(tmp_path / "mixed"))


def test_decisions_take_effect(spark, make, sf):
    draw = random.Random(5)
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first()["text"]
    text = prose(1, 150, 4000)
    copy = " ".join("changed" if draw.random() < 0.03 else w for w in text.split())
    other = prose(2, 150, 4000)
    docs = make([(1, text), (2, copy), (3, text), (4, f"{prose(3, 80)} {item} {prose(4, 80)}"), (5, other)])
    near = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    assert sorted(r["doc_id"] for r in near.collect()) == [1, 4, 5]
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_leaking(spark, near, sf).collect()) == [1, 5]
    lines = make([(i, f"{prose(i, 40)}\nAll rights reserved by the owner.") for i in range(8)])
    assert all("reserved" not in r["text"] for r in corpus_pipeline.drop_recurring_lines(spark, lines, sf).collect())


def test_run(spark, sf):
    found = corpus_pipeline.run(spark, sf)
    names = spark.read.parquet(f"{sf}/documents.parquet").columns
    assert found.columns == [*names, "size", "source_size", "target", "taken"]
    rows = found.collect()
    assert 0 < len(rows) == len({r["doc_id"] for r in rows}) and all(0 < r["taken"] <= 2 * r["size"] for r in rows)


@pytest.mark.parametrize("n", range(1, 14))
def test_one_query_for_each_operator(n):
    assert len([q for q in contract.queries() if q.startswith(f"op{n}_")]) == 1
    assert set(queries.ORACLES) <= set(queries.QUERIES)
