import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import prose
from pyspark.sql import functions as F

from docledger.llm import buffers, toxicity

BAD = ["grumbel", "grumbling", "grumbler", "snarkish", "snarkles"]


@pytest.fixture(scope="module")
def labelled(spark, make):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        words = prose(i, draw.randrange(5, 120)).split()
        bad = i % 6 == 0
        for _ in range(3 * bad):
            words.insert(draw.randrange(len(words)), draw.choice(BAD))
        rows.append((i, " ".join(words).title() if i % 2 else " ".join(words), draw.choice(["en", "fr"])))
        labels.append((i, 1, int(bad)))
    return make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents(labelled):
    docs, labels = labelled
    found = toxicity.score(docs.drop("toxic"), toxicity.train(docs, labels)).withColumn("held_out", toxicity.held_out()).toPandas()
    assert list(found.held_out) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]
    test = found[found.held_out]
    true = test.doc_id % 6 == 0
    assert ((test.score >= 0.3) == true).mean() > 0.97 and (test.toxic == true).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_only_the_text_counts(labelled):
    docs, labels = labelled
    net = toxicity.train(docs, labels)
    score = {r["doc_id"]: r["score"] for r in toxicity.score(docs, net).collect()}
    changed = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("z")).withColumn("doc_id", F.col("doc_id") + 1000)
    assert score == {r["doc_id"] - 1000: r["score"] for r in toxicity.score(changed, net).collect()}


def test_odd_rows_and_labels(spark, make, odd_rows):
    docs = make(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_kind = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    both = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (4, 1, 0), (5, 0, 0), (6, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one_kind, both):
        net = toxicity.train(docs, labels)
        rows = toxicity.score(docs, net).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
        assert toxicity.drop_toxic(docs, net).columns == docs.columns
    assert all(r["score"] < 1e-9 for r in toxicity.score(docs, toxicity.train(docs, none)).collect())
    assert toxicity.score(make([]), toxicity.train(make([]), both)).count() == 0


def test_blocks_do_not_change_scores(monkeypatch):
    net = toxicity.untrained(3)
    texts = pa.array(["", "one", None, prose(1, 700), "a b", prose(2, 300)])
    words = toxicity.features(*buffers.text_bytes(texts))
    whole = net.scores(words)
    monkeypatch.setattr(toxicity, "BLOCK", 37)
    assert np.allclose(whole, net.scores(words), atol=1e-6)


def test_case_and_stems():
    lower = toxicity.features(*buffers.text_bytes(pa.array(["élan stupid stupidity"])))
    upper = toxicity.features(*buffers.text_bytes(pa.array(["ÉLAN, STUPID. STUPIDITY!"])))
    assert (lower.ids == upper.ids).all()
    assert (lower.ids[1, 1:] == lower.ids[2, 1:]).all() and lower.ids[1, 0] != lower.ids[2, 0]


def test_every_labelled_document_is_learned(spark, make, monkeypatch):
    """Each toxic word stands in a few documents of one shard only; small shards all add to one network, and reruns agree."""
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 1 << 18)
    draw, rows, labels = random.Random(5), [], []
    for i in range(1200):
        words, bad = prose(i, 25).split(), i % 3 == 0
        rows.append((i, " ".join([*words[:12], draw.choice(BAD) if bad else "plain", *words[12:]]), "en"))
        labels.append((i, 1, int(bad)))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    seen = []
    rounds = toxicity._round
    monkeypatch.setattr(toxicity, "_round", lambda shards, *a: (seen.append(shards.selectExpr("sum(length(toxic))").first()[0]), rounds(shards, *a)))
    one, two = (toxicity.train(make(rows), labels) for _ in range(2))
    assert len(seen) == 2 * toxicity.LEAST_EPOCHS and set(seen) == {sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(1200))}
    assert (one.words == two.words).all() and one.threshold == two.threshold
    found = toxicity.score(make(rows), one).toPandas()
    assert (found.toxic == (found.doc_id % 3 == 0)).mean() > 0.97


def test_counts_stand_for_documents():
    scores, toxic = np.array([0.9, 0.8, 0.8, 0.3]), np.array([1.0, 1.0, 0.0, 0.0])
    each = toxicity.best_threshold(np.repeat(scores, [3, 2, 1, 5]), np.repeat(toxic, [3, 2, 1, 5]), np.ones(11), 0.5)
    assert each == toxicity.best_threshold(scores, toxic, np.array([3, 2, 1, 5]), 0.5) == 0.55
