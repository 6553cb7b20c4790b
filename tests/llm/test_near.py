import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
from brute import prose

from docledger.llm import components, order_minhash


def classes(df):
    return {(r["doc_id"], r["class_hash"]) for r in df.collect()}


def test_word_edits_within_the_band():
    draw = np.random.default_rng(0)
    for _ in range(1500):
        a = draw.integers(0, draw.integers(2, 9), draw.integers(0, 25))
        b = a.copy() if draw.random() < 0.6 else draw.integers(0, 6, draw.integers(0, 25))
        for _ in range(draw.integers(0, 5)):
            if len(b):
                at = draw.integers(0, len(b))
                b = [np.delete(b, at), np.insert(b, at, draw.integers(0, 9)), np.where(np.arange(len(b)) == at, 9, b)][draw.integers(0, 3)]
        most = int(draw.integers(0, 12))
        true, found = brute.edits(a.tolist(), b.tolist()), order_minhash.word_edits(a, b, most)
        assert found == true if true <= most else found > most


def test_classes_like_brute_force(make):
    draw = random.Random(7)
    rows = []
    for family in range(8):
        words = prose(family, 120 + 10 * family, 3000).split()
        for _ in range(6):
            copy = list(words)
            for _ in range(draw.randrange(0, 10)):
                at = draw.randrange(len(copy))
                copy[at : at + 1] = draw.choice([[], ["new"], [copy[at], "more"]])
            rows.append((len(rows), " ".join(copy)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, "too short"), (103, "too short"), (104, "too brief")]
    found, _ = order_minhash.near_duplicates(make(rows))
    got = {r["doc_id"]: r["class_id"] for r in found.collect()}
    expected = brute.near_classes([t for _, t in rows])
    smallest = {}
    for (i, _), c in zip(rows, expected):
        smallest[c] = min(smallest.get(c, i), i)
    assert got == {i: smallest[c] for (i, _), c in zip(rows, expected)}


def test_order_counts(make):
    """Two texts with the same sentences in another order are no near-duplicates."""
    parts = [prose(i, 60, 5000) for i in range(4)]
    found, _ = order_minhash.near_duplicates(make([(1, " ".join(parts)), (2, " ".join(parts[2:] + parts[:2]))]))
    assert {r["class_id"] for r in found.collect()} == {1, 2}


def test_odd_rows(make, odd_rows):
    docs = make(odd_rows)
    found, _ = order_minhash.near_duplicates(docs)
    by_row = [(r["doc_id"], r["class_id"]) for r in found.collect()]
    assert len(by_row) == len(odd_rows)
    assert {c for i, c in by_row if i in (6, 7)} == {6} and {c for i, c in by_row if i in (1, 2, 3)} == {1, 2, 3}
    kept = order_minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    left = sorted(((r["doc_id"], (r["text"] or "")[:20]) for r in kept.collect()), key=repr)
    rows = {(i, t) for i, t in odd_rows if i not in (5, 7)}
    assert left == sorted(((i, (t or "")[:20]) for i, t in rows), key=repr)


def test_empty_table(make):
    found, links = order_minhash.near_duplicates(make([]))
    assert found.count() == 0 and links.count() == 0 and order_minhash.drop_near_duplicates(make([])).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (202, 201), (300, 300)]
    found = components.components(spark.createDataFrame(chain, "a long, b long"))
    expected = {(i, 0) for i in range(1, 41)} | {(100, 0), (201, 200), (202, 200)}
    assert {tuple(r) for r in found.collect()} == expected


def test_pairs_behind_a_common_passage(make):
    """Pairs that only meet in buckets whose chosen member is like neither."""
    passage, rows, pairs = prose(1, 100, 5000), [], {}
    for i in range(30):
        rows.append((i, f"{passage} {prose(100 + i, 60, 5000)}"))
    for i in range(1000, 1020, 2):
        own = prose(i, 64, 5000).split()
        other = [f"new{i}{at}" if at % 2 else w for at, w in enumerate(own)]
        rows += [(i, f"{passage} {' '.join(own)}"), (i + 1, f"{passage} {' '.join(other)}")]
        pairs[i + 1] = i
    found, _ = order_minhash.near_duplicates(make(rows))
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == {i: pairs.get(i, i) for i, _ in rows}


def test_scattered_edits_at_the_threshold(make):
    """Pairs whose words are replaced at random places, at similarities of the threshold and just above."""
    draw = random.Random(11)
    for similarity in (0.80, 0.82, 0.85):
        rows = []
        for i in range(150):
            words = prose(1000 + i, 200, 20000).split()
            copy = list(words)
            for at in draw.sample(range(200), round(200 * (1 - similarity))):
                copy[at] = f"new{at}"
            rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
        found, _ = order_minhash.near_duplicates(make(rows))
        joined = sum(r["doc_id"] % 2 == 1 and r["class_id"] == r["doc_id"] - 1 for r in found.collect())
        assert joined >= 147, (similarity, joined)


def test_word_edits_without_whole_masks(monkeypatch):
    """Places kept as lists, as those of rare words in very long texts, give the same edits."""
    monkeypatch.setattr(order_minhash, "PLACES_BYTES", 0)
    test_word_edits_within_the_band()


def test_profiles_never_exceed_the_edits():
    draw = np.random.default_rng(1)
    for _ in range(300):
        a, b = (draw.integers(0, 12, draw.integers(1, 25)).astype(np.uint32) * 128 for _ in range(2))
        rows = order_minhash.profiles(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert order_minhash.edits_at_least(rows[:1], rows[1:])[0] <= brute.edits(a.tolist(), b.tolist())
    long = np.zeros(1000, np.uint32)
    rows = order_minhash.profiles(np.concatenate([long, long[:300]]), np.array([0, 1000, 1300]))
    assert rows.max() == 255 and order_minhash.edits_at_least(rows[:1], rows[1:])[0] == 0


def test_long_near_copies_in_bounded_memory():
    """Two hundred thousand different words with scattered edits, aligned as one pair."""
    a = np.arange(200_000, dtype=np.uint32)
    b = np.delete(a.copy(), np.arange(100, 160_000, 8_000))
    b[::10_000] = 4_000_000_000
    tracemalloc.start()
    assert order_minhash.alike(a, b, 0.8)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200e6, most


def test_links_name_both_texts(make):
    words = prose(3, 80, 3000).split()
    _, links = order_minhash.near_duplicates(make([(5, " ".join(words)), (9, " ".join([*words, "more"]))]))
    ((a, b),) = links.collect()
    assert {a["id"], b["id"]} == {5, 9} and a["hash"] != b["hash"]


def test_blocks_compare_every_pair(make, spark, monkeypatch):
    """Buckets cut into many blocks, by length and salt, and groups cut by batches lose no pair."""
    monkeypatch.setattr(order_minhash, "BLOCK", 4)
    monkeypatch.setattr(order_minhash, "PAIRS_AT_ONCE", 3)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(size, "5")
    try:
        draw, rows, passage = random.Random(3), [], prose(1, 100, 5000)
        for i in range(70):
            rows.append((i, f"{passage} {prose(100 + i, draw.randrange(5, 120), 5000)}"))
        test_pairs_behind_a_common_passage(make)
        found, _ = order_minhash.near_duplicates(make(rows))
        got = {r["doc_id"]: r["class_id"] for r in found.collect()}
    finally:
        spark.conf.unset(size)
    expected = brute.near_classes([t for _, t in rows])
    smallest = {}
    for (i, _), c in zip(rows, expected):
        smallest[c] = min(smallest.get(c, i), i)
    assert got == {i: smallest[c] for (i, _), c in zip(rows, expected)} and 1 < len(set(got.values())) < 70


def test_words_present_never_exceed_the_edits():
    draw = np.random.default_rng(2)
    for _ in range(300):
        a, b = (draw.integers(0, 12, draw.integers(1, 25)).astype(np.uint64) * np.uint64(977) for _ in range(2))
        one, other = (np.unpackbits(x) for x in order_minhash.presence(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])))
        assert max((one > other).sum(), (other > one).sum()) <= brute.edits(a.tolist(), b.tolist())


def test_candidates_in_a_bucket_are_no_rows(make, monkeypatch):
    """Texts of the same words in another order behind a common passage: no bound tells them apart, and each pair is aligned."""
    draw, passage, words, written = random.Random(5), prose(1, 60, 5000), prose(2, 60, 5000).split(), []
    rows = [(i, f"{passage} {' '.join(draw.sample(words, 60))}") for i in range(40)]
    settled = order_minhash.settled

    def counted(df):
        out = settled(df)
        if set(order_minhash.PAIR) <= set(out.columns):
            written.append(out.count())
        return out

    monkeypatch.setattr(order_minhash, "settled", counted)
    found, _ = order_minhash.near_duplicates(make(rows))
    assert {r["class_id"] for r in found.collect()} == set(range(40))
    assert max(written) <= order_minhash.FIRST_CANDIDATES * len(rows) < 40 * 39 // 2 - 40


def test_bounds_and_sketches_take_little_memory():
    """Counts are compared as bytes, and texts of a batch are hashed some at a time."""
    rng = np.random.default_rng(1)
    one, other = (rng.integers(0, 256, (8192, order_minhash.PROFILE), dtype=np.uint8) for _ in range(2))
    more = one.astype(np.int64) - other
    least = np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))
    texts = [" ".join(map(str, rng.integers(0, 5000, 2000))) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(texts)], names=["k", "text"])
    size = sum(map(len, texts))
    for use, most in ((lambda: order_minhash.edits_at_least(one, other), 2 * one.nbytes), (lambda: list(order_minhash._sketch(5, 32)(iter([batch]))), 12 * size)):
        use()
        tracemalloc.start()
        found = use()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most, (peak, most)
        if isinstance(found, np.ndarray):
            assert (found == least).all()


def test_equal_values_follow_each_other_by_place():
    draw = np.random.default_rng(3)
    close = draw.integers(0, 4, 5000).astype(np.uint64)  # same first bits, so that they lie between each other
    for values in (draw.integers(0, 40, 5000, dtype=np.uint64) << np.uint64(40), close, close[:1], close[:0]):
        assert (order_minhash._in_order(values) == np.argsort(values, kind="stable")).all()


def test_bounds_hold_the_edits():
    draw = np.random.default_rng(4)
    for _ in range(1500):
        a = draw.integers(0, draw.choice([2, 5, 30, 1000]), draw.integers(0, 50)).astype(np.uint32)
        b = a.tolist()
        for _ in range(draw.integers(0, 8)):
            at = int(draw.integers(0, len(b) + 1))
            b[at : at + 1] = [[], [9], [9, 7], b[:3]][draw.integers(0, 4)]
        b = np.array(b[5:] + b[:5] if draw.random() < 0.1 else b, np.uint32)
        edits = brute.edits(a.tolist(), b.tolist())
        for most in (edits, max(len(a), len(b)) // 5):
            least, enough = order_minhash.bounds(a, b, most)
            assert least <= edits <= enough
        one, other = ((order_minhash.grams(x) >> np.uint64(44)).astype(np.uint32) for x in (a, b))
        assert order_minhash.strange(one, other) <= order_minhash.GRAM * edits


def test_unlike_texts_of_the_same_words_are_not_aligned(monkeypatch):
    """Many long texts with equal word counts share a passage: none is aligned with another."""
    draw = np.random.default_rng(5)
    words = np.repeat(np.arange(40, dtype=np.uint32), 25)
    texts = [np.concatenate([np.arange(100, 110, dtype=np.uint32), draw.permutation(words)]) for _ in range(30)]
    near = texts[0].copy()
    near[[50, 500]] = 7
    texts.append(near)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    flat, nodes = np.concatenate(texts), np.arange(len(texts))
    group = pa.RecordBatch.from_pydict(
        {
            **{name: np.zeros(len(texts), np.int64) for name in order_minhash.GROUP},
            "right": np.zeros(len(texts), bool),
            "node": nodes,
            "n": np.diff(offsets),
            "root": nodes,
            "profile": [x.tobytes() for x in order_minhash.profiles(flat, offsets)],
            "present": [x.tobytes() for x in order_minhash.presence(flat.astype(np.uint64), offsets)],
            "words": [x.tobytes() for x in texts],
            "draws": [[0]] * len(texts),
        }
    )
    aligned = []
    word_edits = order_minhash.word_edits
    monkeypatch.setattr(order_minhash, "word_edits", lambda *a: aligned.append(a) or word_edits(*a))
    links = [x for found in order_minhash._group_links(group, 0.8) for x in found.to_pylist()]
    assert [(x["a"], x["b"]) for x in links] == [(30, 0)]
    assert len(aligned) <= 1
