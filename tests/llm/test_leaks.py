import random
import re

import brute
from brute import prose

from docledger.llm import decontamination


def plain(text):
    return re.findall(r"\w+", (text or "").lower())


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, score string")


def items(n=30):
    draw = random.Random(2)
    return [(i, prose(100 + i, draw.randrange(12, 40), 90).capitalize() + ". " + prose(200 + i, 6, 90).capitalize() + ".") for i in range(n)]


def test_like_brute_force(spark, make):
    """All pairs of passages and items above the threshold that have question and answer, by scoring every pair."""
    draw = random.Random(3)
    tests, rows = items(), []
    for i in range(80):
        words = prose(i, draw.randrange(0, 260), 90).split()
        if i % 3 == 0:
            leak = draw.choice(tests)[1].split()
            for _ in range(draw.randrange(0, 14)):
                leak[draw.randrange(len(leak))] = "other"
            at = draw.randrange(len(words) + 1)
            words[at:at] = leak
        rows.append((i, " ".join(words)))
    found = decontamination.find_leaks(make(rows), benchmark(spark, [(*t, "x") for t in tests])).collect()
    got = {(r["doc_id"], r["item_id"]): (r["score"], r["question"], r["answer"]) for r in found}
    words = [plain(t) for _, t in tests]
    parts = [[decontamination.grams(plain(p)) for p in decontamination.question_and_answer(t)] for _, t in tests]
    stride = max(decontamination.LEAST_STRIDE, max(map(len, words)))
    expected = {}
    for i, text in rows:
        own = plain(text)
        for start in range(0, max(len(own), 1), stride):
            passage = own[start : start + 2 * stride]
            for j, score in enumerate(brute.item_scores(words, set(passage))):
                shares = [len(p & {tuple(passage[x : x + 3]) for x in range(len(passage) - 2)}) / len(p) for p in parts[j]]
                if score >= decontamination.THRESHOLD and shares[0] >= 0.6 and shares[1] >= 0.5:
                    expected[i, j] = max(expected.get((i, j), (0.0,)), (score, *shares))
    assert got.keys() == expected.keys() and len(got) > 5
    assert all(abs(a - b) < 1e-9 for k in got for a, b in zip(got[k], expected[k]))


def test_shards_find_the_same_copies(spark, make):
    tests = items()
    rows = [(i, f"{prose(i, 70)} {tests[i][1].upper()} {prose(i + 50, 90)}") for i in range(0, 30, 2)]
    table = benchmark(spark, [(*t, "x") for t in tests])
    for size in (decontamination.INDEX_BYTES, 1500):
        found = decontamination.find_leaks(make(rows), table, size).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i in range(0, 30, 2)}
        left = decontamination.drop_leaking(make([*rows, (99, prose(5, 300))]), table, size)
        assert [r["doc_id"] for r in left.collect()] == [99] and left.columns == make([]).columns


def test_odd_rows_and_items(spark, make, odd_rows):
    odd = benchmark(spark, [(None, None, ""), (1, "", ""), (2, "...", ""), (3, "w", ""), (None, "no id here but some words", ""), (5, "é" * 50, "")])
    docs = make(odd_rows)
    found = decontamination.find_leaks(docs, odd).collect()
    assert (None, None) in {(r["doc_id"], r["item_id"]) for r in found}
    assert decontamination.drop_leaking(docs, odd).count() == len(odd_rows) - 1
    nothing = benchmark(spark, [])
    assert decontamination.find_leaks(docs, nothing).count() == 0 and decontamination.drop_leaking(docs, nothing).count() == len(odd_rows)
    assert decontamination.find_leaks(make([]), odd).count() == 0


def test_question_and_answer():
    assert decontamination.question_and_answer("What is it? A cat.") == ("What is it? ", "A cat.")
    assert decontamination.question_and_answer("one two three four") == ("one two three", "four")


def test_scores_do_not_depend_on_shards(spark, make):
    draw, tests, rows = random.Random(8), items(), []
    tests += [(100 + i, "Every common word w1 w2 w3 stands here. " + prose(300 + i, 60, 30).capitalize() + ".") for i in range(4)]
    for i in range(60):
        leak = draw.choice(tests)[1].split()
        for _ in range(draw.randrange(0, 14)):
            leak[draw.randrange(len(leak))] = "other"
        rows.append((i, f"{prose(i, 70, 90)} {' '.join(leak)} {prose(i + 50, 90, 90)}"))
    table = benchmark(spark, [(*t, "x") for t in tests])
    found = [
        {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in decontamination.find_leaks(make(rows), table, size).collect()}
        for size in (decontamination.INDEX_BYTES, 1500)
    ]
    assert found[0].keys() == found[1].keys() and len(found[0]) > 20
    assert all(abs(a - b) < 1e-9 for k in found[0] for a, b in zip(found[0][k], found[1][k]))


def test_ids_of_any_type(spark, make):
    text = items()[3][1]
    for kind, value in (("int", 7), ("short", 7), ("long", 7), ("string", "x7")):
        table = spark.createDataFrame([(value, text)], f"item_id {kind}, text string")
        (row,) = decontamination.find_leaks(make([(1, f"{prose(1, 40)} {text}")]), table).collect()
        assert row["item_id"] == value
