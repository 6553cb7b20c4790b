import random

import brute
import numpy as np
import pytest
from brute import prose
from pyspark.sql import functions as F

from docledger.llm import buffers, byte_repeats, repeats, word_repeats


def removed():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def bytes_of(df):
    rows = df.select("doc_id", "n_bytes", removed(), F.size("spans"), F.sha2("kept", 256)).collect()
    return sorted(map(tuple, rows), key=repr)


def words_of(df):
    rows = df.select("doc_id", "n_words", removed(), F.sha2(F.col("kept").cast("binary"), 256)).collect()
    return sorted(map(tuple, rows), key=repr)


def similar_rows(seed, n=60):
    draw = random.Random(seed)
    base = [[draw.choice("abcd") for _ in range(80)] for _ in range(3)]
    rows = []
    for i in range(n):
        text = list(draw.choice(base))
        for _ in range(draw.randrange(4)):
            text[draw.randrange(len(text))] = draw.choice("abcde")
        rows.append((draw.choice([i, i, max(0, i - 1), None]), "".join(text[draw.randrange(20) : 80 - draw.randrange(20)])))
    return rows + [(1, "abab" * 30), (2, "abab" * 9), (3, "")]


@pytest.mark.parametrize("limit", [repeats.GROUP_ROWS, 2])
def test_bytes_like_brute_force(make, monkeypatch, limit):
    """The second run deals all contents of common anchors out as single windows."""
    monkeypatch.setattr(repeats, "GROUP_ROWS", limit)
    rows = similar_rows(limit)
    assert bytes_of(byte_repeats.remove_repeats(make(rows), 12, 4)) == sorted(brute.byte_repeats(rows, 12), key=repr)


@pytest.mark.parametrize("limit", [repeats.GROUP_ROWS, 2])
def test_words_like_brute_force(make, monkeypatch, limit):
    monkeypatch.setattr(repeats, "GROUP_ROWS", limit)
    rows = [(i, " ".join(t)) for i, t in similar_rows(limit + 1)]
    assert words_of(word_repeats.remove_passages(make(rows), 12, 4)) == sorted(brute.word_repeats(rows, 12), key=repr)


def test_odd_rows(make, odd_rows):
    assert bytes_of(byte_repeats.remove_repeats(make(odd_rows))) == sorted(brute.byte_repeats(odd_rows, 400), key=repr)
    assert words_of(word_repeats.remove_passages(make(odd_rows))) == sorted(brute.word_repeats(odd_rows, 50), key=repr)


def test_empty_tables(make):
    assert byte_repeats.remove_repeats(make([])).count() == 0
    assert word_repeats.remove_passages(make([])).count() == 0


def test_long_rows_are_cut_into_pieces_without_losing_windows():
    offsets = np.array([0, 5, 5, 120, 131])
    for most in (7, 20, 1000):
        seen = [(r, w) for rows, a, b in buffers.pieces(offsets, 10, most) for r, x, y in zip(rows, a, b) for w in range(x, y - 9)]
        assert sorted(seen) == [(r, w) for r in range(4) for w in range(offsets[r], offsets[r + 1] - 9)]


def test_anchors_depend_on_the_window_alone():
    draw = np.random.default_rng(3)
    rows = [draw.integers(0, 3, n).astype(np.uint8) for n in (50, 0, 9, 70, 10)]
    data, offsets = np.concatenate(rows), np.cumsum([0, *map(len, rows)])
    grams = buffers.Rolling(buffers.BYTE_VALUES[0][data]).windows(3)
    places = {}
    row, start, n, anchor = buffers.anchored_runs(grams, offsets, 10, 3)
    assert n.sum() == sum(max(0, len(r) - 9) for r in rows)
    for r, s, m, a in zip(row, start, n, anchor):
        assert offsets[r] <= s and s + m + 9 <= offsets[r + 1]
        for w in range(s, s + m):
            assert places.setdefault(data[w : w + 10].tobytes(), a - w) == a - w and 0 <= a - w <= 7


def test_automaton_gives_matching_statistics():
    draw = random.Random(5)
    automaton, held = word_repeats.SuffixAutomaton(), []
    for _ in range(6):
        held.append([draw.randrange(3) for _ in range(25)])
        automaton.add(held[-1])
    text = [draw.randrange(3) for _ in range(60)]
    inside = {tuple(h[a:b]) for h in held for a in range(25) for b in range(a + 1, 26)}
    expected = [max((n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in inside), default=0) for i in range(60)]
    assert list(automaton.matches(text)) == expected


def test_passages_of_words_keep_order_of_ids(make):
    """The copy with the smallest id keeps its words, whatever the order of rows."""
    text = prose(9, 200)
    found = {r["doc_id"]: r["kept"] for r in word_repeats.remove_passages(make([(30, text), (10, text), (20, "a " + text)])).collect()}
    assert found == {10: text, 20: "a", 30: ""}
