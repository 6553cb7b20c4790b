import random
import re

import numpy as np
import pyarrow as pa
import pytest
from brute import prose

from docledger.llm import license_scan, queries
from docledger.llm.license_scan import GAP, LEAST, NOTICES, PHRASES, Templates, scan, scan_texts, words_of

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
BASE = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def base_by_hand(doc, text):
    words = WORD.findall(lower(text))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p := phrase.split())] == p]
    starts = [i for i, _ in places] or [None]
    return doc, len(words), len(places), min(starts), max(starts), ",".join(sorted({x for _, x in places}))


def agree(docs, rows):
    found = sorted(map(tuple, scan(docs).select(BASE).collect()), key=repr)
    assert found == sorted((base_by_hand(i, t) for i, t, *_ in rows), key=repr)


def chopped(seed):
    """Texts of template words, so that phrases and long matches abound."""
    draw = random.Random(seed)
    words = [w for _, t in NOTICES for w in words_of(t)] + [w for p in PHRASES for w in p.split()] * 20
    out = []
    for _ in range(150):
        text = []
        while len(text) < 60:
            at = draw.randrange(len(words))
            text += words[at : at + draw.randrange(1, 9)] + ["other"] * draw.randrange(2)
        out.append(draw.choice([" ", "\n", ", ", "-"]).join(w.upper() if draw.random() < 0.2 else w for w in text))
    return out


def test_places_of_phrases(make):
    rows = list(enumerate(chopped(1))) + [(900, "MIT License mit license mit\nLICENSE cc-by cc bye ÅCC BY"), (901, "MİT license KİT mit_license mit.license")]
    agree(make(rows), rows)


def test_odd_rows(make, odd_rows):
    agree(make(odd_rows), odd_rows)
    assert scan(make([])).count() == 0
    empty = scan(make([(1, None), (2, " .")])).select("labels", "score", "n_base", "first_word").collect()
    assert [tuple(r) for r in empty] == [("", 0.0, 0, None)] * 2


def matches_by_hand(words, texts):
    """Longest runs of template words: (end, length) wherever none is longer, by looking at all runs."""
    held = {tuple(t[a:b]) for t in texts for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    lengths = []
    for end in range(1, len(words) + 1):
        lengths.append(next((n for n in range(end, 0, -1) if tuple(words[end - n : end]) in held), 0))
    return [(i + 1, n) for i, n in enumerate(lengths) if n >= LEAST and (i + 1 == len(lengths) or lengths[i + 1] != n + 1)]


def chains_by_hand(words, notices):
    """Spans of notices: matches chained one after the other, every occurrence found by looking."""
    texts = [words_of(t) for _, t in notices]
    matches = matches_by_hand(words, texts + [p.split() for p in PHRASES])
    spans = []
    for (label, _), text in zip(notices, texts, strict=True):
        chain = None

        def close(chain, label=label, text=text):
            if chain and chain[3] >= license_scan.COVERED * len(text):
                spans.append((label, chain[0], chain[1], chain[3] / len(text)))

        for end, n in matches:
            places = [a + n for a in range(len(text) - n + 1) if text[a : a + n] == words[end - n : end]]
            if not places:
                continue
            if chain and end - n - chain[1] <= GAP:
                later = [x for x in places if x > chain[2]]
                if later:
                    chain = (chain[0], end, later[0], chain[3] + min(later[0] - chain[2], n))
                    continue
                if n not in places and n <= chain[3]:
                    continue
            close(chain)
            chain = (end - n, end, places[0], n)
        close(chain)
    return sorted(spans)


@pytest.mark.parametrize("chunk", [1 << 20, 7, 64])
def test_spans_by_hand(chunk):
    draw = random.Random(chunk)
    texts = chopped(2)[:60]
    for _, notice in NOTICES:
        words = words_of(notice)
        texts.append(f"{prose(1, 20)} {notice} {notice.upper()} {prose(2, 9)}")
        texts.append(" ".join("changed" if draw.random() < 0.1 else w for w in words))
        texts.append(" ".join(w for w in words if draw.random() < 0.9))
        texts.append(" ".join(words[len(words) // 2 :] + words[: len(words) // 2]))
    scans = scan_texts(Templates(PHRASES, NOTICES), pa.array(texts), LEAST, GAP, license_scan.COVERED, chunk)
    for text, one in zip(texts, scans, strict=True):
        words = WORD.findall(lower(text))
        places = [(PHRASES[p], i, i + len(p.split()), 1.0) for p in PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert sorted(one.spans) == sorted(places + chains_by_hand(words, NOTICES))
        assert one.words == len(words) and 0 <= one.score <= 1
        assert one.score >= max([s[3] for s in one.spans], default=0)


def test_notices_are_told_apart(make):
    """A whole notice in other text has its label, scattered words of it have none."""
    draw = random.Random(4)
    rows = [(i, f"{prose(i, 50)}\n{t}\n{prose(i + 50, 50)}") for i, (_, t) in enumerate(NOTICES)]
    found = {r["doc_id"]: r for r in scan(make(rows)).collect()}
    for i, (label, _) in enumerate(NOTICES):
        assert label in found[i]["labels"].split(",") and found[i]["score"] == 1.0
    words = [w for _, t in NOTICES for w in words_of(t)]
    loose = [(i, " ".join(x for _ in range(200) for x in (draw.choice(words), f"w{draw.randrange(50)}"))) for i in range(50)]
    assert {(r["labels"], r["score"]) for r in scan(make(loose)).collect()} == {("", 0.0)}


def test_long_texts_in_pieces(make):
    text = f"{'word ' * 3_000_000}mit {'x' * 3_000_000} mit license {'..' * 2_000_000} cc by"
    (row,) = scan(make([(1, text)], extra=False)).drop("spans").collect()
    assert tuple(row)[1:6] == (3_000_006, 2, 3_000_002, 3_000_004, "cc-by,mit")


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = queries.QUERIES["op13_license_scan"](spark, sf)
    assert found.columns == [*BASE, "labels", "score"]
    rows = found.collect()
    assert {tuple(r)[:6] for r in rows} == {base_by_hand(i, t) for i, t in docs.items()} and len(rows) == len(docs)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in rows)


def test_hashes_are_of_lower_case():
    data = np.frombuffer("ÉMITé mit".encode(), np.uint8)
    lowered = np.frombuffer("Émité mit".encode(), np.uint8)
    at = np.array([0]), np.array([len(data)])
    assert license_scan._hashes(data, *at) == license_scan._hashes(lowered, *at)
