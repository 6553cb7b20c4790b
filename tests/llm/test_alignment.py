import collections
import random

import numpy as np
import pytest
import sentencepiece
from brute import prose, sha
from tokenizers import Tokenizer

from docledger.llm import queries, token_alignment
from docledger.llm.token_alignment import BYTE_BPE, PIECE_BPE, VOCABULARIES, Pair, align

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Whole:
    """Whole texts, token by token, from ids and decoded bytes alone."""

    def __init__(self):
        self.a = Tokenizer.from_file(f"{VOCABULARIES}/{BYTE_BPE}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{VOCABULARIES}/{PIECE_BPE}")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.IdToPiece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.IsByte(i) else piece.replace("▁", " ").encode()

    def align(self, text):
        if not text:
            return [], [], [], []
        tokens = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        parts = [self.a_bytes(i) for i in tokens[0]], [self.b_bytes(i) for i in tokens[1]]
        if any(b"".join(p) != b" " + text.encode() for p in parts):
            return [], [], [], []
        a, b = ([0, *np.cumsum(list(map(len, p))).tolist()] for p in parts)
        links, groups, i, j, x, y = [], [], 0, 0, 0, 0
        while x < len(tokens[0]):
            links.append((tokens[0][x], tokens[1][y]))
            p, q = a[x + 1], b[y + 1]
            x, y = x + (p <= q), y + (q <= p)
            if p == q:
                groups.append((tokens[0][i:x], tokens[1][j:y]))
                i, j = x, y
        return *tokens, links, groups


def by_hand(rows):
    whole = Whole()
    done = [(i, *whole.align(t)) for i, t, *_ in rows]
    having = collections.Counter(pair for _, _, _, links, _ in done for pair in set(links))
    highest = collections.defaultdict(int)
    for (a, _), n in having.items():
        highest[a] = max(highest[a], n)
    out = []
    for i, a, b, links, groups in done:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        best = sum(having[pair] == highest[pair[0]] for pair in links)
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(having[pair] for pair in links), sha(text.encode()) if a else ""))
    return sorted(out, key=repr)


PARTS = ["the", "Über", "straße", "été", "漢字", "日本語テキスト", "🎉", "👩‍👩‍👧", "العربية", "é", "́", "don't", "'s", "12", "1,234.5", "<s>", "<|endoftext|>", "</s>", "<0x41>", "<unk>", "\x00", "\t", "\n", "\r\n", "  ", "   ", " ", " ", "　", "\x1c", "\u0085", " ", "_", "—", "…", "x" * 40, "ab", "▁", "﻿", "\U0001f1e9\U0001f1ea", "%%%", "http://a.b/c?d=e"]


def mixed(seed, n):
    draw = random.Random(seed)
    usual = [p for p in PARTS if p != "▁"]
    return ["".join(draw.choice(PARTS if draw.random() < 0.02 else usual) + draw.choice(["", " ", " ", " "]) for _ in range(draw.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_like_whole_texts(make, limit):
    """The second run joins the counts by merging."""
    rows = list(enumerate(mixed(1, 250) + PARTS + [f"a {p} b" for p in PARTS] + [f"{p} {p}" for p in PARTS] + [f" {p}" for p in PARTS] + [f"{p} " for p in PARTS]))
    found = align(make(rows), broadcast_pairs=limit)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(rows)


def test_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.QUERIES["op12_token_alignment"](spark, sf).collect()), key=repr) == by_hand(rows)


def test_odd_rows(make, odd_rows):
    assert sorted(map(tuple, align(make(odd_rows)).collect()), key=repr) == by_hand(odd_rows)
    assert align(make([])).count() == 0
    assert [tuple(r) for r in align(make([(None, None), (7, "▁ x")])).orderBy("doc_id").collect()] == [(i, 0, 0, 0, 0, 0, 0, "") for i in (None, 7)]


@pytest.mark.parametrize("limits", [(1, 1, 0), (5, 3, 40), (64, 1000, 1 << 20)])
def test_blocks_and_forgetting_change_nothing(monkeypatch, limits):
    for name, value in zip(("BLOCK", "JOINED", "KEPT"), limits, strict=True):
        monkeypatch.setattr(token_alignment, name, value)
    files = [open(f"{VOCABULARIES}/{name}", "rb").read() for name in (BYTE_BPE, PIECE_BPE)]
    pair, whole = Pair(*files), Whole()
    assert pair.cuts
    for text in mixed(limits[0], 60) + [prose(1, 300)]:
        a, b, links, groups = whole.align(text)
        counts, digest, pairs, times = pair.align(pair.blocks(text))
        assert counts == [len(a), len(b), len(groups), len(links)]
        expected = collections.Counter(x * len(pair.b_bytes) + y for x, y in links)
        assert dict(zip(pairs.tolist(), times.tolist(), strict=True)) == expected
        assert digest == (sha(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups).encode()) if a else "")


def test_refinement_starts_at_the_last_exact_cut():
    starts, ends, sizes = (np.array(x) for x in ([0, 1, 1, 4, 4, 7], [4, 4, 4, 7, 7, 8], [2, 1, 1, 1, 2, 1]))
    assert token_alignment.refined(starts, ends, sizes).tolist() == [2, 3, 4, 5, 7, 8]


def test_a_very_long_text(make):
    text = " ".join(f"word{i % 5000} straße" for i in range(400_000))
    ((n_a, n_b, n_groups, n_links, n_best, count_sum),) = (tuple(r) for r in align(make([(1, text)], extra=False)).select(*COLUMNS[1:7]).collect())
    assert n_links == n_a + n_b - n_groups and n_best == n_links == count_sum
