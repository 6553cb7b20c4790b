"""Alignment of the tokens of two tokenizers.

A byte-level BPE (A) and a sentencepiece model with byte fallback (B) cut the same bytes, a space and the text. A's character
offsets and B's span proto are the coarse cuts: turned into bytes they are exact wherever a token begins and ends between
characters. Tokens inside a multibyte character and byte-fallback tokens share or lack their spans; runs of them are
refined with the lengths of their decoded bytes, from the last exact cut on. (The installed sentencepiece calls the
immutable proto ``serialized_proto``; it holds the same spans.)

Texts are cut at single spaces between two visible characters. A's pattern begins a new word there, and no piece of B goes
on past a space (the vocabulary is checked), so the tokens of the segments are the tokens of the text, and a
segment's end is an end of both. So each different segment is encoded and aligned once, kept for the task up to ``KEPT``
characters, and a document is the sum of its segments: this saves most of the work and bounds the memory that a long text
takes, as texts are read in blocks of ``BLOCK`` characters.

Links of a document are counted by id pair. The corpus-wide count of a pair is the number of documents with it, one
partial aggregation over the written links; documents meet the counts again in a join. Counts of at most ``BROADCAST_PAIRS``
pairs, counted before, are broadcast; more are joined by merging, on both ids.

Defined cases. Null and empty texts have no tokens, nor have texts whose tokens do not give the text's bytes back (such as
those with U+2581): zeros, and an empty string for the groups. Each row is a document, repeated ones too. ``doc_id`` may
have any type and be null; other columns are not read. A segment without a cut is encoded as a whole.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2, sentencepiece_pb2
from tokenizers import Tokenizer

from docledger.llm import buffers
from docledger.llm.repeats import row_groups
from docledger.llm.store import map_arrow, settled

VOCABULARIES = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK, CHUNK, KEPT = 1 << 18, 1 << 22, 1 << 22
JOINED = 1 << 14  # segments that are encoded at once
BROADCAST_PAIRS = 1 << 20

_VISIBLE = "[!-~À-ʯͰ-ϿЀ-ҁҊ-ԯ一-鿿]"
_CUT = re.compile(f"(?<={_VISIBLE}) (?={_VISIBLE})")
_INNER = re.compile(f"{_VISIBLE}(?:.*{_VISIBLE})?", re.DOTALL)


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 characters for themselves, all
    other bytes, in order, as the characters from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_offsets(data: bytes) -> np.ndarray:
    """Where each character starts, and the end."""
    flat = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))


def refined(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes, from coarse spans where they fit the decoded sizes, else from these.

    A run of tokens that do not fit begins where the last one that fits ends.
    """
    fits = ends - starts == sizes
    if fits.all():
        return ends
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(len(sizes))
    last = np.maximum.accumulate(np.where(fits, at, -1))
    before = np.where(last >= 0, ends[last], 0) - total[last + 1]
    return np.where(fits, ends, before + total[1:])


class Segments:
    """What a document takes from its segments, by number."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}  # -1: the bytes differ
        self.groups: list[bytes] = []  # written out, a semicolon after each
        self.counts = np.zeros((0, 3), np.int64)  # tokens of A, of B, groups
        self.links = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)  # where a segment's links begin
        self.kept = 0

    def linked(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links by id pair of the segments with these numbers, with their numbers."""
        which, times = np.unique(which, return_counts=True)
        sizes = self.first[which + 1] - self.first[which]
        at = np.arange(sizes.sum()) + np.repeat(self.first[which] - np.cumsum(sizes) + sizes, sizes)
        return self.links[at], np.repeat(times, sizes)


def by_pair(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(pairs, return_inverse=True)
    return pairs, np.bincount(at, counts, len(pairs)).astype(np.int64)


class Pair:
    """Both tokenizers, and the segments met so far."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the executor's cores
        self.a = Tokenizer.from_buffer(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token)
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.IsByte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.IdToPiece, range(self.b.GetPieceSize())))
        ]
        self.sizes = [np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes)]
        self.cuts = self._cuts(piece_bpe)
        self.names = [
            np.array([[b"%d%s" % (i, mark) for i in range(len(table))] for mark in (b",", end)], object)
            for table, end in ((self.a_bytes, b"|"), (self.b_bytes, b";"))
        ]
        self.known = Segments()

    def _cuts(self, piece_bpe: bytes) -> bool:
        """Whether B's tokens end at every cut: spaces only lead pieces, and nothing is normalised or merged across them."""
        model = sentencepiece_model_pb2.ModelProto.FromString(piece_bpe)
        leading = all("▁" not in p.piece.lstrip("▁") for p in model.pieces)
        plain = not model.normalizer_spec.precompiled_charsmap and not model.normalizer_spec.remove_extra_whitespaces
        return leading and plain and model.normalizer_spec.add_dummy_prefix and not model.trainer_spec.treat_whitespace_as_suffix

    def learn(self, texts: Iterable[str]) -> None:
        """Encode and align the segments that are not known yet, all in one go."""
        texts = list(dict.fromkeys(texts))
        new = [t for t in texts if t not in self.known.number]
        size = sum(map(len, new))
        if new and self.known.kept + size > KEPT:
            self.known, new, size = Segments(), texts, sum(map(len, texts))
        self.known.kept += size
        inner = [t for t in new if self.cuts and _INNER.fullmatch(t)]
        for i in range(0, len(inner), JOINED):
            self._learn(inner[i : i + JOINED])
        if len(inner) < len(new):
            joined = set(inner)
            for text in new:
                if text not in joined:
                    self._learn([text])

    def _learn(self, texts: list[str]) -> None:
        """Segments that may stand in one text are encoded as one; where its bytes differ, each half alone."""
        if not self._align(texts):
            if len(texts) == 1:
                self.known.number[texts[0]] = -1
            else:
                self._learn(texts[: len(texts) // 2])
                self._learn(texts[len(texts) // 2 :])

    def _align(self, texts: list[str]) -> bool:
        text = " ".join(texts)
        code = self.a.encode(f" {text}", add_special_tokens=False)
        pieces = sentencepiece_pb2.SentencePieceText.FromString(self.b.encode(text, return_type="serialized_proto")).pieces
        data, a_ids = f" {text}".encode(), code.ids
        b = np.array([x for p in pieces for x in (p.id, p.begin, p.end)], np.int64).reshape(-1, 3)
        b_ids = b[:, 0].tolist()
        if b"".join([self.a_bytes[i] for i in a_ids]) != data or b"".join([self.b_bytes[i] for i in b_ids]) != data:
            return False
        a_spans = np.fromiter(chain.from_iterable(code.offsets), np.int64, 2 * len(a_ids)).reshape(-1, 2)
        # B's spans are in bytes of the text, which begins after the space that stands for the first piece's mark.
        b_spans = b[:, 1:] + 1
        b_spans[0, 0] = 0
        known, a, starts = self.known, np.array(a_ids), byte_offsets(data)
        a_ends = refined(starts[a_spans[:, 0]], starts[a_spans[:, 1]], self.sizes[0][a])
        b_ends = refined(b_spans[:, 0], b_spans[:, 1], self.sizes[1][b[:, 0]])
        # Every stretch between neighbouring ends is one overlap of a token of A with one of B.
        ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")  # merges two sorted runs
        twice = ends[1:] == ends[:-1]
        common, ends = ends[1:][twice], ends[np.append(True, ~twice)]
        links = a[np.searchsorted(a_ends, ends)] * len(self.b_bytes) + b[np.searchsorted(b_ends, ends), 0]
        stops = starts[np.cumsum([len(t) + 1 for t in texts])]
        within = [np.searchsorted(x, stops, side="right") for x in (a_ends, b_ends, common, ends)]
        known.links = np.concatenate([known.links, links])
        known.first = np.concatenate([known.first, known.first[-1] + within[3]])
        known.counts = np.concatenate([known.counts, np.column_stack([np.diff(x, prepend=0) for x in within[:3]])])
        # Written out in order of groups, A's ids before B's; the last of its kind in a group has another mark behind it.
        groups = [np.searchsorted(common, x) for x in (a_ends, b_ends)]
        last = [(common[g] == x).astype(np.int64) for g, x in zip(groups, (a_ends, b_ends), strict=True)]
        order = np.argsort(np.concatenate([2 * groups[0], 2 * groups[1] + 1]), kind="stable")
        written = np.concatenate([self.names[0][last[0], a], self.names[1][last[1], b[:, 0]]])[order].tolist()
        first = 0
        for text, last in zip(texts, (within[0] + within[1]).tolist(), strict=True):
            known.number[text] = len(known.groups)
            known.groups.append(b"".join(written[first:last]))
            first = last
        return True

    def blocks(self, text: str) -> Iterator[list[str]]:
        """The text's segments, in blocks of at least ``BLOCK`` characters."""
        if not self.cuts:
            yield from [[text]] if text else []
            return
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + BLOCK) if at + BLOCK < len(text) else None
            yield _CUT.split(text[at : cut.start() if cut else len(text)])
            at = cut.end() if cut else len(text)

    def align(self, blocks: Iterable[list[str]]) -> tuple[list[int], str, np.ndarray, np.ndarray]:
        """Numbers of tokens of A and B, groups and links of a text, its groups' hash, and its links by id pair with their numbers."""
        sums, n_links, digest, nothing = np.zeros(3, np.int64), 0, hashlib.sha256(), np.zeros(0, np.int64)
        pairs, counts = nothing, nothing
        for number, texts in enumerate(blocks):
            self.learn(texts)
            which = [self.known.number[t] for t in texts]
            if -1 in which:
                return [0] * 4, "", nothing, nothing
            digest.update(b";" * bool(number) + b"".join([self.known.groups[i] for i in which])[:-1])
            which = np.array(which)
            sums += self.known.counts[which].sum(axis=0)
            more, times = self.known.linked(which)
            n_links += int(times.sum())
            pairs, counts = by_pair(np.concatenate([pairs, more]), np.concatenate([counts, times]))
        return [*sums.tolist(), n_links], digest.hexdigest() if n_links else "", pairs, counts


@functools.lru_cache(maxsize=1)
def _pair(byte_bpe: bytes, piece_bpe: bytes) -> Pair:
    return Pair(byte_bpe, piece_bpe)


LINKS = "array<struct<a:int,b:int,n:int>>"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` and ``links``, by id pair."""
    files = []
    for path in (byte_bpe, piece_bpe):
        with open(path, "rb") as file:
            files.append(file.read())
    held = docs.sparkSession.sparkContext.broadcast(files)  # two vocabulary files of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*held.value)
        for batch in batches:
            _, offsets = buffers.text_bytes(batch.column("text"))
            for first, last in row_groups(offsets, CHUNK):
                rows = batch.slice(first, last - first)
                texts = [pair.blocks(t or "") for t in rows.column("text").to_pylist()]
                if last - first > 1:  # texts of together one chunk; a longer one is read block by block
                    texts = [list(blocks) for blocks in texts]
                    pair.learn(s for blocks in texts for block in blocks for s in block)
                done = [pair.align(blocks) for blocks in texts]
                pairs, counts = (np.concatenate([d[i] for d in done]) for i in (2, 3))
                ends = np.concatenate([[0], np.cumsum([len(d[2]) for d in done])]).astype(np.int32)
                a, b = np.divmod(pairs, len(pair.b_bytes))
                links = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (a, b, counts)], names=["a", "b", "n"])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        *(pa.array([d[0][i] for d in done], pa.int64()) for i in range(4)),
                        pa.array([d[1] for d in done], pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends), links),
                    ],
                    names=["doc_id", *COUNTS, "groups_sha256", "links"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {id_type}, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string, links {LINKS}"
    return map_arrow(docs.select("doc_id", "text"), run, kinds)


def pair_counts(links: DataFrame) -> DataFrame:
    """``a, b, docs, best``: how many documents have each id pair linked, and whether no pair of ``a`` is in more."""
    counts = links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"))
    counts = settled(counts)
    highest = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return settled(counts.join(highest.hint("merge"), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best")))


def align(
    docs: DataFrame,
    byte_bpe: str = f"{VOCABULARIES}/{BYTE_BPE}",
    piece_bpe: str = f"{VOCABULARIES}/{PIECE_BPE}",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best`` counts the links whose pair is in as many documents as any of its A id, ``count_sum`` sums the links' counts.
    """
    rows = settled(aligned(docs, byte_bpe, piece_bpe).withColumn("row", F.monotonically_increasing_id()))
    links = rows.select("row", F.inline("links"))
    counts = pair_counts(links)
    counts = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts.hint("merge")
    n = F.col("n").cast("long")
    sums = links.join(counts, ["a", "b"]).groupBy("row").agg(F.sum(F.when(F.col("best"), n).otherwise(0)).alias("n_best"), F.sum(n * F.col("docs")).alias("count_sum"))
    found = rows.drop("links").join(sums.hint("merge"), "row", "left")
    added = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return found.select("doc_id", *COUNTS, *added, "groups_sha256")
