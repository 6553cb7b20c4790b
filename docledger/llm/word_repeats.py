"""Removal of word passages that an earlier document has, by suffix automata of reference shards.

The reference of a document is every document with a smaller id. It is sharded by anchor (see :mod:`repeats`): a shard is
the different contents around one anchor, in order of their first document. Contents stream past the shard's suffix
automaton, which gives for each place the length of the longest match that ends there (the matching statistics); where
it reaches ``width`` words, the window goes. Then the content joins the automaton. So each shard serves exactly the
passages that can match in it, instead of all documents being sent past all shards. Shards are small
(``repeats.GROUP_ROWS``), and what a task needs of them reaches it through the shuffle.

Defined cases. Null text: no words. Rows without an id neither remove words nor lose any. Rows with equal ids don't remove
each other's words. Fewer than ``width`` words: nothing removed. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm import buffers
from docledger.llm.repeats import Windows, removed_ranges, repeated_ranges
from docledger.llm.store import map_arrow, row_key

WIDTH, GRAM = 50, 8


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, symbol: int, target: int) -> int:
        """The state for ``symbol`` after ``state``, cut off from ``target`` if that also stands for longer strings."""
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = clone
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = clone
            state = self.link[state]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for symbol in sequence:
            target = self.next[last].get(symbol)
            if target is not None:
                last = self._split(last, symbol, target)
                continue
            new, state = self._state(self.length[last] + 1, {}, 0), last
            while state >= 0 and symbol not in self.next[state]:
                self.next[state][symbol] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._split(state, symbol, self.next[state][symbol])
            last = new

    def matches(self, sequence: list[int]) -> Iterator[int]:
        """Length of the longest match that ends at each place."""
        state = length = 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if symbol in self.next[state]:
                state, length = self.next[state][symbol], length + 1
            yield length


def match_shards(width: int):
    def compare(block: list[dict]) -> list[tuple[int, list[tuple[int, int]]]]:
        out = []
        for _, rows in groupby(enumerate(block), key=lambda x: x[1]["anchor"]):
            shard, held = SuffixAutomaton(), False
            for _, same in groupby(rows, key=lambda x: x[1]["first"]):
                new = [(i, np.frombuffer(r["content"], np.int64).tolist()) for i, r in same]
                for i, words in new if held else ():
                    ends = np.flatnonzero(np.fromiter(shard.matches(words), np.int32, len(words)) >= width)
                    if len(ends):
                        cuts = np.flatnonzero(np.diff(ends) > 1) + 1
                        out.append((i, [(int(x[0]) - width + 1, int(x[-1]) - width + 2) for x in np.split(ends, cuts)]))
                for _, words in new:
                    shard.add(words)
                held = True
        return out

    return compare


def remove_passages(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans`` (removed ranges of words) and ``kept``, the words left, joined by
    one space. A word goes if it is covered by ``width`` words that also start in a document with a smaller id."""
    ranges = repeated_ranges(
        docs.where(F.col("doc_id").isNotNull()),
        Windows(width, gram, words=True),
        match_shards(width),
        order=["first", "c1", "c2", "n"],
        whole=F.col("k.doc_id") > F.col("first"),
        hot_value=F.min("first"),
        hot_windows=F.col("seen") < F.col("first"),
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers.text_bytes(batch.column("text"))
            counts, spans, kept = [], [], []
            for i, (starts, ends) in enumerate(removed_ranges(batch, width)):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                counts.append(len(words))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(starts, ends, strict=True)])
                left = zip([0, *ends], [*starts, len(words)], strict=True)
                kept.append(b" ".join(w for a, b in left for w in words[a:b]).decode())
            spans = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), spans, pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "spans", "kept"],
            )

    whole = docs.select(row_key().alias("k"), "doc_id", "text").join(ranges, "k", "left").drop("k")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(whole, apply, f"doc_id {doc_type}, n_words long, spans array<struct<start:long,end:long>>, kept string")
