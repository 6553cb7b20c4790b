"""Benchmark decontamination: BM25 over an inverted index of the test items, searched with block-max pruning.

Every document is read as overlapping passages, long enough that each copy of a test item lies wholly in one, and each passage
is a query. An item's score is its BM25 score divided by the score of a passage that has all its words, so ``THRESHOLD`` means
the same for all items and every passage-item pair above it is found:

* Of each item's words the lightest, together at most ``SLACK``, are left to the end; a passage above the threshold needs
  ``THRESHOLD - SLACK`` from the others. Only these have posting lists.
* Posting lists hold, for blocks of ``BLOCK_ITEMS`` items, the largest weight of the word in the block. A passage's sum of these
  bounds the score of all items in the block; blocks below the bound are skipped, in arrays, for all passages at once.
* Items of the remaining blocks are scored exactly.

A retrieved pair is a leak if the passage also has the item's question and answer: shares of their word ``GRAM``-grams.

The index is broadcast in shards of at most ``INDEX_BYTES`` of item text, each passed over all documents (one shard, unless
the benchmark is large). Documents are not shuffled. Document frequencies of words, number and mean length of items and the
length of passages are those of the whole benchmark, so scores do not depend on the shards.

Defined cases. Null and empty texts: no passages. Items without words are left out; an item whose text has no end of a sentence
before its last words has its last quarter as answer. Repeated items each count; rows with equal ids are judged singly; ids
may be null. An empty benchmark finds nothing. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docledger.llm import buffers
from docledger.llm.repeats import row_groups
from docledger.llm.store import map_arrow, settled
from docledger.llm.toxicity import _APART, lowered

THRESHOLD, SLACK = 0.6, 0.3
K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
GRAM, QUESTION_OVERLAP, ANSWER_OVERLAP = 3, 0.6, 0.5
LEAST_STRIDE = 32
INDEX_BYTES = 8 << 20
CHUNK = 1 << 20


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-case words of letters and digits, and the rows' offsets in them."""
    data = lowered(data)
    starts, ends, at = buffers.word_spans(data, offsets, _APART)
    out = np.empty(len(starts), np.uint64)
    step = 1 << 17
    for a in range(0, len(starts), step):
        s, e = starts[a : a + step], ends[a : a + step]
        out[a : a + step] = buffers.word_hashes(data[s[0] : e[-1]], s - s[0], e - s[0])
    return out, at


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence or line is the answer; of a single one, the last quarter of its words."""
    text = text.strip()
    cut = [m.end() for m in re.finditer(r"[.?!]\s+|\n", text)]
    if cut and re.search(r"\w", text[: cut[-1]]) and re.search(r"\w", text[cut[-1] :]):
        return text[: cut[-1]], text[cut[-1] :]
    words = text.split()
    n = max(1, len(words) - max(1, len(words) // 4))
    return " ".join(words[:n]), " ".join(words[n:] or words)


def grams(words: list[int]) -> set[tuple[int, ...]]:
    n = min(GRAM, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class Index:
    ids: list
    words: np.ndarray  # sorted hashes of the words that have posting lists
    first: np.ndarray  # of their posting lists
    blocks: np.ndarray
    weights: np.ndarray  # largest in the block
    needed: np.ndarray  # by block
    items: list[dict[int, float]]  # all words of an item and their shares of its score
    questions: list[set]
    answers: list[set]
    seen: np.ndarray
    stride: int


@dataclass
class Statistics:
    """Of the whole benchmark; ``having`` may be limited to the words of a shard."""

    having: dict[int, int]
    items: int
    mean: float
    longest: int


def build(rows: list[tuple[object, str]], whole: Statistics | None = None) -> Index | None:
    """An index of the items; without ``whole`` they are the whole benchmark."""

    def hashes(text: str) -> list[int]:
        return words_of(*buffers.text_bytes(pa.array([text])))[0].tolist()

    kept = [(i, text, words) for i, text in rows if text and (words := hashes(text))]
    if not kept:
        return None
    counts = [Counter(words) for _, _, words in kept]
    if whole is None:
        lengths = [len(words) for _, _, words in kept]
        whole = Statistics(Counter(w for c in counts for w in c), len(kept), sum(lengths) / len(kept), max(lengths))
    having = whole.having
    items, lists, needed = [], {}, np.full(-(-len(kept) // BLOCK_ITEMS), np.inf)
    for i, (_, _, words) in enumerate(kept):
        norm = K1 * (1 - B + B * len(words) / whole.mean)
        own = {w: math.log(1 + (whole.items - having[w] + 0.5) / (having[w] + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in counts[i].items()}
        total = sum(own.values())
        own = {w: x / total for w, x in own.items()}
        items.append(own)
        left = 0.0
        block = i // BLOCK_ITEMS
        for w, x in sorted(own.items(), key=lambda p: (p[1], p[0])):
            if left + x <= SLACK:
                left += x
            else:
                held = lists.setdefault(w, {})
                held[block] = max(held.get(block, 0.0), x)
        needed[block] = min(needed[block], THRESHOLD - left)
    order = sorted(lists)
    words = np.array(order, np.uint64)
    seen = np.zeros(1 << 20, bool)
    seen[words & np.uint64(len(seen) - 1)] = True
    parts = [question_and_answer(text) for _, text, _ in kept]
    return Index(
        [i for i, _, _ in kept],
        words,
        np.cumsum([0, *(len(lists[w]) for w in order)]),
        np.array([b for w in order for b in lists[w]], np.int64),
        np.array([x for w in order for x in lists[w].values()]),
        needed,
        items,
        [grams(hashes(q)) for q, _ in parts],
        [grams(hashes(a)) for _, a in parts],
        seen,
        max(LEAST_STRIDE, whole.longest),
    )


def promising(index: Index, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, passage and block of all pairs that may hold an item above the threshold."""
    hit = np.flatnonzero(index.seen[words & np.uint64(len(index.seen) - 1)])
    term = np.searchsorted(index.words, words[hit])
    term[term == len(index.words)] = 0
    real = index.words[term] == words[hit]
    hit, term = hit[real], term[real]
    row = np.searchsorted(at, hit, side="right") - 1
    cells = np.concatenate([[0], np.cumsum(-(-np.diff(at) // index.stride))])
    cell = cells[row] + (hit - at[row]) // index.stride
    before = cell > cells[row]  # passage c has the cells c and c + 1
    pairs = np.unique(np.concatenate([cell, cell[before] - 1]) * len(index.words) + np.concatenate([term, term[before]]))
    passage, term = np.divmod(pairs, len(index.words))
    lengths = index.first[term + 1] - index.first[term]
    posting = np.repeat(index.first[term] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    key = np.repeat(passage, lengths) * len(index.needed) + index.blocks[posting]
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.diff(key, prepend=-1))
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    bound = np.add.reduceat(index.weights[posting[order]], start)
    passage, block = np.divmod(key[start], len(index.needed))
    keep = bound >= index.needed[block] - 1e-9
    passage, block = passage[keep], block[keep]
    row = np.searchsorted(cells, passage, side="right") - 1
    return row, passage - cells[row], block


def leaks(index: Index, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[float, float, float, int]]:
    """By row and item: the best passage's score, shares of question and answer, and first word."""
    words, at = words_of(data, offsets)
    found: dict[tuple[int, int], tuple[float, float, float, int]] = {}
    for row, passage, block in zip(*(x.tolist() for x in promising(index, words, at)), strict=True):
        start = at[row] + passage * index.stride
        text = words[start : min(start + 2 * index.stride, at[row + 1])].tolist()
        distinct, held = set(text), None
        for item in range(block * BLOCK_ITEMS, min((block + 1) * BLOCK_ITEMS, len(index.items))):
            score = sum(x for w, x in index.items[item].items() if w in distinct)
            if score < THRESHOLD:
                continue
            held = held or {}
            shares = []
            for part in (index.questions[item], index.answers[item]):
                n = len(next(iter(part), ()))
                if n not in held:
                    held[n] = {tuple(text[i : i + n]) for i in range(len(text) - n + 1)}
                shares.append(len(part & held[n]) / len(part) if part else 1.0)
            if shares[0] >= QUESTION_OVERLAP and shares[1] >= ANSWER_OVERLAP:
                best = (score, *shares, passage * index.stride)
                if best[:3] > found.get((row, item), (0.0,))[:3]:
                    found[row, item] = best
    return found


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of every item; its number of words stands at the first of them, 0 at the others."""
    for batch in batches:
        words, at = words_of(*buffers.text_bytes(batch.column("text")))
        for shard, a, b in zip(batch.column("shard").to_pylist(), at, at[1:], strict=False):
            own = np.unique(words[a:b])
            lengths = np.zeros(len(own), np.int64)
            lengths[:1] = b - a
            columns = [pa.array([shard] * len(own), pa.int64()), pa.array(own.view(np.int64)), pa.array(lengths)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "word", "n"])


def index_shards(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> Iterator[Index]:
    """Indexes of the items (item_id, text), each of at most about ``index_bytes`` of text."""
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-2 * total // index_bytes) if total > index_bytes else 1
    if shards == 1:
        index = build([tuple(r) for r in items.orderBy("item_id", "text").collect()])
        if index:
            yield index
        return
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("long"))
    words = settled(map_arrow(items.select("shard", "text"), _item_words, "shard long, word long, n long"))
    having = settled(words.groupBy("word").agg(F.count(F.lit(1)).alias("having")))
    n, total_words, longest = words.where("n > 0").agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    for shard in range(shards):
        own = words.where(F.col("shard") == shard).select("word").distinct().join(having, "word").collect()
        whole = Statistics({r["word"] & (1 << 64) - 1: r["having"] for r in own}, n, total_words / n if n else 0.0, longest or 0)
        part = items.where(F.col("shard") == shard).select("item_id", "text")
        index = build([tuple(r) for r in part.orderBy("item_id", "text").collect()], whole)
        if index:
            yield index


def find_leaks(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``doc_id, item_id, score, question, answer, first_word`` for every document and item it leaks."""
    types = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}"
    types += ", score double, question double, answer double, first_word long"
    id_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    parts = []
    for index in index_shards(benchmark, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                data, offsets = buffers.text_bytes(batch.column("text"))
                for a, b in row_groups(offsets, CHUNK):
                    found = leaks(index, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    rows = pa.array([a + row for row, _ in found], pa.int64())
                    items = pa.array([index.ids[item] for _, item in found], id_type)
                    values = [pa.array([v[i] for v in found.values()], pa.int64() if i == 3 else pa.float64()) for i in range(4)]
                    names = ["doc_id", "item_id", "score", "question", "answer", "first_word"]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), items, *values], names=names)

        parts.append(map_arrow(docs.select("doc_id", "text"), run, types))
    if not parts:
        return docs.sparkSession.createDataFrame([], types)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text leaks no item. Nothing is shuffled."""
    for index in index_shards(benchmark, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = buffers.text_bytes(batch.column("text"))
                clean = np.ones(batch.num_rows, bool)
                for a, b in row_groups(offsets, CHUNK):
                    for row, _ in leaks(shared.value, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]):
                        clean[a + row] = False
                yield batch.filter(pa.array(clean))

        docs = map_arrow(docs, run, docs.schema)
    return docs
