"""Near-duplicates by Order MinHash, verified by banded alignment.

A document's shingles of ``SHINGLE`` words are labelled with their occurrence, so repeats count. Each of ``SKETCHES`` draws
takes the ``2`` shingles with the smallest hashes and keeps them in text order: equal draws need equal shingles in equal
order, which follows the edit similarity better than sets of shingles do. The smallest shingle alone is a draw of its own:
at the threshold scattered edits leave a fifth of the shingles in common, and two equal ones are too rare to find all such
pairs, while one of ``SKETCHES`` is missed by less than one pair in a hundred, if texts have 50 words or more.

Documents that share a draw are candidates. A bucket's members are compared with one of them: each text with the
``FIRST_CANDIDATES`` such members that it shares most draws with. That joins most copies. In buckets that still hold several classes all pairs of different ones are compared by their lengths,
words present and word counts, which bound the edits from below: members are dealt by length and salt to blocks of about
``BLOCK``, and two blocks meet in one small group, whatever the bucket's size. Members of a pair that may be a link get their
words and meet again; pairs are aligned inside the group, unless they are in one class by then, and only links become rows, fewer
than the group has members. A candidate is a link if 1 - (word edits / words of the longer text) is at least ``SIMILARITY``; the alignment only visits cells
that near the diagonal, which suffices to decide that. Classes are the connected components.

Exact copies are one node from the first aggregation on, so groups of them of any size cost nothing later.

Defined cases. Texts without words (null, empty, blank) are in no bucket: each is its own class. Up to ``SHINGLE``
words: one shingle of all words, so only equal texts meet. Rows with equal words are in one class, whatever their ids; a class
is named after its smallest id (null if a member has none; ``class_hash`` keeps such classes apart). Other columns are
not read.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.llm import buffers
from docledger.llm.components import components
from docledger.llm.repeats import row_groups, symbol_values
from docledger.llm.store import fresh, map_arrow, row_key, settled, spent
from docledger.operators.lineage import write_once

SHINGLE, SKETCHES, SIMILARITY = 5, 32, 0.8
PROFILE = 256  # counts of words that bound the edits of a pair
PRESENT = 1024  # bits for the words present, with their occurrence
BLOCK = 4096  # members of a bucket that are compared at once
BLOCK_WORDS = 1 << 22  # of them
PAIRS_AT_ONCE = 1 << 15
CHUNK = 1 << 19  # bytes of text that are worked on at once: their arrays of hashes take some 20 times as much
GRAM = 3  # words whose runs bound the edits of two texts before these are aligned
FIRST_BAND = 64
PLACES_BYTES = 1 << 25  # for the places of words while two texts are aligned
FIRST_CANDIDATES = 8  # of a text, before all pairs are compared

_DRAW = np.random.default_rng(20190714)
_SALTS = _DRAW.integers(0, 1 << 64, 256, dtype=np.uint64)
_FACTORS = _DRAW.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 26) - 1)
ORDERS = _SALTS[:8].view(np.int64).tolist()  # of buckets: by their number with these bits turned


def _in_order(values: np.ndarray) -> np.ndarray:
    """Their places so that equal values follow each other by place; most often by one sort without places."""
    if len(values) <= int(_PLACE):
        ranked = (values & ~_PLACE) | np.arange(len(values), dtype=np.uint64)
        ranked.sort()
        order = (ranked & _PLACE).astype(np.int64)
        ranked >>= np.uint64(26)
        beside = ranked[1:] == ranked[:-1]
        if np.array_equal(values[order[1:]][beside], values[order[:-1]][beside]):  # else other values lie between equal ones
            return order
    return np.argsort(values, kind="stable")


def occurrence_labelled(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that also tell equal ones in one row apart by their order."""
    own = buffers.mixed(hashes + buffers.mixed(row.astype(np.uint64) + np.uint64(1)))
    order = _in_order(own)
    same = np.zeros(len(own), bool)
    same[1:] = own[order[1:]] == own[order[:-1]]
    if not same.any():
        return hashes
    at = np.arange(len(own))
    nth = at - np.maximum.accumulate(np.where(same, 0, at))
    label = np.empty(len(own), np.uint64)
    label[order] = nth
    return np.where(label > 0, buffers.mixed(hashes + label), hashes)


def sketches(values: np.ndarray, offsets: np.ndarray, shingle: int, draws: int) -> np.ndarray:
    """One row for each text of word hashes: ``draws`` values of two shingles, then of the smaller one alone; texts have a word."""
    lengths = np.diff(offsets)
    counts = np.maximum(lengths - shingle + 1, 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(lengths)), counts)
    start = np.arange(first[-1]) - first[row] + offsets[row]
    labelled = occurrence_labelled(buffers.Rolling(values).ranges(start, np.minimum(start + shingle, offsets[row + 1])), row)
    out = np.empty((len(lengths), 2 * draws), np.uint64)
    at = np.arange(len(labelled), dtype=np.uint64)
    single = counts == 1
    top = np.uint64(np.iinfo(np.uint64).max)
    ranked = np.empty_like(labelled)
    for i in range(draws):
        np.bitwise_xor(labelled, _SALTS[i], out=ranked)
        ranked *= _FACTORS[i]
        ranked &= ~_PLACE
        ranked |= at
        one = (np.minimum.reduceat(ranked, first[:-1]) & _PLACE).astype(np.int64)
        labelled_one = labelled[one]
        ranked[one] = top
        two = (np.minimum.reduceat(ranked, first[:-1]) & _PLACE).astype(np.int64)
        two[single] = one[single]
        before, after = labelled[np.minimum(one, two)], labelled[np.maximum(one, two)]
        out[:, i] = buffers.mixed(buffers.mixed(before + _SALTS[i]) * np.uint64(31) + after)
        out[:, draws + i] = buffers.mixed(labelled_one + ~_SALTS[i])
    return out


def _places(words: list[int]) -> tuple[dict[int, int], dict[int, list[int]]]:
    """Where each word stands: for the most frequent ones, in ``PLACES_BYTES``, as bits of one integer, else as a list."""
    found: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        found.setdefault(word, []).append(i)
    size = len(words) // 8 + 1
    often = sorted(found, key=lambda w: len(found[w]), reverse=True)[: PLACES_BYTES // size]
    return {w: _near(found.pop(w), 0, len(words)) for w in often}, found


def _near(places: Sequence[int], start: int, width: int) -> int:
    """Places as bits, counted from ``start``; those outside ``width`` do not appear."""
    here = places[bisect_left(places, start) : bisect_left(places, start + width)]
    if len(here) < 2:
        return 1 << (here[0] - start) if here else 0
    bits = bytearray(width // 8 + 1)
    for at in here:
        bits[(at - start) >> 3] |= 1 << ((at - start) & 7)
    return int.from_bytes(bits, "little")


def between(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without the words that they begin and end with alike."""
    same = min(len(a), len(b))
    differ = np.flatnonzero(a[:same] != b[:same])
    head = int(differ[0]) if len(differ) else same
    a, b = a[head:], b[head:]
    same = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - same :][::-1] != b[len(b) - same :][::-1])
    tail = int(differ[0]) if len(differ) else same
    return a[: len(a) - tail], b[: len(b) - tail]


def word_edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Insertions, deletions and replacements between two sequences, or more than ``most``.

    Bit-parallel over the rows ``j - most .. j + most`` of each column ``j``: bits hold the differences of neighbouring
    cells, the distance is followed along the diagonal that ends in the last cell.
    """
    rows, columns = (x.tolist() for x in between(a, b))
    shift = len(rows) - len(columns)
    if abs(shift) > most or not rows or not columns:
        return abs(shift)
    shared = Counter(rows) & Counter(columns)
    if max(len(rows), len(columns)) - shared.total() > most:
        return most + 1
    whole, apart = _places(rows)
    mask = (1 << (2 * most + 1)) - 1
    up, down = mask & ~((1 << most) - 1), 0
    watch = 1 << (most + shift)
    distance = abs(shift)
    for j, word in enumerate(columns):
        if word in whole:
            match = whole[word]
            match = (match >> (j - most) if j >= most else match << (most - j)) & mask
        else:
            match = _near(apart.get(word, ()), j - most, 2 * most + 1)
        flat = ((((match & up) + up) ^ up) | match | down) & mask
        rise = down | (mask & ~(flat | up))
        fall = flat & up
        if not flat & watch and j >= -shift:
            distance += 1
            if distance > most + abs(shift):
                return distance
        above = flat >> 1
        up = fall | (mask & ~(above | rise))
        down = above & rise
    return distance


def grams(words: np.ndarray) -> np.ndarray:
    """One value for each ``GRAM`` words that follow each other."""
    n = max(0, len(words) - GRAM + 1)
    return functools.reduce(np.add, (words[i : i + n] * f for i, f in enumerate(_FACTORS[:GRAM])))


def bounds(a: np.ndarray, b: np.ndarray, most: int) -> tuple[int, int]:
    """Word edits between two texts are no fewer and no more; the second counts only words at most ``most`` places apart.

    An edit changes ``GRAM`` runs of words at most. Words stay where runs that each text has once lie in one order in both;
    what is between is replaced.
    """
    one, other = grams(a), grams(b)
    both = np.concatenate([one, other])
    order = np.argsort(both, kind="stable")
    both = both[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, int)
    size = np.diff(first, append=len(both))
    of_one = np.diff(np.searchsorted(np.flatnonzero(order < len(one)), np.append(first, len(both))))
    shared = int(np.minimum(of_one, size - of_one).sum())
    least = max(abs(len(a) - len(b)), -((shared - max(len(one), len(other))) // GRAM))
    once = first[(size == 2) & (of_one == 1)]
    i, j = order[once], order[once + 1] - len(one)
    near = np.abs(i - j) <= most
    at = np.full(len(a), -1)
    for step in range(GRAM):
        at[i[near] + step] = j[near] + step
    i = np.flatnonzero(at >= 0)
    i = i[a[i] == b[at[i]]]
    j = at[i]
    # Those that come after all before them and before all after them.
    ends = np.concatenate([[-1], j, [len(b)]])
    stay = (j > np.maximum.accumulate(ends)[:-2]) & (j < np.minimum.accumulate(ends[::-1])[::-1][2:])
    gaps = [np.diff(np.concatenate([[-1], x[stay], [len(t)]])) - 1 for x, t in ((i, a), (j, b))]
    return least, int(np.maximum(*gaps).sum())


_met = np.zeros(1 << 20, bool)


def strange(a: np.ndarray, b: np.ndarray) -> int:
    """How many of ``b`` are not in ``a``, values below 2^20, or fewer."""
    _met[a] = True
    here = int(np.count_nonzero(_met[b]))
    _met[a] = False
    return len(b) - here


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    a, b = between(a, b)
    if len(a) == len(b) and np.count_nonzero(a != b) <= most:
        return True
    least, enough = bounds(a, b, most)
    if least > most or enough <= most:  # most pairs are told by that
        return least <= most
    band = FIRST_BAND  # near copies are told in a narrow one, whatever their length
    while 2 * band < most:
        if word_edits(a, b, band) <= band:
            return True
        band *= 4
    return word_edits(a, b, most) <= most


def edits_at_least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A lower bound of the word edits between texts, from a row of :func:`profiles` for each.

    Words that one text has more often than the other have to be deleted or replaced. Putting words together and cutting
    counts can only make their number smaller.
    """
    most = np.maximum(a, b).sum(axis=1, dtype=np.int64)  # bytes are not widened before they are added up
    return most - np.minimum(a.sum(axis=1, dtype=np.int64), b.sum(axis=1, dtype=np.int64))


def profiles(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text how many of its words have each value modulo ``PROFILE``, 255 at most."""
    out = np.zeros((len(offsets) - 1, PROFILE), np.uint8)
    for i, (x, y) in enumerate(zip(offsets, offsets[1:], strict=False)):
        out[i] = np.minimum(np.bincount(words[x:y] % PROFILE, minlength=PROFILE), 255)
    return out


def presence(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text a row of ``PRESENT`` bits: which values its words, told apart by occurrence, have modulo ``PRESENT``."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out = np.zeros((len(offsets) - 1, PRESENT), bool)
    out[row, (occurrence_labelled(words, row) % np.uint64(PRESENT)).astype(np.int64)] = True
    return np.packbits(out, axis=1)


def _sketch(shingle: int, draws: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers.text_bytes(batch.column("text"))
            for a, b in row_groups(offsets, CHUNK):
                values, at = symbol_values(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words=True)
                own = [buffers.Rolling(v, which).ranges(at[:-1], at[1:]).view(np.int64) for which, v in enumerate(values)]
                n = np.diff(at)
                some = np.flatnonzero(n)
                drawn = np.zeros((len(n), 2 * draws), np.uint64)
                if len(some):
                    drawn[some] = sketches(values[0], np.append(at[some], at[-1]), shingle, draws)
                flat = pa.array(drawn[some].ravel().view(np.int64))
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, 2 * draws, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").slice(a, b - a), *map(pa.array, own), pa.array(n), pa.ListArray.from_arrays(pa.array(ends), flat)],
                    names=["k", "a", "b", "n", "draws"],
                )

    return run


def _as_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as 32-bit word hashes, their profiles and the words present."""
    for batch in batches:
        data, offsets = buffers.text_bytes(batch.column("text"))
        for a, b in row_groups(offsets, CHUNK):
            values, at = symbol_values(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words=True, values=1)
            short = (values[0] >> np.uint64(32)).astype(np.uint32)
            words = [short[x:y].tobytes() for x, y in zip(at, at[1:], strict=False)]
            counts = [x.tobytes() for x in profiles(short, at)]
            present = [x.tobytes() for x in presence(values[0], at)]
            columns = [batch.column("node").slice(a, b - a), *(pa.array(x, pa.binary()) for x in (words, counts, present))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "words", "profile", "present"])


PAIR = ["a", "b", "ra", "rb"]
GROUP = ["draw", "c", "i", "d", "j"]


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    """Binary values of equal length as rows of an array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _kept_pairs(batch: pa.RecordBatch, which: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(c) for c in PAIR], names=PAIR).filter(pa.array(which, pa.bool_()))


def _may_link(similarity: float):
    """Pairs whose profiles do not rule a link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (_rows(batch.column(c), np.uint8) for c in ("profile", "others"))
            longer = np.maximum(batch.column("n").to_numpy(), batch.column("m").to_numpy())
            yield _kept_pairs(batch, edits_at_least(one, other) <= np.floor((1 - similarity) * longer + 1e-9))

    return run


def _group_pairs(group: pa.RecordBatch, similarity: float, classes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of two members of different ``classes`` that may be links, and the bound of their edits; some at a time.

    The classes may be joined meanwhile.
    """
    n, right = (group.column(c).to_numpy(zero_copy_only=False) for c in ("n", "right"))
    left, other = np.flatnonzero(~right), np.flatnonzero(right)
    own = all(group.column(x)[0] == group.column(y)[0] for x, y in (("c", "d"), ("i", "j")))
    if own:
        other = left
    present, profile = _rows(group.column("present"), np.uint64), _rows(group.column("profile"), np.uint8)
    bits = np.bitwise_count(present).sum(axis=1, dtype=np.int64)
    step = max(1, PAIRS_AT_ONCE // max(1, len(other)))
    for at in range(0, len(left), step):
        x, y = left[at : at + step, None], other[None, :]
        most = np.floor((1 - similarity) * np.maximum(n[x], n[y]) + 1e-9).astype(np.int64)
        may = (classes[x] != classes[y]) & (np.abs(n[x] - n[y]) <= most)
        if own:
            may &= x < y
        p, q = np.nonzero(may)
        most = most[p, q]
        p, q = left[at + p], other[q]
        least = np.maximum(bits[p], bits[q]) - np.bitwise_count(present[p] & present[q]).sum(axis=1, dtype=np.int64)
        near = least <= most
        p, q, most = p[near], q[near], most[near]
        least = edits_at_least(profile[p], profile[q])
        near = least <= most
        yield p[near], q[near], least[near]


def _meeting(group: pa.RecordBatch, similarity: float) -> Iterator[pa.RecordBatch]:
    """Members of some pair that may be a link."""
    some = np.zeros(group.num_rows, bool)
    for p, q, _ in _group_pairs(group, similarity, group.column("root").to_numpy()):
        some[p] = some[q] = True
    if some.any():
        yield group.filter(pa.array(some))


def _group_links(group: pa.RecordBatch, similarity: float) -> Iterator[pa.RecordBatch]:
    """Links that join the group's classes as all its links would; the greater node comes first.

    Two members that meet in several buckets are compared in the first of these, in one of a few orders chosen by node: so
    the pairs of many texts that share many buckets are spread over them.
    """
    node, root = (group.column(c).to_numpy() for c in ("node", "root"))
    classes, draw = root.copy(), group.column("draw")[0].as_py()
    draws, words = (group.column(c).to_pylist() for c in ("draws", "words"))
    words = [np.frombuffer(x, np.uint32) for x in words]
    runs = functools.cache(lambda x: (grams(words[x]) >> np.uint64(44)).astype(np.uint32))
    earlier = functools.cache(lambda salt: [frozenset(d for d in x if d ^ salt < draw ^ salt) for x in draws])
    found = []
    for p, q, least in _group_pairs(group, similarity, classes):
        order = np.argsort(least, kind="stable")
        for x, y in zip(p[order].tolist(), q[order].tolist(), strict=True):
            if classes[x] == classes[y]:
                continue
            before = earlier(ORDERS[max(node[x], node[y]) % len(ORDERS)])
            if not before[x].isdisjoint(before[y]):
                continue
            one, other = (x, y) if len(words[x]) < len(words[y]) else (y, x)
            most = int((1 - similarity) * len(words[other]) + 1e-9)
            if strange(runs(one), runs(other)) <= GRAM * most and alike(words[x], words[y], similarity):
                classes[classes == classes[x]] = classes[y]
                found.append((x, y) if node[x] > node[y] else (y, x))
    if found:
        a, b = np.array(found).T
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node[a], node[b], root[a], root[b])], names=PAIR)


def _by_group(use: Callable[[pa.RecordBatch, float], Iterator[pa.RecordBatch]], similarity: float):
    """``use`` for each group of blocks; groups arrive one after the other and may be cut by batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in GROUP])
            starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
            for a, b in zip(starts, starts[1:], strict=False):
                if held and tuple(keys[:, a]) != last:
                    yield from use(_joined(held), similarity)
                    held = []
                held.append(batch.slice(a, b - a))
                last = tuple(keys[:, a])
        if held:
            yield from use(_joined(held), similarity)

    return run


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _aligned(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("words"), batch.column("others"), strict=True)
            links = [alike(np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32), similarity) for x, y in pairs]
            yield _kept_pairs(batch, np.array(links, bool))

    return run


def _with_both(pairs: DataFrame, texts: DataFrame, names: dict[str, str]) -> DataFrame:
    """Pairs with columns of both their texts, the second's under the names given."""
    # What grows with the documents is never broadcast, however small it is here: hence the hints.
    first = texts.select(F.col("node").alias("a"), *names)
    second = texts.select(F.col("node").alias("b"), *(F.col(c).alias(name) for c, name in names.items()))
    return pairs.join(first.hint("merge"), "a").join(second.hint("merge"), "b")


def _distinct_buckets(shared: DataFrame) -> DataFrame:
    """``draw, weight, node``: one draw for all that have the same members, and how many those are.

    Copies share many draws and nothing else does, so most buckets say the same. Buckets are told apart by size, least
    and largest member and 128 bits of all.
    """
    marks = [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    by_draw = shared.groupBy("draw").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("low"), F.max("node").alias("high"), *marks)
    one = by_draw.groupBy("size", "low", "high", "x", "y").agg(F.min("draw").alias("draw"), F.count(F.lit(1)).alias("weight"))
    return settled(shared.join(settled(one.select("draw", "weight")).hint("merge"), "draw").select("draw", "weight", "node"))


def _in_blocks(inside: DataFrame, similarity: float) -> DataFrame:
    """Members of draws with several classes, dealt to groups of two blocks in which every pair meets that may be a link.

    Large draws are cut by length, so that a link's texts are in one class of length or in neighbouring ones, and each class
    by salt; a member goes to the groups of its block with all others of its own and the neighbouring classes.
    """
    sizes = inside.groupBy("draw").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
    sizes = settled(sizes.where("low != high").select("draw", "size"))
    by_length = F.floor(F.log("n") / F.lit(np.log(1 / similarity) + 1e-9)) if similarity < 1 else F.col("n")
    length = F.when(F.col("size") > BLOCK, by_length).otherwise(0).cast("int")
    members = settled(inside.join(sizes.hint("merge"), "draw").select("draw", "node", "n", "root", length.alias("c")))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_WORDS)).cast("int")
    cells = members.groupBy("draw", "c").agg(blocks.alias("blocks"))
    along = Window.partitionBy("draw").orderBy("c")
    beside = lambda other, at: F.when(other("c").over(along) == F.col("c") + at, other("blocks").over(along)).otherwise(0)
    cells = settled(cells.select("draw", "c", "blocks", beside(F.lead, 1).alias("above"), beside(F.lag, -1).alias("below")))
    placed = members.join(cells.hint("merge"), ["draw", "c"]).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    c, own = F.col("c"), F.col("own")

    def groups(blocks: str, group: Callable[[Column], tuple]) -> Column:
        some = F.when(F.col(blocks) > 0, F.sequence(F.lit(0), F.col(blocks) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(some, lambda at: F.struct(*(x.alias(name) for x, name in zip(group(at), [*GROUP[1:], "right"], strict=True))))

    all_groups = F.concat(
        groups("blocks", lambda at: (c, F.least(own, at), c, F.greatest(own, at), own > at)),
        groups("above", lambda at: (c, own, c + 1, at, F.lit(False))),
        groups("below", lambda at: (c - 1, at, c, own, F.lit(True))),
    )
    return placed.select("draw", "node", "n", "root", F.explode(all_groups).alias("group")).select("draw", "group.*", "node", "n", "root")


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, draws: int = SKETCHES
) -> tuple[DataFrame, DataFrame]:
    """Classes of near-duplicates, and the links found.

    The first frame has a row per document: ``doc_id, k`` (:func:`~docledger.llm.store.row_key`), ``class_id, class_hash`` and
    ``kept``, true for the one text of the class that stays. The second has the verified links between nodes (id, hash).
    """
    spark = docs.sparkSession
    keyed = docs.select(row_key().alias("k"), "text")
    key_type = keyed.schema["k"].dataType.simpleString()
    rows = settled(map_arrow(keyed, _sketch(shingle, draws), f"k {key_type}, a long, b long, n long, draws array<long>"))
    nodes = rows.where("n > 0").groupBy("a", "b").agg(F.min("k").alias("k"), F.first("n").alias("n"), F.first("draws").alias("draws"))
    drawn = settled(nodes.withColumn("node", F.monotonically_increasing_id()))  # numbers, fixed by being written
    # Draws are most of what is written here, so they go as soon as the buckets are known.
    nodes, drawing = settled(drawn.drop("draws")), rows
    rows = settled(rows.drop("draws"))
    spent(drawing)
    by_draw = drawn.select("node", F.explode("draws").alias("draw"))
    # Small sides of joins on hot keys are settled first: then Spark can split the large side's partitions.
    several = settled(by_draw.groupBy("draw").count().where("count > 1").select("draw"))
    met = settled(by_draw.join(several.hint("merge"), "draw", "left_semi"))
    spent(several, drawn)
    shared = _distinct_buckets(met)
    spent(met)
    members = shared.select("node").distinct()
    texts = keyed.join(nodes.join(members, "node").select("k", "node").hint("merge"), "k").select("node", "text")
    # Dealt by node once: the rounds' joins find it in place.
    words = write_once(map_arrow(texts, _as_words, "node long, words binary, profile binary, present binary").dropDuplicates(["node"]))
    counts = write_once(words.select("node", F.expr("length(words) div 4").alias("n"), "profile", "present"))
    types = ", ".join(f"{x} long" for x in PAIR)
    roots = settled(nodes.join(members, "node").select("node", "n", F.col("node").alias("root")))
    found: list[DataFrame] = []

    def join_classes(new: DataFrame) -> None:
        """Keep the links and join their classes."""
        nonlocal roots
        found.append(new.select("a", "b"))
        if not new.isEmpty():
            # Only classes that were linked in this round are joined, so their graph is small.
            joined = components(new.select(F.col("ra").alias("a"), F.col("rb").alias("b"))).select(F.col("node").alias("root"), F.col("root").alias("to"))
            before, roots = roots, settled(roots.join(joined, "root", "left").select("node", "n", F.coalesce("to", "root").alias("root")))
            spent(before)

    inside = shared.join(roots, "node")
    chosen = inside.groupBy("draw").agg(F.first("weight").alias("weight"), F.min(F.struct("node", "n", "root")).alias("chosen"), F.min("root").alias("low"), F.max("root").alias("high"))
    chosen = settled(chosen.where("low != high").select("draw", "weight", "chosen"))
    pairs = inside.drop("weight").join(chosen, "draw").where(F.col("root") != F.col("chosen.root"))
    longer = F.greatest("n", "chosen.n")
    pairs = pairs.where(F.abs(F.col("n") - F.col("chosen.n")) <= F.floor(F.lit(1 - similarity) * longer + F.lit(1e-9)))
    pairs = pairs.select(F.col("node").alias("a"), F.col("chosen.node").alias("b"), F.col("root").alias("ra"), F.col("chosen.root").alias("rb"), "weight")
    pairs = pairs.groupBy(*PAIR).agg(F.sum("weight").alias("count"))
    best = Window.partitionBy("a").orderBy(F.desc("count"), F.xxhash64("b"), "b")  # the most promising
    pairs = pairs.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= FIRST_CANDIDATES)
    near = settled(map_arrow(_with_both(pairs.select(*PAIR), counts.drop("present"), {"n": "m", "profile": "others"}), _may_link(similarity), types))
    join_classes(settled(map_arrow(_with_both(near, words.select("node", "words"), {"words": "others"}), _aligned(similarity), types)))
    spent(chosen, near)
    dealt = lambda groups: groups.repartition(*GROUP).sortWithinPartitions(*GROUP)
    groups = _in_blocks(shared.join(roots, "node"), similarity).join(counts.select("node", "profile", "present").hint("merge"), "node")
    groups = dealt(groups.select(*GROUP, "right", "node", "n", "root", "profile", "present"))
    meeting = settled(map_arrow(groups, _by_group(_meeting, similarity), groups.schema))
    if not meeting.isEmpty():
        draws = meeting.groupBy("node").agg(F.collect_set("draw").alias("draws"))
        met = meeting.join(draws.hint("merge"), "node").join(words.select("node", "words").hint("merge"), "node")
        join_classes(settled(map_arrow(dealt(met), _by_group(_group_links, similarity), types)))
    links = functools.reduce(DataFrame.unionByName, found)
    spent(shared, meeting)
    several = roots.where("root != node").select("root").distinct()
    named = nodes.select("node", "a", "b", "k").join(roots.join(several, "root", "left_semi").select("node", "root"), "node")
    leaders = named.groupBy("root").agg(F.min(F.struct(F.col("k.doc_id").alias("id"), "a", "b", "k")).alias("leader"))
    named = named.join(settled(leaders).hint("merge"), "root").select("node", "leader")
    classes = nodes.select("a", "b", "node", F.col("k").alias("first")).join(named, "node", "left")
    classes = classes.select("a", "b", "first", F.coalesce("leader", F.struct(F.col("first.doc_id").alias("id"), "a", "b", F.col("first").alias("k"))).alias("leader"))
    found = rows.where("n > 0").join(classes, ["a", "b"])
    kept = (F.col("k") == F.col("first")) & (F.col("first") == F.col("leader.k"))
    found = found.select("k", F.col("leader.id").alias("class_id"), F.col("leader.a").alias("class_hash"), kept.alias("kept"))
    ends = nodes.select("node", F.struct(F.col("k.doc_id").alias("id"), F.col("a").alias("hash")).alias("text")).hint("merge")
    links = links.join(ends.toDF("a", "one"), "a").join(ends.toDF("b", "other"), "b").select(F.col("one").alias("a"), F.col("other").alias("b"))
    alone = rows.where("n = 0").select("k", F.col("k.doc_id").alias("class_id"), F.col("k.h").alias("class_hash"), F.lit(True).alias("kept"))
    return found.unionByName(alone).select(F.col("k.doc_id").alias("doc_id"), "k", "class_id", "class_hash", "kept"), links


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, without those of which another text of their class, or the same row, stays."""
    key = fresh(docs, "near_key")
    classes, _ = near_duplicates(docs, similarity)
    staying = settled(classes.where("kept").select(F.col("k").alias(key)).distinct())
    return docs.withColumn(key, row_key()).join(staying, key, "left_semi").dropDuplicates([key]).drop(key)
