"""Toxicity by a convolutional text classifier with hashed word embeddings.

A word's vector is the sum of learned vectors for the hashes of the word and of three of its prefixes, so words that were
never labelled share what their stems have taught. Filters of one to three words slide over the whole text, each keeps
its maximum, and a logistic layer weighs these. Every labelled document that is not held out takes part: four fifths are
dealt by a hash of their id to shards of about ``SHARD_BYTES``, each round trains a copy of the network on every shard, and
Spark adds up what the copies changed, as integers, so that the order of tasks does not matter. The other fifth is kept
back: scores are calibrated and a threshold is chosen for each language on counts by score of all its documents.

Only the text enters a score. The model (about 4 MB, of fixed size) is broadcast; texts are scored where they are read,
in blocks, so memory does not depend on their length.

Defined cases. Null and empty texts: no words, they get the score that the network gives to no words. Unlabelled rows,
null labels: not used; of repeated labels the highest counts; of repeated ids each row is scored,
and the smallest text is learned. A language that is null,
or has too few labelled rows: the threshold of all languages. Labels of one kind only, or none: every score is the share
of toxic labels (0 without any). Other columns are not read.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.llm import buffers
from docledger.llm.repeats import row_groups
from docledger.llm.store import map_arrow, settled, ship, spent

SHARD_BYTES, ROW_BYTES = 8 << 20, 1 << 10  # a row counts as its text and ROW_BYTES
EXACT = 1 << 24  # changes of parameters are added up in units of 1 / EXACT
BINS = 64  # bins of scores to a unit of the logit
PREFIXES = (4, 5, 6)
TABLE, DIM, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
UPDATES, LEAST_EPOCHS, MOST_EPOCHS, BATCH, RATE = 900, 6, 30, 32, 0.08
LEAST_LABELS = 10
BLOCK = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_APART = np.zeros(256, bool)
_APART[:128] = [not chr(c).isalnum() for c in range(128)]
_SALTS = buffers.mixed(np.arange(1, len(PREFIXES) + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters in UTF-8."""
    out = _LOWER[data]
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    out[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    return out


@dataclass
class Words:
    """Feature numbers of the words of many texts; each text is followed by rows of zeros, the number of no word."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray) -> Words:
    data = lowered(data)
    starts, ends, at = buffers.word_spans(data, offsets, _APART)
    # A text without words still has one place, and each place the rows that its widest filter needs.
    places = np.maximum(np.diff(at), 1) + max(WIDTHS) - 1
    first = np.cumsum(places) - places
    ids = np.zeros((int(places.sum()), len(PREFIXES) + 1), np.int32)
    row = np.arange(len(starts)) + np.repeat(first - at[:-1], np.diff(at))
    step = 1 << 17
    for a in range(0, len(starts), step):
        s, e = starts[a : a + step], ends[a : a + step]
        lo, hi = s[0], e[-1]
        rolling = buffers.Rolling(buffers.BYTE_VALUES[0][data[lo:hi]])
        for i, stop in enumerate([e, *(np.minimum(e, s + n) for n in PREFIXES)]):
            ids[row[a : a + step], i] = buffers.mixed(rolling.ranges(s - lo, stop - lo) ^ _SALTS[i]) % np.uint64(TABLE - 1) + np.uint64(1)
    return Words(ids, first, first + np.maximum(np.diff(at), 1))


def features_in_groups(data: np.ndarray, offsets: np.ndarray) -> Words:
    """:func:`features`, some rows after the others, so that its scratch arrays stay small."""
    groups, first = [features(np.zeros(0, np.uint8), np.zeros(1, np.int64))], 0
    for a, b in row_groups(offsets, 1 << 19):
        own = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        groups.append(Words(own.ids, own.starts + first, own.ends + first))
        first += len(own.ids)
    return Words(*(np.concatenate([getattr(g, n) for g in groups]) for n in ("ids", "starts", "ends")))


@dataclass
class Network:
    words: np.ndarray
    filters: dict[int, np.ndarray]  # by width: (width, DIM, FILTERS)
    shift: dict[int, np.ndarray]
    weights: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5
    thresholds: dict[str, float] = field(default_factory=dict)

    def _responses(self, ids: np.ndarray, width: int, vectors: np.ndarray) -> np.ndarray:
        n = len(ids) - max(WIDTHS) + 1
        out = vectors[:n] @ self.filters[width][0]
        for j in range(1, width):
            out += vectors[j : j + n] @ self.filters[width][j]
        return out

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        out = self.words[ids[:, 0]]
        for i in range(1, ids.shape[1]):
            out += self.words[ids[:, i]]
        return out

    def pooled(self, words: Words) -> np.ndarray:
        """Maximum response of each filter in each text, a block of positions after the other."""
        texts = len(words.starts)
        best = np.full((texts, FILTERS * len(WIDTHS)), -np.inf, np.float32)
        gap, last = max(WIDTHS) - 1, int(words.ends[-1]) if texts else 0
        for a in range(0, last, BLOCK):
            b = min(a + BLOCK, last)
            ids = words.ids[a : b + gap]
            vectors = self.vectors(ids)
            here = np.arange(np.searchsorted(words.ends, a, side="right"), np.searchsorted(words.starts, b))
            cuts = np.empty((len(here), 2), np.int64)
            cuts[:, 0], cuts[:, 1] = np.maximum(words.starts[here] - a, 0), np.minimum(words.ends[here], b) - a
            for k, width in enumerate(WIDTHS):
                out = self._responses(ids, width, vectors)
                out = np.vstack([out, out[-1:]])  # a cut may lie at the end
                top = np.maximum.reduceat(out, cuts.ravel(), axis=0)[::2]
                part = best[here, k * FILTERS : (k + 1) * FILTERS]
                best[here, k * FILTERS : (k + 1) * FILTERS] = np.maximum(part, top + self.shift[width])
        return np.maximum(best, 0)

    def logits(self, words: Words) -> np.ndarray:
        return self.pooled(words) @ self.weights + self.bias

    def scores(self, words: Words) -> np.ndarray:
        a, b = self.scale
        return sigmoid(a * self.logits(words).astype(np.float64) + b)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def constant(share: float) -> Network:
    """Without two kinds of labels there is nothing to learn: one score for all."""
    share = min(max(share, 0.0), 1.0)
    logit = -40.0 if share == 0 else 40.0 if share == 1 else float(np.log(share / (1 - share)))
    net = untrained(0)
    net.weights[:] = 0
    net.bias = logit
    return net


def untrained(seed: int) -> Network:
    draw = np.random.default_rng(seed)
    words = draw.normal(0, 0.1, (TABLE, DIM)).astype(np.float32)
    words[0] = 0
    return Network(
        words,
        {w: draw.normal(0, (w * DIM) ** -0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS},
        {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
        draw.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
        -2.0,
    )


class _Adagrad:
    def __init__(self, rate: float):
        self.rate, self.sums = rate, {}

    def total(self, name, value: np.ndarray) -> np.ndarray:
        return self.sums.setdefault(name, np.full(value.shape, 1e-6, np.float32))

    def step(self, name, value: np.ndarray, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        total = self.total(name, value)
        total[rows] += gradient * gradient
        value[rows] -= self.rate * gradient / np.sqrt(total[rows])


def fit(net: Network, rule: _Adagrad, words: Words, toxic: np.ndarray, epochs: int, draw: np.random.Generator) -> None:
    """Train ``net`` by Adagrad on the logistic loss; a maximum passes its gradient to the words it came from."""
    batches = max(1, len(toxic) // BATCH)
    for _ in range(epochs if len(toxic) else 0):
        order = draw.permutation(len(toxic))
        for part in np.array_split(order, batches):
            _update(net, rule, words, part, toxic[part])


def _rows(net: Network, rule: _Adagrad) -> np.ndarray:
    """All parameters but the word vectors, and the sums of their squared gradients, ``DIM`` to a row."""
    dense = [("weights", net.weights), *((("filters", w), net.filters[w]) for w in WIDTHS), *((("shift", w), net.shift[w]) for w in WIDTHS)]
    values = np.concatenate([*(v.ravel() for _, v in dense), [net.bias]])
    sums = np.concatenate([*(rule.total(name, v).ravel() for name, v in dense), [0]])
    padded = np.zeros((2, -(-len(values) // DIM) * DIM))
    padded[0, : len(values)], padded[1, : len(values)] = values, sums
    return np.hstack([padded[0].reshape(-1, DIM), padded[1].reshape(-1, DIM)])


def _set_rows(net: Network, rule: _Adagrad, rows: np.ndarray) -> None:
    values, sums = rows[:, :DIM].ravel(), rows[:, DIM:].ravel()
    dense = [("weights", net.weights), *((("filters", w), net.filters[w]) for w in WIDTHS), *((("shift", w), net.shift[w]) for w in WIDTHS)]
    at = 0
    for name, value in dense:
        value[...] = values[at : at + value.size].reshape(value.shape)
        rule.total(name, value)[...] = sums[at : at + value.size].reshape(value.shape)
        at += value.size
    net.bias = float(values[at])


def _update(net: Network, rule: _Adagrad, words: Words, part: np.ndarray, toxic: np.ndarray) -> None:
    gap = max(WIDTHS) - 1
    spans = [np.arange(words.starts[i], words.ends[i] + gap) for i in part]
    ids = words.ids[np.concatenate(spans)]
    at = np.cumsum([0, *map(len, spans)])
    vectors = net.vectors(ids)
    pooled = np.empty((len(part), FILTERS * len(WIDTHS)), np.float32)
    where = np.empty(pooled.shape, np.int64)
    for k, width in enumerate(WIDTHS):
        out = net._responses(ids, width, vectors)
        columns = slice(k * FILTERS, (k + 1) * FILTERS)
        for i in range(len(part)):
            own = out[at[i] : at[i + 1] - gap]
            top = own.argmax(axis=0)
            where[i, columns] = at[i] + top
            pooled[i, columns] = own[top, np.arange(FILTERS)] + net.shift[width]
    pooled = np.maximum(pooled, 0)
    error = ((sigmoid(pooled @ net.weights + net.bias) - toxic) / len(part)).astype(np.float32)
    down = error[:, None] * net.weights * (pooled > 0)
    rule.step("weights", net.weights, pooled.T @ error + 1e-4 * net.weights)
    net.bias -= float(RATE * error.sum())
    rows, gradients = [], []
    for k, width in enumerate(WIDTHS):
        columns = slice(k * FILTERS, (k + 1) * FILTERS)
        d, t = down[:, columns], where[:, columns]
        change = np.empty_like(net.filters[width])
        for j in range(width):
            change[j] = np.einsum("bf,bfd->df", d, vectors[t + j])
            to_words = (d[:, :, None] * net.filters[width][j].T).reshape(-1, DIM)
            for i in range(ids.shape[1]):
                rows.append(ids[t + j, i].ravel())
                gradients.append(to_words)
        rule.step(("filters", width), net.filters[width], change)
        rule.step(("shift", width), net.shift[width], d.sum(axis=0))
    rows, gradients = np.concatenate(rows), np.concatenate(gradients)
    used = (rows > 0) & gradients.any(axis=1)
    if used.any():
        rows, gradients = rows[used], gradients[used]
        order = np.argsort(rows, kind="stable")
        own, first = np.unique(rows[order], return_index=True)
        rule.step("words", net.words, np.add.reduceat(gradients[order], first, axis=0), own)


def calibrate(net: Network, logits: np.ndarray, toxic: np.ndarray, counts: np.ndarray) -> None:
    """Logistic scaling of the scores, then the threshold with the best F1 for all texts."""
    a, b = 1.0, 0.0
    for _ in range(200):
        error = counts * (sigmoid(a * logits + b) - toxic)
        slope = counts * np.maximum(sigmoid(a * logits + b) * (1 - sigmoid(a * logits + b)), 1e-6)
        a -= 0.5 * float((error * logits).sum() + 0.1 * (a - 1)) / float((slope * logits * logits).sum() + 0.1)
        b -= 0.5 * float(error.sum() + 0.1 * b) / float(slope.sum() + 0.1)
        a = min(max(a, 0.1), 5.0)
    net.scale = (a, b)
    net.threshold = best_threshold(sigmoid(a * logits + b), toxic, counts, 0.5)


def best_threshold(scores: np.ndarray, toxic: np.ndarray, counts: np.ndarray, otherwise: float) -> float:
    """The middle of the gap below the lowest score that the best cut accepts."""
    levels, at = np.unique(-scores, return_inverse=True)
    hits = np.cumsum(np.bincount(at, counts * toxic, len(levels)))
    if not len(hits) or hits[-1] == 0:
        return otherwise
    value = 2 * hits / (np.cumsum(np.bincount(at, counts, len(levels))) + hits[-1])
    cut = int(value.argmax())
    low = -levels[cut + 1] if cut + 1 < len(levels) else 0.0
    return float((-levels[cut] + low) / 2)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _packed(rows: pa.Table) -> pa.Table:
    """All rows of a shard as one: texts, offsets, labels, marks of the kept back, languages."""
    rows = rows.sort_by([("draw", "ascending"), ("doc_id", "ascending")]).combine_chunks()
    data, offsets = buffers.text_bytes(rows.column("text").combine_chunks())
    back, toxic = (np.array(rows.column(c).to_pylist(), np.uint8) for c in ("back", "toxic"))
    langs = json.dumps(rows.column("lang").to_pylist()).encode()
    cells = [np.ascontiguousarray(data).tobytes(), np.asarray(offsets, np.int64).tobytes(), toxic.tobytes(), back.tobytes(), langs]
    return pa.table([rows.column("shard").slice(0, 1), *(pa.array([x], pa.binary()) for x in cells)], _SHARD.names)


_SHARD = pa.schema([("shard", pa.int64()), *((n, pa.binary()) for n in ("data", "offsets", "toxic", "back", "langs"))])
_CHANGES = [f"c{i}" for i in range(2 * DIM)]


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]]:
    for row in range(batch.num_rows):
        shard, data, offsets, toxic, back, langs = (batch.column(n)[row].as_py() for n in _SHARD.names)
        kinds = zip((data, offsets, toxic, back), (np.uint8, np.int64, np.uint8, np.uint8), strict=True)
        yield shard, *(np.frombuffer(x, t) for x, t in kinds), json.loads(langs)


def _round(shards: DataFrame, net: Network, rule: _Adagrad, epochs: int, seed: tuple[int, int]) -> None:
    """Train a copy on every shard; each parameter then moves by the mean change of the copies that moved it."""
    state = shards.sparkSession.sparkContext.broadcast((net, rule))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data, offsets, toxic, back, _ in _unpacked(batch):
                own, own_rule = copy.deepcopy(state.value)
                words, learn = features_in_groups(data, offsets), back == 0
                draw = np.random.default_rng((*seed, shard))
                fit(own, own_rule, Words(words.ids, words.starts[learn], words.ends[learn]), toxic[learn].astype(np.float32), epochs, draw)
                was, was_rule = state.value
                sums, old = own_rule.total("words", own.words), was_rule.total("words", was.words)
                change = np.hstack([own.words - was.words, sums - old])
                moved = np.flatnonzero(change.any(axis=1))
                dense = _rows(own, own_rule) - _rows(was, was_rule)
                exact = np.rint(np.vstack([change[moved], dense]).astype(np.float64) * EXACT).astype(np.int64)
                numbers = np.concatenate([moved, TABLE + np.arange(len(dense))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(numbers), *(pa.array(c) for c in exact.T)], names=["row", *_CHANGES])

    rule.total("words", net.words)
    changes = map_arrow(shards.select(*_SHARD.names), run, ", ".join(["row int", *(f"{c} long" for c in _CHANGES)]))
    mean = [(F.sum(c) / F.count(F.lit(1)) / EXACT).cast("float").alias(c) for c in _CHANGES]
    moved = settled(changes.groupBy("row").agg(*mean))
    found = moved.toArrow()
    spent(moved)
    state.destroy()
    at = found.column("row").to_numpy()
    moves = np.stack([found.column(c).to_numpy() for c in _CHANGES], axis=1)
    of_words = at < TABLE
    net.words[at[of_words]] += moves[of_words, :DIM]
    rule.sums["words"][at[of_words]] += moves[of_words, DIM:]
    dense = _rows(net, rule)
    dense[at[~of_words] - TABLE] += moves[~of_words]
    _set_rows(net, rule, dense)


def _binned(shards: DataFrame, net: Network, back: bool) -> DataFrame:
    """How many documents have a language, a label and a score, in bins; of those kept back or of all."""
    model = shards.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets, toxic, kept, langs in _unpacked(batch):
                logits = [np.zeros(0)]
                for a, b in row_groups(offsets, 1 << 19):
                    logits.append(model.value.logits(features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])))
                bins = np.rint(np.clip(np.concatenate(logits).astype(np.float64), -40, 40) * BINS).astype(np.int32)
                judged = np.flatnonzero(kept == 1) if back else np.arange(len(kept))
                cells = [pa.array([langs[i] for i in judged], pa.string()), pa.array(toxic[judged].astype(np.int32)), pa.array(bins[judged])]
                yield pa.RecordBatch.from_arrays(cells, names=["lang", "toxic", "bin"])

    found = map_arrow(shards.select(*_SHARD.names), run, "lang string, toxic int, bin int")
    return settled(found.groupBy("lang", "toxic", "bin").agg(F.count(F.lit(1)).alias("n")))


def _histogram(binned: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = binned.orderBy("bin", "toxic").toArrow()
    logits, toxic, n = (found.column(c).to_numpy().astype(np.float64) for c in ("bin", "toxic", "n"))
    return logits / BINS, toxic, n


def train(docs: DataFrame, labels: DataFrame, seed: int = 0) -> Network:
    """The calibrated network of all labelled documents that are not held out."""
    by_id = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = docs.select("doc_id", "text", "lang").join(by_id.where(~held_out()), "doc_id")
    smallest = labelled.groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("doc"))
    draw, back = F.xxhash64(F.lit(seed), "doc_id"), F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(5)) == 4
    texts = settled(smallest.select("doc_id", "doc.*", (F.col("toxic") > 0).cast("int").alias("toxic"), draw.alias("draw"), back.cast("int").alias("back")))
    sizes = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("size")
    counts = {(r["toxic"], r["back"]): (r["n"], r["size"]) for r in texts.groupBy("toxic", "back").agg(F.count(F.lit(1)).alias("n"), sizes).collect()}
    number = lambda kind, *marks: sum(counts.get((kind, b), (0, 0))[0] for b in marks)
    harmless, toxic = number(0, 0, 1), number(1, 0, 1)
    if not harmless or not toxic:
        spent(texts)
        return constant(1.0 if toxic else 0.0)
    parts = -(-sum(size for _, size in counts.values()) // SHARD_BYTES)
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 2), "doc_id"), F.lit(parts))).repartition(parts, "shard")
    ship(docs.sparkSession)
    shards = settled(dealt.groupBy("shard").applyInArrow(_packed, "shard long, data binary, offsets binary, toxic binary, back binary, langs binary"))
    spent(texts)
    net, rule = untrained(seed), _Adagrad(RATE)
    batches = max(1, (number(0, 0) + number(1, 0)) // BATCH)
    epochs = min(max(UPDATES // batches, LEAST_EPOCHS), MOST_EPOCHS)
    rounds = 1 if parts == 1 else LEAST_EPOCHS
    for i in range(rounds):
        _round(shards, net, rule, epochs * (i + 1) // rounds - epochs * i // rounds, (seed, i))
    binned = _binned(shards, net, back=number(0, 1) > 0 and number(1, 1) > 0)
    calibrate(net, *_histogram(binned.groupBy("toxic", "bin").agg(F.sum("n").alias("n"))))
    kinds = binned.where(F.col("lang").isNotNull()).groupBy("lang").agg(*[F.sum(F.when(F.col("toxic") == k, F.col("n"))).alias(f"n{k}") for k in (0, 1)])
    for lang in [r["lang"] for r in kinds.where(F.least(*(F.coalesce(f"n{k}", F.lit(0)) for k in (0, 1))) >= LEAST_LABELS).orderBy("lang").collect()]:
        logits, labels_, n = _histogram(binned.where(F.col("lang") == lang))
        net.thresholds[lang] = best_threshold(sigmoid(net.scale[0] * logits + net.scale[1]), labels_, n, net.threshold)
    spent(shards, binned)
    return net


def _judged(net: Network, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Scores and the thresholds of the rows' languages."""
    data, offsets = buffers.text_bytes(batch.column("text"))
    scores = [np.zeros(0)]
    for a, b in row_groups(offsets, 1 << 19):
        scores.append(net.scores(features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])))
    return np.concatenate(scores), np.array([net.thresholds.get(x, net.threshold) for x in batch.column("lang").to_pylist()])


def score(docs: DataFrame, net: Network) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, lang and others) with ``score``, ``threshold`` and ``toxic``.

    Columns of ``docs`` with these names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, least = _judged(model.value, batch)
            new = {"score": pa.array(scores), "threshold": pa.array(least), "toxic": pa.array(scores >= least)}
            yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=[*batch.schema.names, *new])

    docs = docs.drop("score", "threshold", "toxic")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return map_arrow(docs, run, ", ".join([*fields, "score double", "threshold double", "toxic boolean"]))


def drop_toxic(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold of their language."""
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, least = _judged(model.value, batch)
            yield batch.filter(pa.array(scores < least))

    return map_arrow(docs, run, docs.schema)
