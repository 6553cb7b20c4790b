"""Nearest neighbours by inner product with a forest of sorted hash strings.

Each tree gives every vector a string of ``BITS`` signs of random projections and keeps the strings sorted. A query descends
each tree to the longest prefix that it shares with any string there; then all trees ascend together, one bit at a time,
until the vectors below the reached nodes are ``CANDIDATES`` (with repeats between trees) or the root is reached. The
candidates are compared by their exact inner products in double precision.

Inner products become angles by one more coordinate, sqrt(M**2 - |x|**2) with the largest norm M (0 for queries). The index is dealt
in shards of about ``SHARD_ROWS`` vectors, each a forest of its own in one task that answers a block of queries, so every
vector is indexed, no task holds more than a shard and a block, and results are merged by query with a window whose
partial limit cuts each task's list to ``k``. Recall was measured against brute force (see README).

Equal vectors are one entry of the index, with the ``k + 1`` smallest of their ids, which are all that a query can return.

Defined cases. Vectors that are null, all zero, or hold null or non-finite numbers take no part, neither as queries nor as
candidates, nor do rows without an id. Repeated rows count once, as queries and as candidates. Of rows with one
id and different vectors each is a candidate and, if the id asks, a query with ranks of its own; a query's own id is never
returned to it. Equal scores go to the smaller id. Vectors whose length differs from the most common one's take no part.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.llm.store import settled, ship

TREES, BITS, CANDIDATES = 48, 32, 5000
SHARD_ROWS, QUERY_ROWS = 8192, 2048
NEIGHBOURS = 20


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: the vectors that take part, as doubles."""
    v = F.col("v")
    whole = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull())
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return whole.where(F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


class Forest:
    """Sorted strings of one shard."""

    def __init__(self, points: np.ndarray, top: float, trees: int, bits: int, seed: int):
        extra = np.sqrt(np.maximum(top**2 - (points**2).sum(axis=1), 0))
        self.planes = np.random.default_rng(seed).normal(size=(trees, points.shape[1] + 1, bits))
        self.bits = bits
        self.order, self.strings = [], []
        for planes in self.planes:
            strings = self._strings(np.column_stack([points, extra]), planes)
            order = np.argsort(strings, kind="stable")
            self.order.append(order)
            self.strings.append(strings[order])

    def _strings(self, points: np.ndarray, planes: np.ndarray) -> np.ndarray:
        return (points @ planes > 0) @ (1 << np.arange(self.bits, dtype=np.int64)[::-1])

    def candidates(self, queries: np.ndarray, least: int) -> list[np.ndarray]:
        """For each query the numbers of the points that a synchronous ascent to ``least`` entries reaches."""
        extended = np.column_stack([queries, np.zeros(len(queries))])
        strings = [self._strings(extended, planes) for planes in self.planes]
        lo = np.zeros((len(queries), len(strings)), np.int64)
        hi = np.zeros_like(lo)
        open_ = np.arange(len(queries))
        for cut in range(self.bits + 1):  # bits given up
            for t, (own, held) in enumerate(zip(strings, self.strings, strict=True)):
                prefix = own[open_] >> cut << cut
                lo[open_, t] = np.searchsorted(held, prefix)
                hi[open_, t] = np.searchsorted(held, prefix + (1 << cut))
            open_ = open_[(hi[open_] - lo[open_]).sum(axis=1) < least]
            if not len(open_):
                break
        return [np.unique(np.concatenate([o[a:b] for o, a, b in zip(self.order, lo[q], hi[q], strict=True)])) for q in range(len(queries))]


def _search(k: int, trees: int, bits: int, least: int, seed: int):
    types = {"query_id": np.int64, "qa": np.int64, "qb": np.int64, "vec_id": np.int64, "score": float}

    def run(key, queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(index):
            return pd.DataFrame({c: np.zeros(0, t) for c, t in types.items()})
        points, asked = np.stack(index["v"].to_numpy()), np.stack(queries["v"].to_numpy())
        forest = Forest(points, float(index["top"].iloc[0]), trees, bits, seed)
        lists, out = index["ids"].to_list(), []
        keys = zip(*(queries[c].to_list() for c in ("vec_id", "qa", "qb")), strict=True)
        for (own, qa, qb), query, near in zip(keys, asked, forest.candidates(asked, least), strict=True):
            scores = points[near] @ query
            first = near[np.argsort(-scores, kind="stable")[: k + 1]] if len(near) > k + 1 else near
            worst = (points[first] @ query).min()
            # Entries as near as the last one stay, so that ties are settled by id.
            tied = np.flatnonzero(scores >= worst)
            found = [(i, float(scores[t])) for t in tied for i in lists[near[t]] if i != own]
            out += [(own, qa, qb, i, s) for i, s in sorted(found, key=lambda x: (-x[1], x[0]))[:k]]
        return pd.DataFrame(out, columns=list(types)).astype(types)

    return run


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = NEIGHBOURS,
    trees: int = TREES,
    bits: int = BITS,
    candidates: int = CANDIDATES,
    shard_rows: int = SHARD_ROWS,
    seed: int = 0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of the rows of ``vectors`` for which ``is_query`` holds."""
    ship(vectors.sparkSession)
    points = usable(vectors)
    lengths = points.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = lengths["n"] if lengths else 0
    points = settled(points.where(F.size("v") == width))
    content = F.struct(F.xxhash64("v").alias("a"), F.xxhash64("v", F.lit(1)).alias("b"))
    first = Window.partitionBy("content").orderBy("vec_id")
    ids = points.select(content.alias("content"), "vec_id", "v").dropDuplicates(["content", "vec_id"]).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    entries = settled(ids.groupBy("content").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top")).first()
    asked = settled(points.where(is_query).withColumn("content", content).dropDuplicates(["vec_id", "content"]))
    shards = max(1, -(-size["n"] // shard_rows))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "content"), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))
    index = entries.withColumn("shard", F.pmod(F.col("content.a"), F.lit(shards)).cast("int")).withColumn("block", every(blocks))
    index = index.select("shard", "block", "v", "ids", F.lit(size["top"] or 0.0).alias("top"))
    found = (
        queries.select("shard", "block", "vec_id", F.col("content.a").alias("qa"), F.col("content.b").alias("qb"), "v")
        .groupBy("shard", "block")
        .cogroup(index.groupBy("shard", "block"))
        .applyInPandas(_search(k, trees, bits, candidates, seed), "query_id long, qa long, qb long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id", "qa", "qb").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
