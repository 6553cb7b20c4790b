import numpy as np
import pytest
from pyspark.sql import functions as F

from docledger.llm import prefix_forest


@pytest.fixture
def search(spark):
    def run(rows, **parameters):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, v string") if rows else spark.createDataFrame([], "vec_id long, embedding array<float>, rank string, v string")
        found = {}
        for r in prefix_forest.nearest(table, F.col("vec_id") % 20 == 0, **parameters).orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        return found

    return run


def rows_of(points, ids=None):
    return [(int(i), [float(x) for x in p], "", "") for i, p in zip(ids if ids is not None else range(len(points)), points)]


def exact(rows, query, k):
    own = next(np.array(v) for i, v, *_ in rows if i == query)
    return sorted(((-float(np.dot(np.array(v), own)), i) for i, v, *_ in rows if i != query))[:k]


def test_recall_against_brute_force(search):
    draw = np.random.default_rng(1)
    rows = rows_of((draw.normal(size=(3000, 32)) * draw.uniform(0.5, 2, size=(3000, 1))).astype(np.float32))
    found = search(rows, shard_rows=1000, candidates=5000)
    hits = 0
    for query, near in found.items():
        assert [n for n, _, _ in near] == list(range(1, 21))
        true = {i: -s for s, i in exact(rows, query, 20)}
        hits += sum(i in true for _, i, _ in near)
        assert all(abs(s - true[i]) < 1e-9 for _, i, s in near if i in true)
    assert len(found) == 150 and hits / 3000 >= 0.9


def test_ties_and_equal_vectors(search):
    """Equal vectors: the smallest ids, without the query's own."""
    rows = rows_of([[1, 0]] * 50 + [[0, 1]] * 5, ids=[*range(49, -1, -1), *range(60, 65)])
    found = search(rows, k=20)
    assert [i for _, i, _ in found[0]] == list(range(1, 21))
    assert [i for _, i, _ in found[20]] == list(range(20))
    assert [i for _, i, _ in found[60]][:4] == [61, 62, 63, 64]


def test_odd_vectors(search):
    nan, inf = float("nan"), float("inf")
    rows = rows_of([[1, 2], [2, 1], [-1, 0]], ids=[20, 1, 2])
    rows += [(40, None, "", ""), (60, [0.0, 0.0], "", ""), (3, [nan, 1.0], "", ""), (4, [inf, 1.0], "", ""), (5, [None, 1.0], "", ""), (6, [], "", ""), (7, [1.0], "", ""), (None, [1.0, 1.0], "", "")]
    assert search(rows) == {20: [(1, 1, 4.0), (2, 2, -1.0)]}
    assert search([]) == {} and search(rows_of([[1, 1]], ids=[20])) == {}


def test_repeated_rows_count_once(search):
    draw = np.random.default_rng(3)
    rows = rows_of(draw.normal(size=(100, 8)).astype(np.float32)) + rows_of([[9] * 8] * 30, ids=[20, *range(200, 229)])
    rows = [r for i, r in enumerate(rows) if i != 20]
    assert search(rows + [r for r in rows if r[0] in (0, 20, 205)] * 30, k=10) == search(rows, k=10)


def test_each_vector_of_an_id_asks(search):
    rows = rows_of([[1, 0], [0, 1], [2, 0], [0, 2]], ids=[20, 20, 1, 2])
    assert sorted(search(rows, k=1)[20]) == [(1, 1, 2.0), (1, 2, 2.0)]
