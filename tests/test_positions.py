"""Positions, neighbours and consumed rows against plain sequential readings, with buckets far smaller than the groups."""

import random

import pytest
from pyspark.sql import functions as F

from docledger.operators import positions


@pytest.fixture(autouse=True)
def small_buckets(monkeypatch):
    monkeypatch.setattr(positions, "BUCKET_ROWS", 4)


def groups(seed, n_groups=30, longest=40):
    rng = random.Random(seed)
    rows = []
    for g in range(n_groups):
        size = longest * 5 if g == 0 else rng.randint(1, longest)  # one group holds a large part of all rows
        numbers = sorted(rng.sample(range(size * 3), size))
        rows += [(f"g{g}", n, f"v{g}-{n}", rng.random() < 0.7) for n in numbers]
    rng.shuffle(rows)
    return rows


def by_group(rows):
    out = {}
    for row in sorted(rows):
        out.setdefault(row[0], []).append(row)
    return out


def test_positions_and_next_values(spark):
    rows = groups(1)
    df = spark.createDataFrame(rows, "k string, no int, v string, takes boolean")
    numbered = positions.number_rows(df, ["k"], ["no"], positions.bucket_of(F.col("no")), look_ahead="v")
    found = {(r.k, r.no): (r.pos, r.next_v, r.has_next) for r in numbered.collect()}
    expected = {}
    for k, group in by_group(rows).items():
        for i, (_, no, _, _) in enumerate(group):
            following = group[i + 1][2] if i + 1 < len(group) else None
            expected[(k, no)] = (i, following, following is not None)
    assert found == expected


def test_consumed_rows(spark):
    rows = groups(2)
    df = spark.createDataFrame(rows, "k string, no int, v string, takes boolean")
    numbered = positions.number_rows(df, ["k"], ["no"], positions.bucket_of(F.col("no")))
    found = {(r.k, r.no): r.consumed for r in positions.consumed(numbered, ["k"], "pos", F.col("takes")).collect()}
    expected = {}
    for k, group in by_group(rows).items():
        skip = False
        for _, no, _, takes in group:
            expected[(k, no)] = skip
            skip = takes and not skip
    assert found == expected


def test_no_window_covers_a_whole_group(spark):
    df = spark.createDataFrame(groups(3), "k string, no int, v string, takes boolean")
    plan = positions.number_rows(df, ["k"], ["no"], positions.bucket_of(F.col("no")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    over_groups = [line for line in text.splitlines() if "Window [" in line and "_bucket" not in line]
    assert not over_groups


def test_global_ranks(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    found = {r.id: r["rank"] for r in positions.ranked(df, [F.desc("v"), F.asc("id")]).collect()}
    order = sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert found == {i: n + 1 for n, i in enumerate(order)}
