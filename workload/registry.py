"""Named queries with their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.oracle_views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None, **views: str):
    """Register a query under its function's name; ``oracle`` may name any view of :mod:`workload.oracle_views`."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_views(oracle, views)
        return fn

    return register
