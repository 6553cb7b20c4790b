"""Row positions, neighbours and running values inside groups of any size.

A plain window over a key would put a whole group into one task. Here every window covers one *bucket* of a
group, an order-preserving slice of it, and a second, much smaller window runs over one row per bucket. With
integer row numbers and ``BUCKET_ROWS`` rows to a bucket, no window sees more than ``BUCKET_ROWS`` rows on the
first level and ``2**31 / BUCKET_ROWS`` on the second. Groups with a single bucket, which is nearly all of them,
add no row to the second level's result, so its join is one with an all but empty side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.operators.lineage import read_from, stored, write_once

BUCKET_ROWS = 8192


def bucket_of(row_no: Column) -> Column:
    return F.floor(row_no / BUCKET_ROWS).cast("bigint")


def beyond_first(df: DataFrame, bucket: Column) -> bool:
    """Whether any row lies outside bucket 0; if none does, every group is one bucket. Reads the columns of ``bucket`` only."""
    return df.agg(F.count_if(~bucket.eqNullSafe(F.lit(0)))).first()[0] > 0


def one_bucket(df: DataFrame) -> bool:
    """``df`` comes from :func:`number_rows`, which found that every group is one bucket."""
    return bool(df.schema["_multi"].metadata.get("one_bucket"))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    out: str = "pos",
    look_ahead: str | None = None,
    several: bool | None = None,
) -> DataFrame:
    """Add the dense 0-based position ``out`` of each row in its group.

    ``bucket`` has to rise with ``order``. ``look_ahead`` names a column whose value in the next row of the group
    is added as ``next_<column>`` (null in the last row). The bucket stays in ``_bucket``; ``_multi`` is true in groups
    of several buckets and null in others. Without rows beyond the first bucket (``several``, looked up if it is not given)
    the second level is left out: no group would have a row in it.
    """
    part = [*keys, "_bucket"]
    inner = Window.partitionBy(*part).orderBy(*order)
    if several is None:
        several = beyond_first(df, bucket)
    local = df.withColumn("_bucket", bucket).withColumn("_at", F.row_number().over(inner) - 1)
    if look_ahead:
        local = local.withColumn("_next", F.lead(F.struct(F.col(look_ahead).alias("v"))).over(inner))
    if not several:
        single = local.withColumn("_multi", F.lit(None).cast("boolean")).withColumn(out, F.col("_at").cast("bigint"))
        if look_ahead:
            single = single.withColumn(f"next_{look_ahead}", F.col("_next")["v"]).withColumn("has_next", F.col("_next").isNotNull())
        return single.drop("_at", "_next").withMetadata("_multi", {"one_bucket": True})
    local = local.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*part)))
    outer = Window.partitionBy(*keys).orderBy("_bucket")
    before = F.sum("_rows").over(outer.rowsBetween(Window.unboundedPreceding, -1))
    head = [F.lead(F.struct(F.col(look_ahead).alias("v"))).over(outer).alias("_head")] if look_ahead else []
    heads = (
        local.where(F.col("_at") == 0)
        .select(*part, before.alias("_before"), F.lead("_bucket").over(outer).alias("_following"), *head)
        .where(F.col("_before").isNotNull() | F.col("_following").isNotNull())
        .withColumn("_multi", F.lit(True))
        .drop("_following")
    )
    joined = local.join(heads, part, "left").withColumn(
        out, (F.col("_at") + F.coalesce("_before", F.lit(0))).cast("bigint")
    )
    if look_ahead:
        joined = joined.withColumn(f"next_{look_ahead}", F.coalesce("_next", "_head")["v"]).withColumn(
            "has_next", F.coalesce("_next", "_head").isNotNull()
        )
    return joined.drop("_at", "_rows", "_before", "_next", "_head")


def last_before(df: DataFrame, keys: Sequence[str], pos: str, when: Column, out: str) -> DataFrame:
    """Largest ``pos`` of the group's earlier rows for which ``when`` holds, -1 if none.

    ``df`` comes from :func:`number_rows`, whose buckets are used again.
    """
    part = [*keys, "_bucket"]
    mark = F.when(when, F.col(pos))
    inner = Window.partitionBy(*part).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    if one_bucket(df):
        return df.withColumn(out, F.coalesce(F.max(mark).over(inner), F.lit(-1).cast("bigint")))
    outer = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # The filter makes the join that set `_multi` an inner one: without large groups this side is found empty early.
    carried = (
        df.where(F.col("_multi"))
        .groupBy(*part)
        .agg(F.max(mark).alias("_top"))
        .select(*part, F.max("_top").over(outer).alias("_carry"))
        .where(F.col("_carry").isNotNull())
    )
    return (
        df.withColumn("_inner", F.max(mark).over(inner))
        .join(carried, part, "left")
        .withColumn(out, F.coalesce("_inner", "_carry", F.lit(-1).cast("bigint")))
        .drop("_inner", "_carry")
    )


def consumed(df: DataFrame, keys: Sequence[str], pos: str, takes: Column, out: str = "consumed") -> DataFrame:
    """Rows that a sequential scan skips because the row before them, when visited, takes its successor along.

    In a run of rows that take their successor, visits alternate, so a row is consumed exactly if the run that
    ends just before it has odd length.
    """
    df = last_before(df, keys, pos, ~takes, "_break")
    run = F.col(pos) - 1 - F.col("_break")
    return df.withColumn(out, run % 2 == 1).drop("_break")


def ranked(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Number a whole result from 1 in global order, without one task seeing all rows.

    A range-partitioned sort splits the rows, ties of the first column included when ``order`` ends in a unique key.
    """
    return numbered(df.orderBy(*order), out)


def numbered(df: DataFrame, out: str, compact: bool = False) -> DataFrame:
    """Number all rows from 1 without gaps, in the order of their partitions and of the rows in them.

    The rows are checkpointed, so that their partitions stay as they are; the offsets are one row a partition. With
    ``compact`` they are written as Parquet instead, compressed, and come back in any order; they can be removed by
    :func:`~docledger.operators.lineage.spent` when the result has been read.
    """
    tagged = (stored if compact else write_once)(df.withColumn("_tag", F.monotonically_increasing_id()))
    part, at = F.shiftright("_tag", 33), F.col("_tag").bitwiseAND((1 << 33) - 1)
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        tagged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    found = (
        tagged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # else all rows might be dealt for them
        .withColumn(out, (F.col("_before") + at + 1).cast("bigint"))
        .drop("_part", "_before", "_tag")
    )
    return read_from(found, tagged)
