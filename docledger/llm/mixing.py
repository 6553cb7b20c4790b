"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis and Spirakis).

Every document gets the key ``-ln(u) / w``: ``u`` from its id, ``w`` its quality weight. In key order a source's documents
form a weighted sample of any length, so a prefix of that order which fills the word budget is the selection. Whole
epochs of a source come first; only what is left of its target is selected. The document at the budget's end gives
just the words still missing, so targets are met to the word.

No task sorts a source: a first aggregation sums the sizes in ``BUCKETS`` slices of the key range, which tells the slice
where the budget ends; only that slice is ordered exactly.

Defined cases. Null text: size 0. Null source: a source of its own, last in order. A missing or null quality: weight
``UNLABELLED``; of repeated labels the best counts. Rows equal in id and size are interchangeable. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.llm.store import settled

WORD = r"[^\x20\x09-\x0D]++"
SOURCE_WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST_EPOCHS = 1.5, 2.0
GOOD, BAD, UNLABELLED = 2.0, 0.5, 1.0
BUCKETS, SALTS = 4096, 64


def quality_weights(labels: DataFrame) -> DataFrame:
    """``doc_id, weight`` from ``labels`` (doc_id, quality)."""
    best = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q"))
    return best.select("doc_id", F.when(F.col("q") > 0, GOOD).when(F.col("q") <= 0, BAD).otherwise(UNLABELLED).alias("weight"))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from one row per document (source, size).

    Targets are weighted shares of ``share`` times all words, none above ``most`` times its source; the excess goes to the
    others by weight. With sources in the order of the level at which they fill up, the first that does not fill up
    gives the common level. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    left = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    used = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return (
        totals.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
        .withColumn("cap", F.col("source_size") * float(most))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("here", (F.sum("source_size").over(everything) * float(share) - used) / left)
        .withColumn("at", F.when(F.col("here") <= F.col("level"), F.row_number().over(by_level)))
        .withColumn("common", F.min_by("here", "at").over(everything))
        .select("source", "source_size", F.least("cap", F.coalesce(F.col("common") * F.col("weight"), F.col("cap"))).alias("target"))
    )


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: Sequence[float] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
    seed: str = "mix",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, epochs, taken`` and the columns of ``carry``.

    ``quality`` has ``doc_id, weight``. ``taken`` counts a document's words once per epoch plus those of the selection.
    """
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *carry)
    if quality is not None:
        sized = sized.join(quality.select("doc_id", "weight"), "doc_id", "left")
    weight = F.coalesce("weight", F.lit(UNLABELLED)) if quality is not None else F.lit(UNLABELLED)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    chance = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    sized = settled(sized.select("doc_id", "source", "size", *carry, (-F.log(chance) / weight).alias("key")))
    sized = sized.withColumn("slice", F.floor(BUCKETS * (1 - F.exp(-F.col("key")))).cast("int"))

    words = F.floor(F.col("target") + 0.5).cast("long")
    targets = source_targets(sized, weights, share, most).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    )
    targets = settled(targets.withColumn("budget", words - F.col("epochs") * F.col("source_size")))

    slices = sized.groupBy(F.col("source").alias("s"), "slice").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("s").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    ends = (
        slices.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(targets.select(F.col("source").alias("t"), "budget"), F.col("s").eqNullSafe(F.col("t")))
        .where((F.col("before") < F.col("budget")) & (F.col("budget") <= F.col("before") + F.col("words")))
        .select("s", F.col("slice").alias("end"), "before")
    )
    # One row per source, settled so that its size is known and Spark broadcasts it if it is small.
    plan = settled(targets.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "t"))
    plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a large source meets it in many tasks
    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("t")) & (F.col("slice") % SALTS == F.col("salt"))).drop("t", "salt")

    in_order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at_end = placed.where(F.col("slice") == F.col("end"))
    rest = F.col("budget") - F.col("before") - F.coalesce(F.sum("size").over(in_order), F.lit(0))
    at_end = at_end.withColumn("part", F.greatest(F.lit(0), F.least("size", rest)))
    others = placed.where(F.col("end").isNull() | (F.col("slice") != F.col("end")))
    others = others.withColumn("part", F.when(F.col("slice") < F.col("end"), F.col("size")).otherwise(0))
    return (
        at_end.unionByName(others)
        .withColumn("taken", (F.col("epochs") * F.col("size") + F.col("part")).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "epochs", "taken", *carry)
    )
