"""The corpus pipeline: documents in, a mixed training set out.

Every stage works on what the one before it kept, and each result is written to the shared folder and read again. All but
the last return the columns of ``documents``, extra ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.llm import decontamination, line_templates, mixing, order_minhash, toxicity
from docledger.llm.store import fresh, settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of recurring templates."""
    names = (fresh(docs, "n_lines"), fresh(docs, "dropped"))
    return line_templates.drop_recurring_lines(docs, most=None, names=names).drop(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return order_minhash.drop_near_duplicates(docs)


def drop_leaking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with ``size, source_size, target, taken``; ``taken`` is the number of words to take of each,
    repeats counted. Extra columns with these names, in any case, are replaced."""
    added = ["size", "source_size", "target", "taken"]
    own = [c for c in docs.columns if c.lower() not in added]
    rest = [c for c in own if c not in ("doc_id", "source")]
    nested = docs.select("doc_id", "source", "text", F.struct(*rest).alias("rest"))
    mixed = mixing.mix(nested, mixing.quality_weights(table(spark, sf_dir, "labels")), carry=["rest"]).where(F.col("taken") > 0)
    return mixed.select(*(c if c in ("doc_id", "source") else F.col(f"rest.`{c}`").alias(c) for c in own), *added)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaking),
    ("mixing", mix_sources),
]

#: No SQL can express training a network or drawing order-min-hashes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
