"""One registered query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.llm import (
    byte_repeats,
    decontamination,
    fill_in_middle,
    license_scan,
    line_templates,
    mixing,
    order_minhash,
    prefix_forest,
    secret_ownership,
    token_alignment,
    toxicity,
    url_templates,
    word_repeats,
)
from docledger.llm.oracles import ORACLES  # noqa: F401
from docledger.llm.store import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = toxicity.train(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), net)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "threshold",
        "toxic",
    )


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.quality_weights(table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _removed():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


@query
def op5_column_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = byte_repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", _removed().alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op9_suffix_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = word_repeats.remove_passages(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", _removed().alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = order_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_hash", "kept")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), most=None)
    return kept.select("doc_id", "n_lines", F.size("dropped").alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ownership.secrets_by_document(table(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("found", lambda s: s["kind"] != "opaque")
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
        "n_live",
        "n_example",
    )


@query
def op7_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of pages are those given for their id: low quality or toxic is bad."""
    labels = table(spark, sf_dir, "labels")
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    labels = labels.where("quality is not null or toxic is not null").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_templates.judge(table(spark, sf_dir, "pages"), labels)


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fill_in_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))
