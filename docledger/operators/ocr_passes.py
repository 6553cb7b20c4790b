"""Merging OCR passes and choosing the image variant: rows ``(doc_id, variant_no, variant, pass_no, cfg, text)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.functions.strings import keyword_score, line_key
from docledger.functions.text import blank_to_null, strip, text_lines

VARIANT = ["doc_id", "variant_no", "variant"]


def rank_ocr_pass(passes: DataFrame) -> DataFrame:
    """Best configuration of each variant by keyword score, the first on a tie."""
    order = F.struct(-F.col("score"), F.col("pass_no"))
    scored = passes.select(*VARIANT, "pass_no", "cfg", keyword_score(F.col("text")).alias("score"))
    return scored.groupBy(*VARIANT).agg(F.min_by("cfg", order).alias("cfg"), F.max("score").alias("score"))


def merge_ocr_passes(passes: DataFrame) -> DataFrame:
    """Text of each variant with the lines of all its passes, each line once, and the best configuration.

    Passes are dealt by document once. All that follows groups by the document and more, so it needs no other exchange, nor
    does :func:`choose_ocr_variant`: lines are rows, of equal ones the first stays (a grouped minimum), and the rest are
    joined in their order. A blank line stands for nothing, but keeps its pass and the pass's score.
    """
    score = F.struct((-keyword_score(F.col("text"))).alias("score"), "pass_no", "cfg").alias("_pass")
    # The score is a column before lines are: beside the generator it would be worked out again for every line.
    scored = passes.repartition("doc_id").select(*VARIANT, "pass_no", score, "text")
    lines = (
        scored.select(*VARIANT, "pass_no", "_pass", F.posexplode_outer(text_lines(F.col("text"))).alias("line_no", "line"))
        .withColumn("line", blank_to_null(strip(F.col("line"))))
        .withColumn("_key", line_key(F.col("line")))
    )
    firsts = lines.groupBy(*VARIANT, "_key").agg(
        F.min(F.struct("pass_no", "line_no", "line")).alias("_first"), F.min("_pass").alias("_pass")
    )
    kept = firsts.select(*VARIANT, "_pass", F.struct("_first.pass_no", "_first.line_no").alias("_at"), F.col("_first.line").alias("line"))
    text = F.expr("coalesce(listagg(line, '\n') WITHIN GROUP (ORDER BY _at), '')")
    merged = kept.groupBy(*VARIANT).agg(F.min("_pass")["cfg"].alias("cfg"), text.alias("text"))
    return merged.withColumn("score", keyword_score(F.col("text")))


def rank_ocr_variant(merged: DataFrame) -> DataFrame:
    """Best variant of each document by the score of its merged text, the first on a tie."""
    order = F.struct(-F.col("score"), F.col("variant_no"))
    return merged.groupBy("doc_id").agg(F.min_by("variant", order).alias("variant"), F.max("score").alias("score"))


def choose_ocr_variant(merged: DataFrame) -> DataFrame:
    """Best variant of each document with its text and ``variant:config`` label."""
    best = F.max_by(F.struct("variant", "cfg", "text", "score"), F.struct(F.col("score"), -F.col("variant_no")))
    return (
        merged.groupBy("doc_id")
        .agg(best.alias("b"))
        .select(
            "doc_id",
            F.col("b.variant").alias("ocr_input_variant"),
            F.concat_ws(":", "b.variant", "b.cfg").alias("extraction_flavor"),
            F.col("b.text").alias("text"),
            F.col("b.score").alias("score"),
        )
    )
