"""Secrets, with the owners of each value counted over the whole corpus.

Three base kinds are found by pattern in every text. A fourth, ``opaque``, adds long tokens outside them that look like
credentials. How widely a value is spread tells examples from leaks: a value that several owners (sources) have was copied from
a tutorial or a test file; one that belongs to a single owner and looks random is taken to be live. Opaque tokens are
only reported if they are live in that sense, base matches always.

Values are hashed where they are found: nothing that is shuffled or written holds one, only hashes, places and whether a
value looks random.

DataFrame operations only. Texts are read by Java patterns without groups that repeat, so long runs cost no stack. Places
follow from the lengths of the matches and of the pieces between them, summed in a window over one document's matches. The
statistics are counted by (hash, owner) before by hash, with partial aggregation, so a value that a third of
all rows have costs no more than others.

Defined cases. Null and empty texts: no spans. A null source is an owner of its own. Rows equal in id and text are one
document. Ids may be null or repeated. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.llm.store import row_key, settled

# The base kinds, in their order. The second and third are cut to their least length, which runs of one class
# allow; an assignment's value is measured after the match, as a short one still uses up its text.
ASSIGN = r"""(?=[PpSsTtAa])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^[^:=]*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"[A-Za-z0-9_-]{20,}"
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "opaque": OPAQUE}
LEAST_VALUE = 12

EXAMPLE_OWNERS = 3
LEAST_CLASSES, LEAST_DIFFERENT = 3, 10


def _matches(kind: str, pattern: str) -> Column:
    """All matches of a kind as (kind, i, gap, value): ``gap`` is the length of the text between it and the match before."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    between = F.transform(F.split("text", pattern, -1), F.length)
    pairs = F.when(F.col("text").rlike(pattern), F.arrays_zip(found.alias("match"), between.alias("gap")))
    return F.transform(
        pairs,
        lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), p["gap"].alias("gap"), p["match"].alias("match")),
    )


def looks_random(value: Column) -> Column:
    classes = sum((value.rlike(c).cast("int") for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")), F.lit(0))
    hex_like = value.rlike("^[0-9a-f]+$") & value.rlike("[0-9]") & value.rlike("[a-f]")
    different = F.size(F.array_distinct(F.split(value, "")))
    return ((classes >= LEAST_CLASSES) | hex_like | value.rlike(f"^{ACCESS}$")) & (different >= LEAST_DIFFERENT)


def candidates(docs: DataFrame) -> DataFrame:
    """``k, source, kind, rank, start, end, value_sha256, random`` of all matches, ends exclusive, in code points."""
    keyed = docs.select(row_key().alias("k"), "source", "text")
    lists = [_matches(kind, pattern) for kind, pattern in KINDS.items()]
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,match:string>>")
    found = keyed.select("k", "source", F.explode(F.concat(*[F.coalesce(x, none) for x in lists])).alias("m")).select("k", "source", "m.*")
    value = F.when(F.col("kind") == "assign", F.regexp_extract("match", ASSIGN_VALUE, 1)).otherwise(F.col("match"))
    found = found.where(F.col("match").isNotNull()).withColumn("value", value)
    hashed = F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256")
    size, enough = F.length("match").alias("size"), (F.length("value") >= LEAST_VALUE).alias("enough")
    found = found.select("k", "source", "kind", "i", "gap", size, enough, hashed, looks_random(F.col("value")).alias("random"))
    found = settled(found).dropDuplicates(["k", "source", "kind", "i"])
    so_far = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("k", "source", "kind").orderBy("i"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank")
    spans = found.select("k", "source", "kind", rank, (so_far - F.col("size")).alias("start"), so_far.alias("end"), "value_sha256", "random", "enough")
    return spans.where("enough").drop("enough")


def ownership(found: DataFrame) -> DataFrame:
    """``value_sha256, owners, repositories``: by how many sources, and in how many documents, each value is held."""
    held = found.select("value_sha256", "source", "k").distinct().groupBy("value_sha256", "source").agg(F.count(F.lit(1)).alias("n"))
    return held.groupBy("value_sha256").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))


def find_secrets(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``k, kind, rank, start, end, value_sha256, owners, repositories, verdict`` for every secret.

    ``verdict`` is ``example``, ``live`` or, for owner-specific values that do not look random, ``weak``.
    """
    found = settled(candidates(docs))
    by_value = settled(ownership(found))
    by_place = Window.partitionBy("k", "source").orderBy("start", "rank")
    is_base = F.col("kind") != "opaque"
    ended = F.max(F.when(is_base, F.col("end"))).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.min(F.when(is_base, F.col("start"))).over(by_place.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(ended, F.lit(0)) <= F.col("start")) & (F.coalesce(begins, F.col("end")) >= F.col("end"))
    verdict = (
        F.when(F.col("owners") >= example_owners, "example").when(F.col("random"), "live").otherwise("weak")
    )
    judged = settled(found.withColumn("free", free)).join(by_value, "value_sha256").withColumn("verdict", verdict)
    judged = judged.where(is_base | (F.col("free") & (F.col("verdict") == "live")))
    return judged.select("k", "kind", "rank", "start", "end", "value_sha256", "owners", "repositories", "verdict").distinct()


def secrets_by_document(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row per document: ``doc_id``, counts by kind and verdict, and ``found``, its secrets in order of place and kind."""
    secrets = find_secrets(docs, example_owners).groupBy("k")
    one = F.struct("start", "rank", "end", "kind", "value_sha256", "owners", "repositories", "verdict")
    counts = [F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in KINDS]
    counts += [F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "example", "weak")]
    by_key = secrets.agg(F.sort_array(F.collect_list(one)).alias("found"), *counts)
    names = [c for c in by_key.columns if c not in ("k", "found")]
    whole = docs.select("doc_id", row_key().alias("k")).join(by_key, "k", "left")
    empty = F.array().cast(by_key.schema["found"].dataType)
    return whole.select("doc_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in names), F.coalesce("found", empty).alias("found"))
