"""Loading a batch into the ledger: staged by run, checked, merged by bucket, published at once."""

from __future__ import annotations

import re
import uuid
from dataclasses import replace as changed

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from docledger.operators.lineage import free_shuffles, spent
from docledger.operators.tables import assign_line_id, distinct_keys
from docledger.plans import gold
from docledger.sources.ledger import MAX_PARTS, Ledger, Version, bucket_of_key


class LoadRejected(ValueError):
    """A batch broke a table rule; the tables are as they were."""


def run_identity(kind: str, run_ts: str) -> str:
    """Names a run by what it loads and its stamp: the same run is never loaded twice."""
    return f"{kind}-{re.sub('[^0-9A-Za-z]', '', run_ts)}"


def key_check(new: DataFrame, items: DataFrame, old: DataFrame, replace: bool = True) -> DataFrame:
    """One row about the keys of a batch, by one aggregate over its documents, its items and the keys that are there already.

    ``duplicates, duplicate`` and ``orphans, orphan`` count offending keys and name the smallest; ``replaced`` lists the
    buckets that have a document of the batch already. All three frames have ``document_id, bucket``; ``old`` may be
    limited to the batch's buckets.
    """
    one = lambda df, kind: df.select("document_id", "bucket", *[F.lit(int(k == kind)).cast("bigint").alias(k) for k in ("new", "items", "old")])
    keys = one(new, "new").unionByName(one(items, "items")).unionByName(one(old, "old"))
    keys = keys.groupBy("document_id", "bucket").agg(*[F.sum(k).alias(k) for k in ("new", "items", "old")])
    duplicate = (F.col("new") > 1) if replace else (F.col("new") > 0) & (F.col("new") + F.col("old") > 1)
    orphan = (F.col("items") > 0) & (F.col("new") + F.col("old") == 0)
    return keys.where(F.col("document_id").isNotNull()).agg(
        F.count_if(duplicate).alias("duplicates"),
        F.min(F.when(duplicate, F.col("document_id"))).alias("duplicate"),
        F.count_if(orphan).alias("orphans"),
        F.min(F.when(orphan, F.col("document_id"))).alias("orphan"),
        F.collect_set(F.when((F.col("new") > 0) & (F.col("old") > 0), F.col("bucket"))).alias("replaced"),
    )


def broken_rules(counted: dict, keys) -> list[str]:
    """All rules that a batch breaks, with the number of offenders."""
    rules = (
        ("duplicate document_id", keys["duplicates"], keys["duplicate"]),
        ("missing document_id or doc_type", counted["no_key"], None),
        ("line item without document_id", counted["loose_items"], None),
        ("line item of an unknown document", keys["orphans"], keys["orphan"]),
    )
    return [f"{rule}: {n}" + (f", e.g. {example}" if example is not None else "") for rule, n, example in rules if n]


def observed(watch: Observation) -> dict[str, int]:
    """What was counted while rows were written; nothing where Spark found without reading that there are none.

    ``Observation.get`` fails in that case, so the values are taken as the JVM holds them.
    """
    return {k: v or 0 for k, v in dict(watch._jo.getAsJava()).items()}


def load_batch(ledger: Ledger, documents: DataFrame, items: DataFrame, run_id: str, replace: bool = True, counts: dict[str, int] | None = None) -> Version:
    """Load table rows (:func:`~docledger.operators.tables.document_rows`, ``item_rows``) and publish the new version.

    With ``replace`` a document of the batch takes the place of the one with its id, and all its items; else it breaks
    the key rule. A run that was published before changes nothing: its version is returned. ``counts`` go into
    the version's summary beside ``loaded_docs`` and ``loaded_items``, which are counted while the files are written.
    """
    if (known := ledger.version_of(run_id)) is not None:
        return known
    base = ledger.current()
    run = f"{run_id}-{uuid.uuid4().hex[:8]}"  # a repeated attempt has files of its own
    key = bucket_of_key("document_id", base.buckets)

    missing = F.col("document_id").isNull() | F.col("doc_type").isNull()
    of_documents, of_items = Observation(), Observation()
    watched = documents.withColumn("bucket", key)
    ledger.write("documents", watched.observe(of_documents, F.count(F.lit(1)).alias("loaded_docs"), F.count_if(missing).alias("no_key")), run)
    free_shuffles(ledger.spark)
    with_ids = assign_line_id(items, base.last_id)
    watched = with_ids.withColumn("bucket", key)
    loose = F.count_if(F.col("document_id").isNull())
    ledger.write("line_items", watched.observe(of_items, F.count(F.lit(1)).alias("loaded_items"), loose.alias("loose_items")), run)
    spent(with_ids)
    free_shuffles(ledger.spark)
    counted = {"loaded_docs": 0, "no_key": 0, "loaded_items": 0, "loose_items": 0, **observed(of_documents), **observed(of_items)}

    touched = ledger.touched(run)
    new = ledger.rows_of_run("documents", run)
    keys = key_check(new, ledger.rows_of_run("line_items", run), ledger.read("documents", base, touched), replace).first()
    if rules := broken_rules(counted, keys):
        raise LoadRejected("; ".join(rules))

    copied = {b for b in touched if b in keys["replaced"] or len(base.parts.get(b, ())) >= MAX_PARTS}
    kept = f"{run}-kept"
    if copied:
        gone = distinct_keys(new.where(F.col("bucket").isin(sorted(copied))))
        for table in ("documents", "line_items"):
            old = ledger.read(table, base, copied).drop("run")
            ledger.write(table, old.join(gone, "document_id", "left_anti"), kept)
            free_shuffles(ledger.spark)
    for part in [run, kept] if copied else [run]:
        for table, sums in gold.bucket_sums(*(ledger.rows_of_run(t, part) for t in ("documents", "line_items"))).items():
            ledger.write(table, sums, part)
    free_shuffles(ledger.spark)
    parts = {b: (*(() if b in copied else base.parts.get(b, ())), *((kept,) if b in copied else ()), run) for b in touched}
    version = changed(
        base,
        number=base.number + 1,
        run_id=run_id,
        last_id=base.last_id + counted["loaded_items"],
        parts={**base.parts, **parts},
        summary={**(counts or {}), "loaded_docs": counted["loaded_docs"], "loaded_items": counted["loaded_items"]},
    )
    ledger.publish(version)
    return version
