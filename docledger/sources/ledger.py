"""The loaded tables on disk: hash buckets of ``document_id``, written by run, published by version.

    documents/run=<run>/doc_type=<type>/bucket=<n>/…    line_items/run=<run>/bucket=<n>/…    gold_<name>/run=<run>/bucket=<n>/…
    versions/<number>-<run id>.json

A version names, for each bucket, the runs whose files hold its rows. A load adds files of its own run and never touches
others; it copies those buckets in which documents are replaced, or that already have ``MAX_PARTS`` runs, and leaves
all others as they are. So its cost follows the batch and the buckets that it replaces something in. The version file is
written under another name and renamed when everything is in place: readers, which resolve the version once, see a load
whole or not at all, and a load that was killed leaves files that no version names (:meth:`Ledger.drop_unused`).

One load at a time: who writes has to see to that. Renaming is atomic on HDFS and local disks; on a store without it the
version file is still the last thing written.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.schemas import DOCUMENTS_TABLE, ITEMS_TABLE

BUCKETS, MAX_PARTS, KEEP_VERSIONS = 64, 8, 2

#: Schemas of what is kept, besides the partition columns ``run`` and ``bucket``; gold tables hold sums by bucket.
TABLES = {
    "documents": DOCUMENTS_TABLE + ", updated_at timestamp",
    "line_items": "id bigint, " + ITEMS_TABLE,
    "gold_overview": "n_docs bigint, sum_value decimal(28,2), n_with_diff_subtotal bigint",
    "gold_parties": "party_name string, sum_value decimal(28,2), count_docs bigint",
    "gold_items": "item string, total_quantity decimal(28,3), sum_value decimal(28,2), count_rows bigint",
}


def bucket_of_key(key: str = "document_id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Version:
    """Which runs hold the rows of each bucket, and the largest line item id."""

    number: int = 0
    run_id: str = ""
    buckets: int = BUCKETS
    last_id: int = 0
    parts: dict[int, tuple[str, ...]] = field(default_factory=dict)
    summary: dict[str, int] = field(default_factory=dict)  # what the load counted

    def live(self, only: set[int] | None = None) -> Column:
        """Condition on the partition columns that holds for the files of this version, or for some buckets' files."""
        by_run: dict[str, list[int]] = {}
        for bucket, runs in self.parts.items():
            if only is None or bucket in only:
                for run in runs:
                    by_run.setdefault(run, []).append(bucket)
        held = F.lit(False)
        for run, buckets in sorted(by_run.items()):
            held = held | ((F.col("run") == run) & F.col("bucket").isin(sorted(buckets)))
        return held


class Ledger:
    """The tables below one folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """``buckets`` counts for a ledger without a version; later ones keep the number of the first."""
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._hadoop = spark._jvm.org.apache.hadoop
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, pattern: str) -> list[str]:
        """Paths below the root that match, relative to it."""
        root = self._fs.makeQualified(self._path("")).toString().rstrip("/")
        return sorted(x.getPath().toString().removeprefix(f"{root}/") for x in self._fs.globStatus(self._path(pattern)) or [])

    def _versions(self) -> list[str]:
        return self._names("versions/*.json")

    def _read(self, name: str) -> Version:
        stream = self._fs.open(self._path(name))
        try:
            text = self._hadoop.io.IOUtils.readFullyToByteArray(stream)
        finally:
            stream.close()
        held = json.loads(bytes(text))
        return Version(**{**held, "parts": {int(b): tuple(runs) for b, runs in held["parts"].items()}})

    def current(self) -> Version:
        names = self._versions()
        return self._read(names[-1]) if names else Version(buckets=self.buckets)

    def version_of(self, run_id: str) -> Version | None:
        """The version that the run published, if it has."""
        found = [n for n in self._versions() if re.fullmatch(rf"versions/\d+-{re.escape(run_id)}\.json", n)]
        return self._read(found[0]) if found else None

    def publish(self, version: Version) -> None:
        """Make ``version`` the current one. Nothing before this call is visible to readers."""
        name = f"versions/{version.number:010d}-{version.run_id}.json"
        waiting = self._path(f"versions/_{uuid.uuid4().hex}")
        stream = self._fs.create(waiting, False)
        try:
            stream.write(bytearray(json.dumps(version.__dict__).encode()))
        finally:
            stream.close()
        if not self._fs.rename(waiting, self._path(name)):
            raise FileExistsError(f"version {version.number} was published by another load")

    def read(self, table: str, version: Version, only: set[int] | None = None) -> DataFrame:
        """Rows of a table in a version, with ``run`` and ``bucket``; only the named buckets' files if ``only`` is given."""
        schema = f"{TABLES[table]}, run string, bucket int"
        if not version.parts or not self._fs.exists(self._path(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}").where(version.live(only))

    def rows_of_run(self, table: str, run: str) -> DataFrame:
        """Rows that a run has written, whether published or not."""
        if not self._names(f"{table}/run={run}"):
            return self.spark.createDataFrame([], f"{TABLES[table]}, run string, bucket int")
        return self.spark.read.schema(f"{TABLES[table]}, run string, bucket int").parquet(f"{self.root}/{table}").where(F.col("run") == run)

    def write(self, table: str, rows: DataFrame, run: str) -> None:
        """Rows with ``bucket`` as files of a run that has none of this table yet. Large buckets become several files."""
        by = ["doc_type", "bucket"] if table == "documents" else ["bucket"]
        columns = [f.name for f in T.StructType.fromDDL(TABLES[table])]
        rows.select(*columns, "bucket").hint("rebalance", "bucket").write.partitionBy(*by).parquet(f"{self.root}/{table}/run={run}")

    def touched(self, run: str) -> set[int]:
        """Buckets that a run has files in."""
        names = self._names(f"documents/run={run}/*/bucket=*") + self._names(f"line_items/run={run}/bucket=*")
        return {int(n.rpartition("=")[2]) for n in names}

    def drop_unused(self, keep: int = KEEP_VERSIONS) -> list[str]:
        """Remove files of runs that none of the last ``keep`` versions names. Not while a load is running."""
        versions = [self._read(n) for n in self._versions()[-keep:]]
        used = {run for v in versions for runs in v.parts.values() for run in runs}
        gone = [n for table in TABLES for n in self._names(f"{table}/run=*") if n.rpartition("=")[2] not in used]
        for name in gone:
            self._fs.delete(self._path(name), True)
        return gone

    def tables(self, version: Version | None = None) -> tuple[DataFrame, DataFrame]:
        """Documents and line items of a version, the current one if none is named."""
        version = version or self.current()
        return tuple(self.read(table, version).drop("run", "bucket") for table in ("documents", "line_items"))
