"""Shared results on shared storage, and keys for documents."""

from __future__ import annotations

import functools
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import docledger


#: Where :func:`settled` wrote each frame.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="docledger-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode, where all tasks share a host."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext._jsc.sc().isLocal():
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    return _local_folder()


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed now, written as Parquet to the shared folder and read again: lineage ends here and lost executors
    lose nothing. Files lie in one folder per application, which may go when the application has ended."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/docledger-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    _folders[read] = path
    return read


def spent(*frames: DataFrame) -> None:
    """Remove the files of :func:`settled` frames that no later step reads. Shuffle files of finished steps go with the
    plans that wrote them, as soon as the driver's collector has seen that nothing holds those; iterative work calls for it."""
    for df in frames:
        path = _folders.pop(df, None)
        if path:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    if frames:
        frames[0].sparkSession._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """Identifies a document by its id and whole text; rows equal in both are interchangeable for every operator here.

    A struct, so that joins on it also match rows whose ``doc_id`` is null.
    """
    return F.struct(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


@functools.cache
def _package(application: str) -> str:
    root = Path(docledger.__file__).parent
    path = Path(_local_folder()) / f"{application}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application; they need not have it installed."""
    context = spark.sparkContext
    path = _package(context.applicationId)
    if Path(path).name not in context._python_includes:
        context.addPyFile(path)


def map_arrow(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` with a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
