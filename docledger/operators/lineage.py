"""Results that several consumers share, written once."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


#: Where :func:`stored` wrote each frame, or the one it comes from (:func:`read_from`).
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the folder that the cluster names in ``spark.checkpoint.dir``; in local mode, as in tests, where all
    tasks share one host, a temporary folder stands in for it if none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="docledger-")
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the checkpoint folder, out of reach of lost executors.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only in local mode, as in tests, where all tasks
    share one host, a temporary folder stands in for it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context._jsc.sc().isLocal():
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed now, written as Parquet to the checkpoint folder and read again: compressed, by columns."""
    path = fresh_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[read] = path
    return read


def read_from(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, which reads the files of the :func:`stored` frame ``source`` and goes with them."""
    if source in _folders:
        _folders[df] = _folders[source]
    return df


def spent(*frames: DataFrame) -> None:
    """Remove the files of :func:`stored` frames that nothing reads any more; other frames are left as they are."""
    for df in frames:
        path = _folders.pop(df, None)
        if path:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished steps go with the plans that wrote them, once the driver's collector has seen that nothing
    holds those. With much memory it would see that late."""
    spark._jvm.System.gc()
