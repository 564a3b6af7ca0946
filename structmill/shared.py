"""Tables cut off from their lineage, in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_PATHS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def folder(spark: SparkSession) -> str:
    """Spark's checkpoint folder; where the session names none, a temporary one, on one machine only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; intermediate tables need a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="structmill-"))
    return sc.getCheckpointDir()


def saved(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """``df`` written as Parquet and read again; the files go at ``discard``, or when the driver ends.

    ``batch``: rows of an Arrow batch at most while it is written, for steps whose rows are long.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH)
    if batch:
        spark.conf.set(_BATCH, str(batch))
    try:
        df.write.parquet(path)
    finally:
        if batch:
            spark.conf.set(_BATCH, before)
    atexit.register(_drop, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Deletes the files of saved frames that nothing will read again."""
    for df in frames:
        path = _PATHS.pop(df, None) if df is not None else None
        if path is not None:
            _drop(df.sparkSession, path)


def _drop(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is not None and spark.sparkContext._jsc is not None:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, counted; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def parts_of(table: DataFrame, rows: int = 400_000) -> int:
    """Parts that hold at most about ``rows`` rows of a table each, at least eight, so that a task's memory does not grow with the table."""
    return max(8, -(-table.count() // rows))
