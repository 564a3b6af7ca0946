"""Saved tables, and rows with a key of their own whatever their columns are called."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.shared import discard, folder, saved, small

__all__ = ["discard", "folder", "keyed_rows", "saved", "short_batches", "small"]
#: Settings of Arrow batches, Spark's defaults, and what texts are given instead: rows and bytes.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16m")}


def short_batches(df: DataFrame) -> DataFrame:
    """``df``; its session, where it has no settings of its own, makes Arrow batches of at most 1000 rows and 16 MB (or one longer row) from now on, as texts are long."""
    for name, (default, instead) in _BATCHES.items():
        if df.sparkSession.conf.get(name) == default:
            df.sparkSession.conf.set(name, instead)
    return df


def keyed_rows(docs: DataFrame, *named: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Saved rows with a key ``row``, the columns ``named`` under their names, and all columns as c0, c1, ...; and what turns such rows back into those of ``docs``."""
    names = docs.columns
    places = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own = [F.col(f"c{names.index(n)}").alias(n) for n in named]
    stored = saved(places.withColumn("row", F.monotonically_increasing_id()), "rows")
    return stored.select("row", *own, *places.columns), lambda df: df.select(*places.columns).toDF(*names)
