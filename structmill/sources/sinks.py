"""Sinks: append, upsert, delete, CSV and TSV reports, compressed files, and a dry run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from structmill.operators.relational import upsert


def append(rows: DataFrame, path: str, *, dry_run: bool = False, partition_by: tuple[str, ...] = ()) -> None:
    if dry_run:
        rows.explain("formatted")
        return
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


#: Folder of a table's versions; plain readers of the table pass over it.
_VERSIONS = "_versions"


def _hadoop(spark: SparkSession, path: str):
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), new


def versions(spark: SparkSession, path: str) -> list[str]:
    """Finished versions of a table that ``replace`` writes, oldest first: folders that Spark's committer has marked whole."""
    files, new = _hadoop(spark, path)
    if not files.exists(new(path, _VERSIONS)):
        return []
    found = [s.getPath() for s in files.listStatus(new(path, _VERSIONS)) if s.isDirectory()]
    return sorted(p.toString() for p in found if files.exists(new(p, "_SUCCESS")))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest finished version of the table, or before any the files that ``append`` wrote; None for no table."""
    found = versions(spark, path)
    if found:
        return spark.read.parquet(found[-1])
    files, new = _hadoop(spark, path)
    plain = files.exists(new(path)) and any(s.getPath().getName() != _VERSIONS for s in files.listStatus(new(path)))
    return spark.read.parquet(path) if plain else None


def replace(spark: SparkSession, rows: DataFrame, path: str, keep: int = 2) -> None:
    """Writes a version of its own beside the others; it counts once it is whole, so a crash at any step leaves the one before.

    Unfinished older versions and all but the last ``keep`` go afterwards.
    """
    before = versions(spark, path)
    number = int(before[-1].rsplit("/", 1)[1][:9]) + 1 if before else 0
    rows.write.parquet(f"{path}/{_VERSIONS}/{number:09d}-{uuid.uuid4().hex}")
    files, new = _hadoop(spark, path)
    kept = {new(p).getName() for p in versions(spark, path)[-keep:]}
    for status in files.listStatus(new(path, _VERSIONS)):
        name = status.getPath().getName()
        if name not in kept and int(name[:9]) <= number:
            files.delete(status.getPath(), True)


def merge(spark: SparkSession, rows: DataFrame, path: str, keys: list[str], exists: bool = True) -> None:
    """Upsert by key."""
    stored = current(spark, path) if exists else None
    replace(spark, upsert(stored, rows, keys) if stored is not None else rows, path)


def delete(spark: SparkSession, path: str, gone: DataFrame, keys: list[str]) -> None:
    """Deletes the rows of the keys."""
    replace(spark, current(spark, path).join(gone.select(*keys).distinct(), keys, "left_anti"), path)


def csv(rows: DataFrame, path: str, *, sep: str = ",", quote_all: bool = True, gzip: bool = False, allow_empty: bool = False) -> None:
    if not allow_empty and rows.isEmpty():
        raise ValueError(f"nothing to write to {path}")
    rows.write.csv(path, header=True, sep=sep, quoteAll=quote_all, compression="gzip" if gzip else "none")


def tsv(rows: DataFrame, path: str) -> None:
    csv(rows, path, sep="\t", quote_all=False, allow_empty=True)


def per_entry(rows: DataFrame, path: str, entry: str) -> None:
    """Compressed rows in a folder per entry."""
    rows.repartition(entry).write.partitionBy(entry).csv(path, header=True, compression="gzip")


def nested_export(rows: DataFrame, path: str, key: str, fields: list[str]) -> None:
    """JSON lines of key -> sorted list of records."""
    rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("items")).write.json(path, compression="gzip")
