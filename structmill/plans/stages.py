"""Stages over entries: which depend on which, what is still to do, and marks of what is done."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from structmill.sources import sinks

MARKS = "entry string, stage string, time timestamp"


@dataclass(frozen=True)
class Stage:
    """compute(spark, entries) gives the rows of the entries; keys name the columns that identify an entry's rows."""

    name: str
    compute: Callable[[SparkSession, DataFrame], DataFrame]
    keys: tuple[str, ...]
    needs: tuple[str, ...] = ()
    update_gap: timedelta | None = None
    options: dict = field(default_factory=dict)


REGISTRY: dict[str, Stage] = {}


def register(stage: Stage) -> Stage:
    if stage.name in REGISTRY:
        raise ValueError(f"stage {stage.name} is there already")
    REGISTRY[stage.name] = stage
    return stage


def levels(needs: dict[str, set[str]]) -> list[list[str]]:
    """Names by level of a DAG: each level needs earlier ones only."""
    left = {k: set(v) for k, v in needs.items()}
    for v in needs.values():
        for k in v:
            left.setdefault(k, set())
    out = []
    while left:
        ready = sorted(k for k, v in left.items() if not v)
        if not ready:
            raise ValueError(f"a cycle among {sorted(left)}")
        out.append(ready)
        left = {k: v - set(ready) for k, v in left.items() if k not in ready}
    return out


def order(target: str, stages: dict[str, Stage], skip: tuple[str, ...] = ()) -> list[str]:
    """The target and all that it needs, in an order that respects the needs."""
    wanted, todo = set(), [target]
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += stages[name].needs
    return [n for level in levels({n: set(stages[n].needs) for n in wanted}) for n in level if n not in skip]


def to_process(entries: DataFrame, marks: DataFrame, stage: Stage, now, *, recompute: bool = False) -> DataFrame:
    """Entries without a mark of the stage, or with one older than its update gap."""
    if recompute:
        return entries
    latest = marks.where(F.col("stage") == stage.name).groupBy("entry").agg(F.max("time").alias("time"))
    if stage.update_gap is not None:
        latest = latest.where(F.col("time") >= F.lit(now) - F.lit(stage.update_gap))
    return entries.join(latest, "entry", "left_anti")


def run(spark: SparkSession, target: str, entries: DataFrame, folder: str, now, *, stages: dict[str, Stage] | None = None, recompute: bool = False, dry_run: bool = False, skip: tuple[str, ...] = ()) -> list[str]:
    """Runs the target and what it needs over the entries that are to do; returns the stages that ran.

    A stage's rows of an entry are replaced, then the entry is marked; a run that
    breaks off between the two does the entry again.
    """
    stages = stages or REGISTRY
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = lambda p: files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p))
    ran = []
    for name in order(target, stages, skip):
        stage, table, marks = stages[name], f"{folder}/{name}", f"{folder}/marks"
        known = spark.read.schema(MARKS).parquet(marks) if there(marks) else spark.createDataFrame([], MARKS)
        todo = to_process(entries, known, stage, now, recompute=recompute).persist()
        if not todo.isEmpty():
            rows = stage.compute(spark, todo)
            if dry_run:
                rows.explain("formatted")
            else:
                stored = sinks.current(spark, table)
                kept = None if stored is None else stored.join(todo.withColumnRenamed("entry", stage.keys[0]), stage.keys[0], "left_anti")
                sinks.replace(spark, rows if kept is None else kept.unionByName(rows), table)
                todo.select("entry", F.lit(name).alias("stage"), F.lit(now).cast("timestamp").alias("time")).write.mode("append").parquet(marks)
            ran.append(name)
        todo.unpersist()
    return ran
