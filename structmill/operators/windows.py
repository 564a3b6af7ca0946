"""Ordered operators: ranks, gaps, running parity, next ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ranked(rows: DataFrame, group: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the place in the group's order, from 0."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)


def first_of(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    return ranked(rows, group, order, "_place").where("_place = 0").drop("_place")


def at_cutoffs(members: DataFrame, group: str, value: str, rank: str, cutoffs: list[tuple[str, float | None]]) -> DataFrame:
    """Members of each cutoff with their rank counted anew; a null bound ('all') lets null values in.

    Members are ordered once; each is repeated for the cutoffs that let it in.
    """
    table = F.array(*[F.struct(F.lit(name).alias("cutoff"), F.lit(bound).cast("double").alias("bound")) for name, bound in cutoffs])
    each = members.select("*", F.inline(table)).where(F.col("bound").isNull() | (F.col(value) <= F.col("bound"))).drop("bound")
    return each.withColumn(rank, F.row_number().over(Window.partitionBy(group, "cutoff").orderBy(rank)) - 1)


def latest_rank_earliest_id(rows: DataFrame, key: list[str], order: str, rank: str, ident: str) -> DataFrame:
    """key, rank of the last row and id of the first, by order."""
    return rows.groupBy(*key).agg(F.max_by(rank, order).alias(rank), F.min_by(ident, order).alias(ident))


def breaks(units: DataFrame, group: list[str], index: str, border: str, most_gap: int = 1) -> DataFrame:
    """Units whose predecessor in the same strand is more than ``most_gap`` positions away or equal.

    Borders come in pairs, so an odd number of borders up to a unit means that it
    lies within a strand; the gap between two strands is no break.
    """
    w = Window.partitionBy(*group).orderBy(index)
    inside = F.sum(F.col(border).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)) % 2 == 1
    gap = F.col(index) - F.lag(index).over(w)
    return units.withColumn("gap", gap).withColumn("inside", F.coalesce(inside, F.lit(False))).where(F.col("inside") & ((F.col("gap") > most_gap) | (F.col("gap") == 0))).drop("inside")


def strands(units: DataFrame, group: list[str], index: str, border: str) -> DataFrame:
    """Adds the strand number, from 0: a strand runs from an odd border to the next even one."""
    w = Window.partitionBy(*group).orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(F.col(border).cast("int")).over(w)
    return units.withColumn("strand", F.floor((upto - F.col(border).cast("int")) / 2).cast("int"))


def repeated_neighbours(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value equals the one before."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("_before", F.lag(value).over(w)).where(F.col(value) == F.col("_before")).drop("_before")


def next_ids(new: DataFrame, known: DataFrame, kind: str, ident: str, order: list[str]) -> DataFrame:
    """Adds ids that go on from the largest known one of the kind."""
    largest = known.groupBy(kind).agg(F.max(ident).alias("_last"))
    place = F.row_number().over(Window.partitionBy(kind).orderBy(*order))
    return new.join(largest, kind, "left").withColumn(ident, F.coalesce("_last", F.lit(0)) + place).drop("_last")


def fraction_of_best(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Adds 1 - value / largest of the group; 1 where the largest is 0."""
    top = F.max(value).over(Window.partitionBy(group))
    return rows.withColumn(name, F.when(top == 0, 1.0).otherwise(1 - F.col(value) / top))
