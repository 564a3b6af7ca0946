"""Entity resolution: match rules, candidate edges, groups, splits, representatives."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.operators.windows import first_of
from structmill.shared import saved

#: Fixed values.
EXACT_CUTOFF, LIMITED_CHANGES, SYNTHETIC, HOMOGENEOUS_SIZE = 19, 80, "32630", 70
DISCREPANCY_CUTOFF, MAX_RESOLUTION = 0.4, 20.0
BP_INCREASE = 0.5  # percent, of pairs and of length


def good_alignment(entity_type: str = "rna") -> Column:
    """1 or 0 of the columns aligned_count, match_count, mismatch_count, min_size, max_size; 5 for dna."""
    if entity_type == "dna":
        return F.lit(5)
    small, matches, mismatches = F.col("min_size"), F.col("match_count"), F.col("mismatch_count")
    ok = (
        F.when(F.col("aligned_count") == 0, False)
        .when(small < EXACT_CUTOFF, (mismatches == 0) & (F.col("max_size") == small))
        .when(small < LIMITED_CHANGES, mismatches <= 4)
        .when(F.col("max_size") > 2 * small, False)
        .otherwise((mismatches == 0) | (matches / small >= 0.95))
    )
    return ok.cast("int")


def species_match(a: Column, b: Column) -> Column:
    """Arrays of tax ids (text) agree: shared, at most one in all, or either has null or the synthetic id."""
    wild = lambda x: F.exists(x, lambda t: t.isNull() | (t == SYNTHETIC))
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False)) | (F.size(F.array_union(a, b)) <= 1) | wild(a) | wild(b)


def acceptable_discrepancy(valid_1: Column, valid_2: Column, known_1: Column, discrepancy: Column) -> Column:
    """Whether a pair's discrepancy allows joining: pairs with an invalid or unmeasured chain pass, measured chains need 0 <= d <= cutoff."""
    return F.when(~(valid_1 & valid_2), True).when(~known_1, True).when(discrepancy.isNull(), False).otherwise(discrepancy.between(0, DISCREPANCY_CUTOFF))


def valid_chain(length: Column, method: Column, resolution: Column) -> Column:
    """Long enough to compare, and well enough resolved (solution structures have no resolution)."""
    return F.coalesce(length >= 3, F.lit(False)) & (F.coalesce(method == "SOLUTION NMR", F.lit(False)) | F.coalesce(resolution <= MAX_RESOLUTION, F.lit(False)))


def split_species(members: DataFrame, group: str, item: str, length: str, species: str) -> DataFrame:
    """Adds ``part``: groups whose longest member reaches HOMOGENEOUS_SIZE split by species.

    Unknown and synthetic members join the group's most frequent species, of ties
    the smallest.  Small groups stay whole (part null).
    """
    known = F.when(F.col(species).isNull() | (F.col(species) == SYNTHETIC), None).otherwise(F.col(species))
    rows = members.withColumn("_s", known)
    counts = rows.where(F.col("_s").isNotNull()).groupBy(group, "_s").agg(F.count("*").alias("_n"))
    main = counts.groupBy(group).agg(F.min_by("_s", F.struct(-F.col("_n"), F.col("_s"))).alias("_main"))
    shape = members.groupBy(group).agg(F.max(length).alias("_longest"), F.count("*").alias("_size"))
    rows = rows.join(shape, group).join(main, group, "left")
    splits = (F.col("_longest") >= HOMOGENEOUS_SIZE) & (F.col("_size") > 1)
    return rows.withColumn("part", F.when(splits, F.coalesce("_s", "_main"))).drop("_s", "_longest", "_size", "_main")


# representatives, by name

REPRESENTATIVES = {}


def representative(name: str):
    def register(function):
        REPRESENTATIVES[name] = function
        return function

    return register


@representative("compscore")
def by_score(members: DataFrame, group: str) -> DataFrame:
    """Least cqs2."""
    return first_of(members, [group], [F.col("cqs2").asc_nulls_last(), F.col("id")])


@representative("naive")
def by_structure(members: DataFrame, group: str) -> DataFrame:
    """Largest (bp / length, -resolution, id); the ratio is 0 when either is 0."""
    ratio = F.when((F.col("bp") == 0) | (F.col("length") == 0), 0.0).otherwise(F.col("bp") / F.col("length"))
    return first_of(members, [group], [ratio.desc(), F.col("resolution").asc_nulls_last(), F.col("id").desc()])


@representative("quality-metrics")
def by_metrics(members: DataFrame, group: str) -> DataFrame:
    """X-ray members up to 4.0 with all metrics (else all), of at least 75 % of the longest, within 0.2 of the best resolution; of these the least
    rsrz * clashscore * backbone * resolution ^ 4 / (length + bp), a metric that is missing or 0 standing at 100, 500 and 100."""
    w = Window.partitionBy(group)
    has = lambda c: F.coalesce(F.col(c) != 0, F.lit(False))
    good = F.coalesce((F.col("method") == "X-RAY DIFFRACTION") & (F.col("resolution") <= 4.0), F.lit(False)) & has("rsrz") & has("backbone") & has("clashscore")
    rows = members.withColumn("_good", good).withColumn("_any", F.max("_good").over(w)).where("_good = _any")
    rows = rows.withColumn("_l", F.max("length").over(w)).where("length >= 0.75 * _l")
    rows = rows.withColumn("_r", F.min("resolution").over(w)).where("_r is null or abs(resolution - _r) <= 0.2")
    metric = lambda c, default: F.when(has(c), F.col(c)).otherwise(F.lit(default))
    r = F.col("resolution")
    score = metric("rsrz", 100.0) * metric("clashscore", 500.0) * metric("backbone", 100.0) * (r * r * r * r) / (F.col("length") + F.col("bp"))
    return first_of(rows, [group], [score.asc_nulls_last(), F.col("id")]).drop("_good", "_any", "_l", "_r")


def _climb(members: DataFrame, group: str, cutoff: float, start: DataFrame | None = None) -> DataFrame:
    """From ``start`` (group, id; the naive one where it has none), moves again and again to the first member in naive order that has at least as many pairs and as
    great a length, not both equal, and increases of at least ``cutoff`` percent in both, until no group moves.

    Every round is a join by group and an aggregate over the groups that moved in the last one; each move raises pairs or length.
    """
    rows = members
    if "method" in members.columns:
        rows = rows.withColumn("_ok", F.coalesce(F.col("method") == "X-RAY DIFFRACTION", F.lit(False)))
        rows = rows.withColumn("_any", F.max("_ok").over(Window.partitionBy(group))).where("_ok = _any").drop("_ok", "_any")
    ratio = F.when((F.col("bp") == 0) | (F.col("length") == 0), 0.0).otherwise(F.col("bp") / F.col("length"))
    place = F.struct(ratio.alias("ratio"), F.coalesce(-F.col("resolution"), F.lit(float("-inf"))).alias("res"), F.col("id").alias("id"), F.col("bp").alias("bp"), F.col("length").alias("length"))
    rows = saved(rows.select(F.col(group).alias("_g"), place.alias("place")), "members")
    now = rows.groupBy("_g").agg(F.max("place").alias("at"))
    if start is not None:
        chosen = rows.join(start.select(F.col(group).alias("_g"), F.col("id").alias("_id")), "_g").where("place.id = _id").select("_g", F.col("place").alias("chosen"))
        now = now.join(chosen, "_g", "left").select("_g", F.coalesce("chosen", "at").alias("at"))
    now = moving = saved(now, "now")
    while True:
        grown = lambda c: F.when(F.col(f"at.{c}") == 0, F.when(F.col(f"place.{c}") == 0, 0.0).otherwise(100.0)).otherwise((F.col(f"place.{c}").cast("double") / F.col(f"at.{c}") - 1) * 100)
        larger = (F.col("place.bp") >= F.col("at.bp")) & (F.col("place.length") >= F.col("at.length")) & ((F.col("place.bp") != F.col("at.bp")) | (F.col("place.length") != F.col("at.length")))
        better = rows.join(moving, "_g").where(larger & (grown("length") >= cutoff) & (grown("bp") >= cutoff))
        moving = saved(better.groupBy("_g").agg(F.max("place").alias("at")), "moving")
        if moving.isEmpty():
            break
        now = saved(now.join(moving.select("_g"), "_g", "left_anti").unionByName(moving), "now")
    return members.join(now.select(F.col("_g").alias(group), F.col("at.id").alias("id")), [group, "id"], "left_semi")


@representative("percent-increase")
def by_increase(members: DataFrame, group: str) -> DataFrame:
    """The naive one, moved on while both increases reach 0.5 %."""
    return _climb(members, group, BP_INCREASE)


@representative("any-increase")
def by_any_increase(members: DataFrame, group: str) -> DataFrame:
    return _climb(members, group, 0.0)


def by_parent_increase(members: DataFrame, group: str, parents: DataFrame) -> DataFrame:
    """As by_increase, from the representative of a group's only parent if it is a member; ``parents``: group, id, one row a parent."""
    single = parents.groupBy(group).agg(F.count("*").alias("_n"), F.first("id").alias("id")).where("_n = 1")
    return _climb(members, group, BP_INCREASE, single.select(group, "id"))


def percent_increase(initial: Column, current: Column) -> Column:
    return F.when(initial == 0, F.when(current == 0, 0.0).otherwise(100.0)).otherwise((current.cast("double") / initial - 1) * 100)


def hits_kept(hits: DataFrame, chain: str, score: str, start: str, end: str, most_overlap: int = 10) -> DataFrame:
    """Per chain, hits by descending score that overlap each kept one by fewer than ``most_overlap`` positions."""

    def keep(rows: pd.DataFrame) -> pd.DataFrame:
        chosen: list[int] = []
        rows = rows.sort_values([score, start, end], ascending=[False, True, True]).reset_index(drop=True)
        for i, r in rows.iterrows():
            if all(min(r[end], rows.at[j, end]) - max(r[start], rows.at[j, start]) + 1 < most_overlap for j in chosen):
                chosen.append(i)
        return rows.loc[chosen]

    return hits.groupBy(chain).applyInPandas(keep, hits.schema)
