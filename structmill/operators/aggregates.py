"""Grouped summaries: counts by label, defaults, consensus, best of group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_sorted(value: str, order: str, separator: str) -> Column:
    """GROUP_CONCAT with a stated order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), separator)


def count_labels(rows: DataFrame, by: str, label: str, labels: list[str], long_range: Column) -> DataFrame:
    """One column per label, ``total``, and the same for long-range rows (lr_*), in one pass."""
    each = [F.count_if(F.col(label) == x).alias(x) for x in labels] + [F.count_if((F.col(label) == x) & long_range).alias(f"lr_{x}") for x in labels]
    return rows.groupBy(by).agg(*each, F.count("*").alias("total"), F.count_if(long_range).alias("lr_total"))


def mean_or(value: str, default: float) -> Column:
    """Mean that ignores null, and a default without any value."""
    return F.coalesce(F.avg(value), F.lit(default))


def pair_count_matrix(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, n of pairs stored in both directions; a side with itself counts half."""
    return pairs.groupBy(a, b).agg(F.count("*").alias("n")).withColumn("n", F.when(F.col(a) == F.col(b), F.col("n") / 2).otherwise(F.col("n").cast("double")))


def pick_preferred(rows: DataFrame, key: str, value: str, preferences: list[str]) -> DataFrame:
    """key, value: the first preference that is present, else the smallest value."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, preferences)), F.col(value)), F.lit(0)), F.lit(len(preferences) + 1))
    return rows.where(F.col(value).isNotNull()).groupBy(key).agg(F.min_by(value, F.struct(rank, F.col(value))).alias(value))


def most_frequent(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, value, n: the most frequent value, of ties the smallest."""
    counts = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col(value))).alias("_m")).select(key, f"_m.{value}", "_m.n")


def majority_mapping(rows: DataFrame, query: str, target: str, least_share: float) -> DataFrame:
    """query, target, n, share: the most frequent target if its share of the query's rows reaches the threshold."""
    total = rows.groupBy(query).agg(F.count("*").alias("_all"))
    best = most_frequent(rows, query, target).join(total, query).withColumn("share", F.col("n") / F.col("_all"))
    return best.where(F.col("share") >= least_share).drop("_all")


def consensus_vote(rows: DataFrame, item: str, true: Column, near: Column, instances: DataFrame) -> DataFrame:
    """Items voted for: 6 * true + 4 * near > 3 * instances (one row with column n)."""
    votes = rows.groupBy(item).agg(F.count_if(true).alias("true_votes"), F.count_if(near).alias("near_votes"))
    return votes.crossJoin(F.broadcast(instances)).where("6 * true_votes + 4 * near_votes > 3 * n").drop("n")


#: IUPAC codes of sets of bases.
IUPAC = {"A": "A", "C": "C", "G": "G", "U": "U", "AC": "M", "AG": "R", "AU": "W", "CG": "S", "CU": "Y", "GU": "K", "ACG": "V", "ACU": "H", "AGU": "D", "CGU": "B", "ACGU": "N"}


def iupac(base: str) -> Column:
    """The code of the set of a group's bases (A, C, G, U; others are ignored)."""
    found = F.array_join(F.array_sort(F.collect_set(F.when(F.col(base).isin("A", "C", "G", "U"), F.col(base)))), "")
    return F.create_map(*[F.lit(x) for kv in IUPAC.items() for x in kv])[found]


def alignment_summary(positions: DataFrame, by: str, unit_1: str, unit_2: str) -> DataFrame:
    """Counts of an alignment's columns; a null side is a gap, and a gap is a mismatch too."""
    a, b = F.col(unit_1), F.col(unit_2)
    return positions.groupBy(by).agg(
        F.count("*").alias("length"),
        F.count_if(a.isNotNull() & b.isNotNull()).alias("aligned_count"),
        F.count_if(a == b).alias("match_count"),
        F.count_if(a.isNull() | b.isNull() | (a != b)).alias("mismatch_count"),
        F.count_if(a.isNull()).alias("first_gap_count"),
        F.count_if(b.isNull()).alias("second_gap_count"),
    )


def distance_to_groups(distances: DataFrame, item: str, group: str, value: str) -> DataFrame:
    """Largest and mean distance of items to groups; null as soon as one distance is missing."""
    whole = F.bool_and(F.col(value).isNotNull())
    return distances.groupBy(item, group).agg(F.when(whole, F.max(value)).alias("max_distance"), F.when(whole, F.avg(value)).alias("mean_distance"))


def centroids(distances: DataFrame, group: str, item: str, value: str) -> DataFrame:
    """group, item: the member with the least sum of distances to the others, of ties the smallest."""
    sums = distances.groupBy(group, item).agg(F.sum(value).alias("_sum"))
    return sums.groupBy(group).agg(F.min_by(item, F.struct(F.round("_sum", 6), F.col(item))).alias(item))


def bucket_lists(rows: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """by, items: each group's rows as a sorted array of structs (export shape)."""
    return rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("items"))


def melt_labels(rows: DataFrame, ids: list[str], labels: list[str]) -> DataFrame:
    """Wide label columns to rows (ids, category, label); null labels go."""
    return rows.unpivot(ids, labels, "category", "label").where(F.col("label").isNotNull())
