"""Names carried from release to release, and counts of what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least share of the larger group for a name to be kept.
SIZE_CUTOFF = 2.0 / 3.0


def named(members: DataFrame, parents: DataFrame) -> DataFrame:
    """group, handle, version, kind (exact, updated, new), n_parents of each group of the new release.

    members: group, member; parents: name_handle, name_version, member.  Equal
    members keep handle and version if there is one parent; else the parent of the largest
    share (of ties the smallest handle) gives its handle with the next version if
    the share is at least 2/3; other groups get a new handle, a hash of their
    members, with version 1.
    """
    sizes = members.groupBy("group").agg(F.count_distinct("member").alias("n"), F.md5(F.concat_ws(",", F.array_sort(F.collect_set("member")))).alias("hash"))
    old = parents.groupBy("name_handle", "name_version").agg(F.count_distinct("member").alias("old_n"))
    common = members.distinct().join(parents.distinct(), "member").groupBy("group", "name_handle", "name_version").agg(F.count("*").alias("common"))
    common = common.join(old, ["name_handle", "name_version"]).join(sizes.select("group", "n"), "group")
    common = common.withColumn("share", F.col("common") / F.greatest("n", "old_n"))
    best = common.groupBy("group").agg(F.count("*").alias("n_parents"), F.min_by(F.struct("name_handle", "name_version", "share"), F.struct(-F.col("share"), F.col("name_handle"), F.col("name_version"))).alias("p"))
    out = sizes.join(best, "group", "left").withColumn("n_parents", F.coalesce("n_parents", F.lit(0).cast("long")))
    exact = (F.col("n_parents") == 1) & (F.col("p.share") == 1)
    kept = F.coalesce(F.col("p.share") >= SIZE_CUTOFF, F.lit(False))
    return out.select(
        "group",
        F.when(kept, F.col("p.name_handle")).otherwise(F.substring("hash", 1, 8)).alias("handle"),
        F.when(exact, F.col("p.name_version")).when(kept, F.col("p.name_version") + 1).otherwise(1).alias("version"),
        F.when(exact, "exact").when(kept, "updated").otherwise("new").alias("kind"),
        "n_parents",
    )


def parent_edges(members: DataFrame, parents: DataFrame) -> DataFrame:
    """group, name_handle, name_version: one row for each overlapping parent."""
    return members.join(parents, "member").select("group", "name_handle", "name_version").distinct()


def group_changes(new: DataFrame, old: DataFrame) -> DataFrame:
    """added, removed, updated, unchanged counts of (handle, version) names."""
    a, b = new.select("handle", "version").distinct(), old.select("handle", F.col("version").alias("old_version"), F.lit(True).alias("was")).distinct()
    joined = a.withColumn("is", F.lit(True)).join(b, "handle", "full")
    per = joined.groupBy("handle", "version").agg(F.bool_or("is").alias("is"), F.bool_or("was").alias("was"), F.bool_or(F.col("version") == F.col("old_version")).alias("same"))
    is_new, was = F.coalesce("is", F.lit(False)), F.coalesce("was", F.lit(False))
    same = F.coalesce("same", F.lit(False))
    return per.agg(F.count_if(is_new & ~was).alias("added"), F.count_if(~is_new).alias("removed"), F.count_if(is_new & was & ~same).alias("updated"), F.count_if(is_new & same).alias("unchanged"))


def set_changes(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """added, removed, unchanged counts of a key."""
    a, b = new.select(key).distinct().withColumn("is", F.lit(1)), old.select(key).distinct().withColumn("was", F.lit(1))
    return a.join(b, key, "full").agg(F.count_if(F.col("was").isNull()).alias("added"), F.count_if(F.col("is").isNull()).alias("removed"), F.count_if(F.col("is") == F.col("was")).alias("unchanged"))


def next_release(release: str, mode: str) -> str:
    """major.minor after a step of the mode (major, minor or none)."""
    major, minor = map(int, release.split("."))
    return {"major": f"{major + 1}.0", "minor": f"{major}.{minor + 1}", "none": f"{major}.{minor}"}[mode]
