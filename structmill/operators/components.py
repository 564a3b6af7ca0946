"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.shared import discard


def connected_components(edges: DataFrame, save: Callable[[DataFrame], DataFrame], most_rounds: int = 60, small_plans: bool = False) -> DataFrame:
    """node, component (its smallest node) of every node of the edges u, v; isolated nodes are self-edges.

    ``save`` cuts the lineage after each round; with ``small_plans`` also before the
    first and within each, so that no step is run, or kept by the driver, twice.
    Each round is a min per node and a join, so a node with very many neighbours is
    no one task's work; the edges never grow in number, and O(log^2) rounds end in stars.
    """
    half = save if small_plans else lambda df: df
    edges = half(edges)
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    now = save(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        start = now
        # large star: a node's larger neighbours move to its smallest
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        now = half(both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())
        middle = now
        # small star: a node and its smaller neighbours move to the smallest of them
        low = now.groupBy("u").agg(F.min("v").alias("m"))
        moved = now.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = save(moved.union(low.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())
        # files of earlier steps go, so that the disk holds one round
        discard(start, middle)
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    root = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(root, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
