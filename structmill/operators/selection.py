"""Which loops are clustered, and tables of loops and discrepancies for export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.shared import small

#: Statuses of usable loops, internal loops of at most so many units are broken chains, fields of a unit id with a symmetry, its default, and the fields that name a unit without it.
USABLE, SHORTEST_INTERNAL, FULL_FIELDS, NO_SYMMETRY, NAME_FIELDS = (1, 3), 4, 9, "P_1", 5


def select_loops(loops: DataFrame, positions: DataFrame, statuses: DataFrame, exclude: DataFrame | None = None, size_limit: int | None = None) -> DataFrame:
    """loop, kind, position, border, unit of the loops to cluster.

    ``loops``: loop, kind (HL, IL, J3, ...), length, deprecated; ``positions``: loop, position (from 1), border (0 or 1), unit; ``statuses``:
    loop, status; ``exclude``: loop.  A loop is left out if it has too few border units for its kind's strands, if all its units have
    one symmetry other than the identity, or if a loop before it (fewer fields in its first unit's id, then the smaller id) has the same units
    but for symmetry.  Of several units at a position the greatest stays; all count as borders.
    """
    usable = statuses.where(F.col("status").isin(*USABLE)).select("loop").distinct()
    kept = loops.where("NOT deprecated").where((F.col("kind") != "IL") | (F.col("length") > SHORTEST_INTERNAL)).join(usable, "loop", "left_semi")
    if size_limit is not None:
        kept = kept.where(F.col("length") < size_limit)
    if exclude is not None:
        kept = kept.join(exclude.select("loop"), "loop", "left_anti")
    strands = F.when(F.col("kind") == "HL", 1).when(F.col("kind") == "IL", 2).otherwise(F.substring("kind", 2, 9).try_cast("int"))
    rows = positions.distinct().join(kept.select("loop", "kind", (2 * strands).alias("needed")), "loop")
    at = rows.groupBy("loop", "kind", "needed", "position").agg(F.max(F.struct("unit", "border")).alias("x"), F.sum("border").alias("borders")).select("loop", "kind", "needed", "position", "borders", "x.unit", "x.border")
    fields = F.split("unit", r"\|")
    symmetry = F.when(F.size(fields) >= FULL_FIELDS, fields[FULL_FIELDS - 1])
    name = F.array_join(F.slice(fields, 1, NAME_FIELDS), "|")
    # the units of one loop
    each = at.groupBy("loop").agg(
        (F.sum("borders") >= F.first("needed")).alias("bordered"),
        F.count_if(symmetry.isNull()).alias("plain"),
        F.count_distinct(symmetry).alias("symmetries"),
        F.min(symmetry).alias("symmetry"),
        F.array_join(F.array_sort(F.collect_list(name)), ",").alias("units"),
        F.max(F.when(F.col("position") == 1, F.size(fields))).alias("first"),
    )
    turned = (F.col("plain") == 0) & (F.col("symmetries") == 1) & (F.col("symmetry") != NO_SYMMETRY)
    good = each.where(F.col("bordered") & ~turned)
    # loops without a first position are compared with none
    first = good.where("first IS NOT NULL").groupBy("units").agg(F.min(F.struct("first", "loop")).getField("loop").alias("loop")).select("loop")
    chosen = first.unionByName(good.where("first IS NULL").select("loop"))
    return at.join(chosen, "loop", "left_semi").select("loop", "kind", "position", "border", "unit")


def loops_table(loops: DataFrame, motifs: DataFrame, release: str) -> DataFrame:
    """id, entry, units (joined by commas in their order) and motif of the release (null without one) of every loop.

    ``loops``: loop, entry, units (array); ``motifs``: loop, release, motif.
    """
    current = motifs.where(F.col("release") == release).select("loop", "motif")
    return loops.join(current, "loop", "left").select(F.col("loop").alias("id"), "entry", F.array_join("units", ",").alias("units"), "motif")


def discrepancy_table(similarities: DataFrame, element_chains: DataFrame, once: bool = False) -> DataFrame:
    """element_1, element_2, discrepancy of each pair of elements by their first chains, once and without an element's own.

    ``similarities``: chain_1, chain_2, discrepancy, which with ``once`` lists no pair twice; ``element_chains``: element, chain, index.
    """
    first = small(element_chains.where("index = 0").select("chain", "element").distinct(), 500_000)
    side = lambda k: first.select(F.col("chain").alias(f"chain_{k}"), F.col("element").alias(f"element_{k}"))
    found = similarities.where("chain_1 < chain_2").join(side(1), "chain_1").join(side(2), "chain_2").select("element_1", "element_2", "discrepancy")
    return found if once else found.distinct()
