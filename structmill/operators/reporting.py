"""Reports over units, loops and interactions: pairings of a chain, quality of loops, interactions carried over a mapping, units by index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.operators.relational import assert_none

#: Fixed values.
STATUS_NAMES = {1: "Valid", 2: "Chain Breaks", 3: "Has Modifications", 4: "Too Many Chains", 5: "Incomplete Nucleotides", 6: "Complementary Sequence", 7: "Too Many Symmetries", 8: "RSRZ Outliers"}
KINDS = ("pairs", "stacks", "basephosphate")
PSEUDOKNOT = 4


def pairing(positions: DataFrame, pairs: DataFrame, chain: str, remove_pseudoknots: bool = False) -> DataFrame:
    """chain, index_1, unit_1, observed, index_2, unit_2: every position of a chain (index from 1, its letter) and its partner's, null without one.

    ``positions``: chain, index (from 0), letter, unit (null: not observed); ``pairs``: chain, unit_1, unit_2, label, crossing.  Only cWW pairs
    of two units of the chain count; of several partners the one of the last position.
    """
    wanted = pairs.where("label = 'cWW'")
    if remove_pseudoknots:
        wanted = wanted.where(F.col("crossing") < PSEUDOKNOT)
    other = positions.where("unit IS NOT NULL").select(chain, F.col("unit").alias("unit_2"), F.struct("index", "letter").alias("other"))
    found = wanted.join(other, [chain, "unit_2"]).groupBy(chain, F.col("unit_1").alias("unit")).agg(F.max("other").alias("other"))
    rows = positions.join(found, [chain, "unit"], "left")
    return rows.select(chain, (F.col("index") + 1).alias("index_1"), F.col("letter").alias("unit_1"), F.col("unit").isNotNull().cast("int").alias("observed"), (F.col("other.index") + 1).alias("index_2"), F.col("other.letter").alias("unit_2"))


def interaction_sets(interactions: DataFrame) -> DataFrame:
    """unit, kind, partner: distinct partners by the labels in the columns of ``KINDS``; near ones (n...) and a unit's own 0BPh are left out."""
    each = interactions.select("unit_1", "unit_2", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("label")) for k in KINDS])).alias("x"))
    own = (F.col("unit_1") == F.col("unit_2")) & (F.col("x.kind") == "basephosphate") & F.col("x.label").contains("0BPh")
    kept = each.where(F.col("x.label").isNotNull() & (F.col("x.label") != "") & ~F.col("x.label").startswith("n") & ~own)
    # dealt by unit, as what joins them asks, so that they are shuffled once
    return kept.select(F.col("unit_1").alias("unit"), "x.kind", F.col("unit_2").alias("partner")).repartition("unit").distinct()


def loop_quality(loops: DataFrame, positions: DataFrame, statuses: DataFrame, motifs: DataFrame, quality: DataFrame, interactions: DataFrame) -> DataFrame:
    """A row for each unit of each loop with a status: loop, type, motif, unit, status, rsr, rsrz, and its interactions of each kind within the loop and beyond.

    ``loops``: loop, type; ``positions``: loop, unit; ``statuses``: loop, status; ``motifs``: loop, motif; ``quality``: unit, rsr, rsrz.
    An unknown status is null.
    """
    members = positions.distinct()
    sets = interaction_sets(interactions)
    inside = members.select("loop", F.col("unit").alias("partner"), F.lit(True).alias("inside"))
    met = members.join(sets, "unit").join(inside, ["loop", "partner"], "left")
    counts = [F.count_if((F.col("kind") == k) & (F.col("inside").isNotNull() if here else F.col("inside").isNull())).alias(f"{side}_{k}") for side, here in (("internal", True), ("external", False)) for k in KINDS]
    names = [f"{side}_{k}" for side in ("internal", "external") for k in KINDS]
    found = met.groupBy("loop", "unit").agg(*counts)
    status = F.element_at(F.create_map(*[F.lit(x) for kv in STATUS_NAMES.items() for x in kv]), F.col("status"))
    # what a loop has in common joins last, so that it is not shuffled with its units
    rows = positions.join(found, ["loop", "unit"], "left").join(quality, "unit", "left").join(loops, "loop").join(statuses, "loop").join(motifs, "loop", "left")
    rows = rows.withColumns({n: F.coalesce(n, F.lit(0)).cast("long") for n in names}).withColumn("status", status)
    total = lambda side: sum((F.col(f"{side}_{k}") for k in KINDS[1:]), F.col(f"{side}_{KINDS[0]}"))
    return rows.select("loop", "type", "motif", "unit", "status", "rsr", "rsrz", *names, total("internal").alias("internal_interactions"), total("external").alias("external_interactions"), (total("internal") + total("external")).alias("total_interactions"))


def interaction_correspondence(first: DataFrame, second: DataFrame, mapping: DataFrame, correspondence: str) -> DataFrame:
    """correspondence, id_1, id_2: every interaction of the first structure, and the second's between the units that map onto its own, null without one.

    ``first``, ``second``: correspondence, id, unit_1, unit_2; ``mapping``: correspondence, from (a unit of the second), to.  Of several the last id.
    """
    side = lambda k: mapping.select(correspondence, F.col("from").alias(f"unit_{k}"), F.col("to").alias(f"to_{k}"))
    carried = second.join(side(1), [correspondence, "unit_1"]).join(side(2), [correspondence, "unit_2"])
    known = carried.groupBy(correspondence, F.col("to_1").alias("unit_1"), F.col("to_2").alias("unit_2")).agg(F.max("id").alias("id_2"))
    return first.withColumnRenamed("id", "id_1").join(known, [correspondence, "unit_1", "unit_2"], "left").select(correspondence, "id_1", "id_2")


def units_by_index(units: DataFrame, positions: DataFrame, chain: str) -> DataFrame:
    """chain, unit, position: units at their index in the chain (from 1) and the sequence position at theirs (from 0); a unit without a position is an error.

    ``units``: chain, unit, chain_index (null: left out); ``positions``: chain, index, position.
    """
    indexed = units.where("chain_index IS NOT NULL").withColumn("index", F.col("chain_index") - 1)
    assert_none(indexed.join(positions, [chain, "index"], "left_anti"), "no position for")
    return indexed.join(positions, [chain, "index"]).select(chain, "unit", "position")
