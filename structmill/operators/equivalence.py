"""Equivalence classes of chains: edges by species, alignment and discrepancy, components, species splits and ranks.

Two chains are equivalent when their sequences align well, their species do not
conflict, and their discrepancy allows it: a pair with a chain that cannot be
measured passes; two measurable chains need a discrepancy within the cutoff,
unless the first of them (by id) has none at all.

No product of the chains of two sequences is built, nor of the sequences of a set
that all align with each other.  Measured pairs come from the table of discrepancies.  Where a chain joins all (later) chains of an aligned
sequence whose species agrees, it is joined to one of them, and each of those to
one such chain: the components are the same, and the edges grow with chains times
their sequence's alignments, however many chains share a sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.operators.components import connected_components
from structmill.operators.resolve import DISCREPANCY_CUTOFF, SYNTHETIC, split_species, valid_chain
from structmill.shared import saved


def agreeing_species(a: Column, b: Column) -> Column:
    """One species, or either unknown or synthetic."""
    wild = lambda s: s.isNull() | (s == SYNTHETIC)
    return wild(a) | wild(b) | F.coalesce(a == b, F.lit(False))


def measured_edges(chains: DataFrame, aligned: DataFrame, discrepancies: DataFrame, alike: DataFrame | None = None) -> DataFrame:
    """u, v of two measurable chains of aligned sequences whose discrepancy is within the cutoff."""
    side = lambda n: chains.where("valid").select(F.col("id").alias(f"id_{n}"), F.col("seq").alias(f"seq_{n}"), F.col("species").alias(f"species_{n}"))
    near = discrepancies.where(F.col("discrepancy").between(0, DISCREPANCY_CUTOFF)).select("id_1", "id_2")
    pairs = near.join(side(1), "id_1").join(side(2), "id_2").where(agreeing_species(F.col("species_1"), F.col("species_2")))
    found = pairs.join(aligned, ["seq_1", "seq_2"], "left_semi")
    if alike is not None:
        apart = pairs.where("seq_1 <> seq_2")
        member = lambda n: alike.select("set", F.col("seq").alias(f"seq_{n}"))
        found = found.unionByName(apart.join(member(1), "seq_1").join(member(2), ["set", "seq_2"], "left_semi").select(*found.columns))
    return found.select(F.col("id_1").alias("u"), F.col("id_2").alias("v"))


def open_edges(joining: DataFrame, others: DataFrame, aligned: DataFrame, later: bool) -> DataFrame:
    """u, v that connect what joining each of ``joining`` to all ``others`` (only those of greater id, if ``later``) of aligned sequences and agreeing species connects."""
    wild = F.col("species").isNull() | (F.col("species") == SYNTHETIC)
    own = F.concat(F.lit("="), "species")
    #: Kinds that a chain belongs to, and kinds of the other side that it meets.
    of = F.array(F.lit("all"), F.when(wild, F.lit("wild")).otherwise(own))
    meets = F.when(wild, F.array(F.lit("all"), F.lit("wild"))).otherwise(F.array(own, F.lit("wild")))
    kinds = lambda df, c: df.select("id", "seq", F.explode(c).alias("kind"))
    last = kinds(others, of).groupBy(F.col("seq").alias("seq_2"), "kind").agg(F.max("id").alias("v"))
    first = kinds(joining, of).groupBy(F.col("seq").alias("seq_1"), "kind").agg(F.min("id").alias("u"))
    ahead = kinds(joining, meets).withColumnsRenamed({"id": "u", "seq": "seq_1"}).join(aligned, "seq_1").join(last, ["seq_2", "kind"])
    back = kinds(others, meets).withColumnsRenamed({"id": "v", "seq": "seq_2"}).join(aligned, "seq_2").join(first, ["seq_1", "kind"])
    edges = ahead.select("u", "v").unionByName(back.select("u", "v"))
    return edges.where("u < v" if later else "u <> v")


def set_edges(chains: DataFrame, alike: DataFrame, later: bool) -> DataFrame:
    """u, v that connect what joining each asking chain to all others of the other sequences of its sets connects.

    ``chains``: id, seq, species, valid, known; ``alike``: set, seq, each once.  Chains that are not valid ask all others; with ``later`` valid ones that
    are not known ask the valid ones of greater id.  By set and kind (unknown or synthetic species ask all, others ask these and their
    own) the two least asking and the two greatest asked chains of different sequences stand for all: a sequence's first asking
    and last asked chain is joined to those that are not its own, in every set; its other chains to the furthest of these.
    """
    wild = F.col("species").isNull() | (F.col("species") == SYNTHETIC)
    own = F.concat(F.lit("="), "species")
    asks = F.when(wild, F.array(F.lit("all"))).otherwise(F.array(F.lit("wild"), own))
    asked = F.when(wild, F.array(F.lit("all"), F.lit("wild"))).otherwise(F.array(F.lit("all"), own))
    side = lambda when, order, kinds, asking: F.when(when, F.transform(kinds, lambda k: F.struct(F.lit(order).alias("later"), k.alias("kind"), F.lit(asking).alias("asks")))).otherwise(F.array())
    sides = [side(~F.col("valid"), False, asks, True), side(F.lit(True), False, asked, False)]
    if later:
        sides += [side(F.col("valid") & F.col("known").isNull(), True, asks, True), side(F.col("valid"), True, asked, False)]
    each = chains.select("id", "seq", F.explode(F.concat(*sides)).alias("x")).select("id", "seq", "x.*")
    ends = each.groupBy("seq", "later", "kind").agg(F.min(F.when(F.col("asks"), F.col("id"))).alias("u"), F.max(F.when(~F.col("asks"), F.col("id"))).alias("v"))
    w = Window.partitionBy("set", "later", "kind")
    rows = alike.join(ends, "seq")
    for c, furthest in (("u", F.min), ("v", F.max)):
        row = F.struct(F.col(c).alias("id"), "seq")
        rows = rows.withColumn(f"{c}1", furthest(F.when(F.col(c).isNotNull(), row)).over(w))
        rows = rows.withColumn(f"{c}2", furthest(F.when(F.col(c).isNotNull() & (F.col("seq") != F.col(f"{c}1.seq")), row)).over(w))
    rows = rows.where("u1 IS NOT NULL AND v1 IS NOT NULL")
    joins = lambda u, v: u.isNotNull() & v.isNotNull() & (~F.col("later") | (u < v))
    # where the four that stand for all are not connected by themselves, chains of third sequences connect them
    linked = sum(F.coalesce(((F.col(f"{u}.seq") != F.col(f"{v}.seq")) & joins(F.col(f"{u}.id"), F.col(f"{v}.id"))).cast("int"), F.lit(0)) for u in ("u1", "u2") for v in ("v1", "v2"))
    not_own = lambda c: F.when(F.col(c)["seq"] != F.col("seq"), F.col(c)["id"])
    stands = F.coalesce((F.col("seq") == F.col("u1.seq")) | (F.col("seq") == F.col("u2.seq")), F.lit(False))
    for c in ("u", "v"):
        rows = rows.withColumn(f"{c}_far", F.coalesce(not_own(f"{c}1"), not_own(f"{c}2")))
        rows = rows.withColumn(f"{c}_next", F.when((linked < 3) | (stands & F.lit(c == "v")), F.when(not_own(f"{c}1").isNotNull(), not_own(f"{c}2"))))
    pair = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    pairs = F.filter(F.array(pair("u", "v_far"), pair("u", "v_next"), pair("u_far", "v"), pair("u_next", "v")), lambda p: joins(p["u"], p["v"]))
    first = rows.select(F.explode(pairs).alias("p")).select("p.*")
    far = rows.groupBy("seq", "later", "kind").agg(F.min("u_far").alias("u_far"), F.max("v_far").alias("v_far"))
    rest = each.join(far, ["seq", "later", "kind"])
    rest = rest.select("later", F.when(F.col("asks"), F.col("id")).otherwise(F.col("u_far")).alias("u"), F.when(F.col("asks"), F.col("v_far")).otherwise(F.col("id")).alias("v"))
    return first.unionByName(rest.where(joins(F.col("u"), F.col("v"))).select("u", "v"))


def equivalence_edges(chains: DataFrame, alignments: DataFrame, discrepancies: DataFrame, always: DataFrame | None = None, alike: DataFrame | None = None) -> DataFrame:
    """u, v whose components are those of all equivalent pairs.

    ``chains``: id, seq, species, length, method, resolution; ``alignments``: seq_1, seq_2, good; ``discrepancies``: id_1, id_2,
    discrepancy; ``always``: id_1, id_2 of pairs that are equivalent whatever the rules say; ``alike``: set, seq of sequences that align with
    all others of a set.  Without any discrepancy two measurable chains never join.
    """
    good = alignments.where("good >= 1").select("seq_1", "seq_2")
    aligned = saved(good.unionByName(good.select(F.col("seq_2").alias("seq_1"), F.col("seq_1").alias("seq_2"))).distinct(), "aligned")
    known = discrepancies.select(F.explode(F.array("id_1", "id_2")).alias("id")).distinct().withColumn("known", F.lit(True))
    rows = chains.select("id", "seq", "species", valid_chain(F.col("length"), F.col("method"), F.col("resolution")).alias("valid")).join(known, "id", "left")
    rows = saved(rows, "chains")
    edges = measured_edges(rows, aligned, discrepancies, alike).unionByName(open_edges(rows.where(~F.col("valid")), rows, aligned, later=False))
    measured = not discrepancies.isEmpty()
    if alike is not None:
        edges = edges.unionByName(set_edges(rows, alike.where("set IS NOT NULL AND seq IS NOT NULL").select("set", "seq").distinct(), later=measured))
    if measured:
        valid = rows.where("valid")
        edges = edges.unionByName(open_edges(valid.where(F.col("known").isNull()), valid, aligned, later=True))
    if always is not None:
        both = always.join(rows.select(F.col("id").alias("id_1")), "id_1", "left_semi").join(rows.select(F.col("id").alias("id_2")), "id_2", "left_semi")
        edges = edges.unionByName(both.select(F.col("id_1").alias("u"), F.col("id_2").alias("v")))
    return edges.unionByName(rows.select(F.col("id").alias("u"), F.col("id").alias("v")))


def ranking() -> list[Column]:
    """Most pairs per length, longest, then the name by code points."""
    ratio = F.when(F.coalesce(F.col("bp"), F.lit(0)) == 0, 0.0).otherwise(F.col("bp") / F.col("length"))
    return [ratio.desc(), F.col("length").desc(), F.col("name"), F.col("id")]


def equivalence_classes(chains: DataFrame, alignments: DataFrame, discrepancies: DataFrame, always: DataFrame | None = None, alike: DataFrame | None = None) -> DataFrame:
    """id, group (the least id of the component), part (the species where the component is split) and rank (from 0) of each chain with a length.

    ``chains`` has bp and name beside the columns of ``equivalence_edges``; ids are unique.
    """
    chains = saved(chains.where("length > 0"), "chains-with-length")
    discrepancies = saved(discrepancies.select("id_1", "id_2", "discrepancy"), "discrepancies")
    edges = equivalence_edges(chains, alignments, discrepancies, always, alike)
    found = connected_components(edges, lambda df: saved(df, "classes"), small_plans=True).select(F.col("node").alias("id"), F.col("component").alias("group"))
    split = split_species(chains.join(found, "id"), "group", "id", "length", "species")
    rank = F.row_number().over(Window.partitionBy("group", "part").orderBy(*ranking())) - 1
    return split.select("id", "group", "part", rank.alias("rank"))
