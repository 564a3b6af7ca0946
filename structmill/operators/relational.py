"""Joins, pair generation, and set algebra over relations, with the key columns as parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.shared import saved, small

#: Members of a set up to which its subsets are written out.
MOST_MEMBERS = 12

#: Rows of one side of a group of candidates, about, and groups of a task.
BAND_ROWS, GROUPS = 2048, 16


def all_of(*conditions: Column | None) -> Column:
    """The conjunction of the conditions that are given; true without any (predicates appended as options ask)."""
    return reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))


def pairs_within(rows: DataFrame, group: str, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """group, key_1 < key_2 and both sides' ``keep`` columns: unordered pairs within a group, each once."""
    side = lambda k: rows.select(F.col(group), F.col(key).alias(f"{key}_{k}"), *[F.col(c).alias(f"{c}_{k}") for c in keep])
    return side(1).join(side(2), group).where(F.col(f"{key}_1") < F.col(f"{key}_2"))


def dealt_pairs(rows: DataFrame, group: str, key: str, keep: tuple[str, ...] = (), most: int = 2048) -> DataFrame:
    """The pairs of ``pairs_within``, for few large groups: their rows are dealt into parts of about ``most``, each two of which meet in a task's group of their own."""
    sizes = rows.groupBy(group).agg(F.ceil(F.count("*") / most).cast("int").alias("_parts"))
    own, every = F.pmod(F.xxhash64(key), F.col("_parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    dealt = rows.join(sizes, group)
    side = lambda k, i, j: dealt.select(F.col(group), F.col(key).alias(f"{key}_{k}"), *[F.col(c).alias(f"{c}_{k}") for c in keep], i.alias("_i"), j.alias("_j"))
    # rows are few beside their pairs, so tasks follow the pairs
    tasks = max(8, sizes.agg(F.sum(F.col("_parts").cast("long") * F.col("_parts"))).first()[0] or 0)
    found = side(1, own, every).repartition(tasks, group, "_i", "_j").join(side(2, every, own), [group, "_i", "_j"])
    return found.where(F.col(f"{key}_1") < F.col(f"{key}_2")).drop("_i", "_j")


def base_pairs(pairs: DataFrame, families: DataFrame, *, near: bool = False, symmetric_once: bool = True, family: str | None = None, most_crossing: int | None = None) -> DataFrame:
    """Annotated unit pairs joined with their family; the options append predicates.

    pairs: unit_id_1, unit_id_2, f_lwbp, f_crossing; families: bp_family_id,
    is_forward, is_symmetric, is_near.  A symmetric pair is stored in both
    directions: ``symmetric_once`` keeps the forward one, and of a symmetric
    family the one with the smaller unit id first.
    """
    joined = pairs.join(F.broadcast(families), F.col("f_lwbp") == F.col("bp_family_id"))
    once = F.col("is_forward") & (~F.col("is_symmetric") | (F.col("unit_id_1") < F.col("unit_id_2")))
    return joined.where(
        all_of(
            None if near else ~F.col("is_near"),
            once if symmetric_once else None,
            None if family is None else F.col("f_lwbp") == family,
            None if most_crossing is None else F.col("f_crossing") <= most_crossing,
        )
    ).drop("bp_family_id")


def left_with_constant(left: DataFrame, right: DataFrame, on: str, **constants) -> DataFrame:
    """Left join whose ON clause also asks right columns for constants: the right side is filtered first."""
    return left.join(right.where(all_of(*[F.col(c) == v for c, v in constants.items()])), on, "left")


def either_direction(wanted: DataFrame, stored: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """Adds ``value`` of the stored pair in whichever direction it is stored; the forward one wins."""
    canonical = stored.groupBy(F.least(a, b).alias("_x"), F.greatest(a, b).alias("_y")).agg(
        F.min(F.when(F.col(a) <= F.col(b), F.col(value))).alias("_forward"), F.min(F.when(F.col(a) > F.col(b), F.col(value))).alias("_back")
    )
    keyed = wanted.withColumn("_x", F.least(a, b)).withColumn("_y", F.greatest(a, b))
    forward = F.when(F.col(a) <= F.col(b), F.coalesce("_forward", "_back")).otherwise(F.coalesce("_back", "_forward"))
    return keyed.join(canonical, ["_x", "_y"], "left").withColumn(value, forward).drop("_x", "_y", "_forward", "_back")


def unmatched(needed: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Needed rows that are not yet known."""
    return needed.join(known, on, "left_anti")


def matched(rows: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(known, on, "left_semi")


def unique_matches(left: DataFrame, right: DataFrame, on: str, a: str, b: str) -> DataFrame:
    """a, b of the keys that match exactly one row on either side, and each a and b used once."""
    once = lambda df, c: df.withColumn("_n", F.count("*").over(Window.partitionBy(c))).where("_n = 1").drop("_n")
    found = once(left.select(on, a), on).join(once(right.select(on, b), on), on)
    return once(once(found, a), b)


def assert_none(rows: DataFrame, message: str) -> None:
    """Raises if there are rows (completeness checks)."""
    first = rows.limit(1).collect()
    if first:
        raise ValueError(f"{message}: {first[0].asDict()}")


def resolve_keys(rows: DataFrame, natural: DataFrame, on: list[str], *, ignore_missing: bool = False) -> DataFrame:
    """Natural keys replaced by surrogate ids; a key without an id is an error unless ignored."""
    if not ignore_missing:
        assert_none(rows.join(natural, on, "left_anti"), "no id for")
    return rows.join(natural, on)


# sets


def overlap_class(a: Column, b: Column) -> Column:
    """exact, contained (a within b), enclose (b within a), partial or none; of arrays of distinct elements."""
    both = F.size(F.array_intersect(a, b))
    return (
        F.when((both == F.size(a)) & (both == F.size(b)), "exact")
        .when(both == 0, "none")
        .when(both == F.size(a), "contained")
        .when(both == F.size(b), "enclose")
        .otherwise("partial")
    )


def overlapping_sets(sets: DataFrame, key: str, members: str) -> DataFrame:
    """key_1 < key_2 and the overlap of all sets (arrays of distinct elements) that share an element.

    Sets meet at each of their elements, and the pair is kept at the least that both have: no pair is written before it is classified.
    """
    side = lambda k: sets.select(F.col(key).alias(f"{key}_{k}"), F.col(members).alias(f"_{k}"), F.explode(members).alias("_at"))
    both = side(1).join(side(2), "_at").where(F.col(f"{key}_1") < F.col(f"{key}_2"))
    least = both.where(F.col("_at") == F.array_min(F.array_intersect("_1", "_2")))
    return least.select(f"{key}_1", f"{key}_2", overlap_class(F.col("_1"), F.col("_2")).alias("overlap"))


def maximal_sets(members: DataFrame, set_id: str, member: str) -> DataFrame:
    """Ids of the sets that are no proper subset of another; of equal sets all stay.

    Equal sets are one.  Sets of at most ``MOST_MEMBERS`` members lead, a size at a time from the largest, to all their subsets of one
    member less, each kept once, which holds no product of sets however many share a member.  A larger set is compared with the sets
    whose rarest member it has.
    """
    rows = members.select(set_id, member).where(F.col(member).isNotNull()).distinct()
    sets = saved(rows.groupBy(set_id).agg(F.array_sort(F.collect_set(member)).alias("all")), "sets")
    kinds = saved(sets.select("all").distinct(), "kinds")
    sized = lambda k: kinds.where(F.size("all") == k)
    inside, below = kinds.limit(0), None
    for k in range(min(MOST_MEMBERS, kinds.agg(F.max(F.size("all"))).first()[0] or 0), 1, -1):
        from_sets = sized(k) if below is None else sized(k).unionByName(below).distinct()
        less = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.concat(F.slice("all", F.lit(1), i), F.slice("all", i + 2, F.lit(k))))
        below = saved(from_sets.select(F.explode(less).alias("all")).distinct(), "subsets")
        inside = inside.unionByName(sized(k - 1).join(below, "all", "left_semi"))
    rarity = kinds.select(F.explode("all").alias(member)).groupBy(member).agg(F.count("*").alias("rarity"))
    each = kinds.select("all", F.explode("all").alias(member)).join(rarity, member)
    rarest = each.groupBy("all").agg(F.min_by(member, F.struct("rarity", member)).alias("rarest"))
    large = kinds.where(F.size("all") > MOST_MEMBERS).select(F.col("all").alias("other"), F.explode("all").alias("rarest"))
    within = (F.size("other") > F.size("all")) & (F.size(F.array_except("all", "other")) == 0)
    inside = inside.unionByName(rarest.join(small(large, 100_000), "rarest").where(within).select("all"))
    return sets.join(inside, "all", "left_anti").select(set_id)


def in_every(rows: DataFrame, item: str, group: str) -> DataFrame:
    """Items that occur in every group (relational division)."""
    groups = rows.select(F.count_distinct(group).alias("_all"))
    return rows.groupBy(item).agg(F.count_distinct(group).alias("_n")).crossJoin(F.broadcast(groups)).where("_n = _all").select(item)


def length_band(rows: DataFrame, block: str, key: str, length: str, exact_below: int = 19, huge: int = 2000) -> DataFrame:
    """Pairs key_1 < key_2 of one block whose lengths match.

    With s the smaller length: s < exact_below asks for equal lengths; else the
    other is at most 2s; and a length from ``huge`` up is not mixed with a
    smaller one: s < huge ends at min(2s, huge).  Blocking by powers of two keeps
    the candidates to neighbouring lengths, and parts of about BAND_ROWS rows keep a
    group of candidates bounded, however many rows a block has.
    """
    base = rows.select(block, key, length).withColumn("_octave", F.floor(F.log2(F.greatest(F.col(length), F.lit(1)))).cast("int"))
    # both sides of an octave are dealt into parts, and each two parts meet in a group of their own
    sizes = base.groupBy(block, "_octave").agg(F.ceil(F.count("*") / BAND_ROWS).cast("int").alias("_parts"))
    spread = lambda c, parts: F.pmod(F.xxhash64(c), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    right = base.join(sizes, [block, "_octave"]).withColumnRenamed("_parts", "_own")
    left = right.withColumn("_octave", F.explode(F.array("_octave", F.col("_octave") + 1))).join(sizes, [block, "_octave"])
    left = left.select(block, F.col(key).alias("_a"), F.col(length).alias("_s"), "_octave", spread(key, "_own").alias("_i"), "_own", every("_parts").alias("_j"))
    below = sizes.select(block, (F.col("_octave") + 1).alias("_octave"), F.col("_parts").alias("_below"))
    right = right.join(below, [block, "_octave"], "left").select(block, F.col(key).alias("_b"), F.col(length).alias("_l"), "_octave", spread(key, "_own").alias("_j"), F.explode(F.array_distinct(F.array("_own", F.coalesce("_below", "_own")))).alias("_own"))
    right = right.withColumn("_i", every("_own"))
    # rows are few and short beside their pairs, so tasks follow the pairs
    both = sizes.alias("x").join(sizes.alias("y"), F.expr(f"x.{block} = y.{block} AND y._octave IN (x._octave, x._octave + 1)"))
    tasks = max(8, -(-(both.agg(F.sum(F.col("x._parts").cast("long") * F.col("y._parts"))).first()[0] or 0) // GROUPS))
    left = left.repartition(tasks, block, "_octave", "_own", "_i", "_j")
    s, other = F.col("_s"), F.col("_l")
    upper = F.when(s >= huge, 2 * s).otherwise(F.least(2 * s, F.lit(huge)))
    fits = F.when(s < exact_below, other == s).otherwise(other.between(s, upper))
    found = left.join(right, [block, "_octave", "_own", "_i", "_j"]).where((other > s) | ((other == s) & (F.col("_a") < F.col("_b")))).where(fits)
    swapped = F.col("_a") > F.col("_b")
    return found.select(
        block,
        F.least("_a", "_b").alias(f"{key}_1"),
        F.greatest("_a", "_b").alias(f"{key}_2"),
        F.when(swapped, other).otherwise(s).alias(f"{length}_1"),
        F.when(swapped, s).otherwise(other).alias(f"{length}_2"),
    )


def ordered_fallback(wanted: DataFrame, existing: DataFrame, key: str, rewrites: list[Column]) -> DataFrame:
    """key, found: the first rewrite of a key, in order, that exists."""
    each = wanted.select(key, F.posexplode(F.array(*rewrites)).alias("_priority", "found"))
    known = existing.select(F.col(key).alias("found")).distinct()
    best = each.join(known, "found").groupBy(key).agg(F.min_by("found", "_priority").alias("found"))
    return wanted.select(key).distinct().join(best, key, "left")


def upsert(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows replaced by new ones of the same key; new keys are added."""
    return stored.join(new, keys, "left_anti").unionByName(new)


def symmetric_labels(pairs: DataFrame, label: str = "label") -> DataFrame:
    """unit_1, unit_2, label and each pair's mirror with the two edges of its label swapped (tHS -> tSH; near prefix n stays)."""
    near = F.when(F.col(label).startswith("n"), 1).otherwise(0)
    edges = F.substr(label, near + 2)
    mirrored = F.concat(F.substr(F.col(label), F.lit(1), near + 1), F.substring(edges, 2, 1), F.substring(edges, 1, 1))
    return pairs.select("unit_1", "unit_2", label).unionByName(pairs.select(F.col("unit_2").alias("unit_1"), F.col("unit_1").alias("unit_2"), mirrored.alias(label)))
