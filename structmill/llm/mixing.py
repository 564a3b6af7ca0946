"""Mixing sources to target weights, by DataFrame functions only.

Documents are dealt to permuted blocks of about ``block_words`` words within
their source.  A source whose target is q whole sizes and a rest gives all its
blocks q times and, for the rest, a prefix of its permuted blocks; of the block
in which the rest ends, a prefix of its permuted documents.  A splitting tree
then halves the exact block quotas of all sources down to output shards: at each
node the blocks of each source that go left are one multivariate hypergeometric
draw (as if a random half of the node's blocks went left), by the inverse of its
distribution at one hash.  A shard takes its quota of blocks, disjoint from the
others', in permuted order, and shuffles locally by a hash (``place``).

The tree holds one row a node with one number a source; blocks and draws are
rows of their own, put in order by ranges of their hash and prefix sums over the
ranges, so no source is one task's work.  Shards hold about ``shard_words`` words.

All draws are hashes of ids and texts with a seed, so reruns and retried tasks
agree.  Defined cases: null text has size 0; documents of size 0 are in whole draws
like others, and take 0 words; null sources are one source, ordered last; repeated
rows are each mixed; an empty table gives no rows.  The table of sources (one row
each) is ordered in one task; everything else is keyed by source and block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.llm.shared import saved, small

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS, SHARD_WORDS = 50_000, 1 << 27
#: Halvings of the splitting tree at least and at most.
DEPTH = (3, 14)
#: Blocks of one range of hashes, about.
RANGE = 4096
BROADCAST_ROWS = 200_000


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds rank, weight and target to source, source_size.

    Weights repeat in code point order, null last, and share the total of sizes.
    Targets stop at ``most`` sizes; the excess is shared again by weight until
    none is above: the sources that stop are the first by size / weight.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    df = sources.withColumn("rank", F.row_number().over(by_name) - 1)
    df = df.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    df = df.withColumn("most", F.lit(most) * F.col("source_size"))
    before = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = lambda c: F.sum(c).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0))
    df = df.withColumn("total", F.sum("source_size").over(everything))
    df = df.withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))) / left("weight"))
    df = df.withColumn("stops", F.col("most") <= F.col("level") * F.col("weight"))
    share = (F.col("total") - F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0)).over(everything)) / F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    df = df.withColumn("target", F.when(F.col("stops"), F.col("most").cast("double")).otherwise(share * F.col("weight")))
    return df.select("source", "source_size", "rank", "weight", "target")


def _uniform(*keys):
    """A number in [0, 1) that the keys alone determine."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))


def _let(value, use):
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(u, total, marked, drawn):
    """How many of ``drawn`` out of ``total`` are among the ``marked``, by the inverse of the distribution at u in [0, 1).

    Outcomes are asked from the mode up, then down, as far as their chances are
    above 1e-20 of the mode's or so: about the square root of ``total`` many.
    """
    total, marked, drawn = (x.cast("double") for x in (total, marked, drawn))
    deviation = F.sqrt(F.greatest(F.lit(0.0), drawn * (marked / total) * (1 - marked / total) * (total - drawn) / F.greatest(total - 1, F.lit(1.0))))
    given = F.struct(F.floor((drawn + 1) * (marked + 1) / (total + 2)).cast("double").alias("mode"), (F.ceil(deviation * 10) + 10).cast("int").alias("reach"), total.alias("N"), marked.alias("K"), drawn.alias("L"), u.alias("u"))

    def chosen(g):
        rise = lambda k: (g["K"] - k) * (g["L"] - k) / ((k + 1) * (g["N"] - g["K"] - g["L"] + k + 1))  # noqa: E731  chance of k + 1 over that of k
        fall = lambda k: k * (g["N"] - g["K"] - g["L"] + k) / ((g["K"] - k + 1) * (g["L"] - k + 1))  # noqa: E731  of k - 1 over that of k
        steps = F.concat(F.sequence(F.lit(1), g["reach"]), F.sequence(F.lit(-1), -g["reach"], F.lit(-1)))
        start = lambda: F.struct(F.lit(1.0).alias("weight"), F.lit(1.0).alias("sum"), F.lit(None).cast("double").alias("got"))

        def stepping(target):
            def step(s, i):
                k = g["mode"] + i
                before = F.when(i == -1, 1.0).otherwise(s["weight"])
                weight = F.greatest(F.lit(0.0), before * F.when(i > 0, rise(k - 1)).otherwise(fall(k + 1)))
                return _let(weight, lambda w: F.struct(w.alias("weight"), (s["sum"] + w).alias("sum"), F.when(s["got"].isNull() & (s["sum"] + w > target), k).otherwise(s["got"]).alias("got")))

            return step

        everything = F.aggregate(steps, start(), stepping(F.lit(float("inf"))))["sum"]
        search = lambda t: F.when(t < 1, g["mode"]).otherwise(F.coalesce(F.aggregate(steps, start(), stepping(t))["got"], g["mode"]))
        return _let(everything * g["u"], search)

    return _let(given, chosen).cast("long")


def split_tree(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """shard, quotas for the 2 ** depth shards, from one row with quotas: array<struct<rank, n>>.

    Left gets half of all blocks, dealt out source by source.
    """
    nodes = quotas.select(F.lit(1).alias("node"), "quotas")
    for level in range(depth):
        nodes = nodes.withColumn("total", F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q["n"]))

        def one_source(state, q):
            left = F.col("total") - state["asked"]
            rest = left - q["n"]
            drawn = hypergeometric(_uniform(F.lit(seed), F.col("node"), q["rank"]), left, q["n"], state["lacks"])
            got = F.when((q["n"] == 0) | (state["lacks"] == 0), F.lit(0).cast("long")).when(rest == 0, state["lacks"]).otherwise(drawn)
            return _let(got, lambda x: F.struct((state["asked"] + q["n"]).alias("asked"), (state["lacks"] - x).alias("lacks"), F.array_append(state["left"], x).alias("left")))

        empty = F.struct(F.lit(0).cast("long").alias("asked"), F.floor(F.col("total") / 2).cast("long").alias("lacks"), F.array().cast("array<bigint>").alias("left"))
        nodes = nodes.withColumn("left", F.aggregate("quotas", empty, one_source)["left"])
        part = lambda right: F.zip_with("quotas", "left", lambda q, n: F.struct(q["rank"].alias("rank"), (q["n"] - n if right else n).alias("n")))  # noqa: B023, E731
        both = F.array(F.struct((F.col("node") * 2).alias("node"), part(False).alias("quotas")), F.struct((F.col("node") * 2 + 1).alias("node"), part(True).alias("quotas")))
        nodes = saved(nodes.select(F.inline(both)).repartition(min(2 << level, 256), "node"), "mix-tree")
    return nodes.select((F.col("node") - (1 << depth)).alias("shard"), "quotas")


def _in_order(rows: DataFrame, ranges, keys: list, value) -> DataFrame:
    """Adds ``upto``: the sum of ``value`` over a source's rows up to each, in order of a hash of ``keys``; ``ranges`` is the number of hash ranges of the source."""
    h = F.shiftrightunsigned(F.xxhash64(*keys), 11)
    rows = rows.withColumn("_h", h).withColumn("_range", F.floor(F.col("_h") / F.lit(float(1 << 53)) * ranges))
    sums = rows.groupBy("rank", "_range").agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_before", F.sum("_sum").over(Window.partitionBy("rank").orderBy("_range")) - F.col("_sum"))
    rows = rows.join(small(sums.drop("_sum"), BROADCAST_ROWS), ["rank", "_range"])
    within = Window.partitionBy("rank", "_range").orderBy("_h", *[k for k in keys if isinstance(k, str)]).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("upto", F.col("_before") + F.sum(value).over(within)).drop("_h", "_range", "_before")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, size, source_size, target, and draws: array<struct<pass, shard, place>>, of every document."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sized = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), "source", size.alias("size"))
    sized = saved(sized, "mix-sizes")
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    plan = plan.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
    plan = saved(plan.withColumn("ranges", F.ceil(F.col("blocks") / RANGE)), "mix-plan")
    every = plan.agg(F.sum("source_size")).first()[0] or 0
    depth = min(max(DEPTH[0], (every // shard_words).bit_length()), DEPTH[1])

    spread = plan.select(F.col("source").alias("p_source"), "rank", "source_size", "target", "passes", "blocks")
    dealt = sized.join(small(spread, BROADCAST_ROWS), F.col("source").eqNullSafe(F.col("p_source")))
    dealt = dealt.withColumn("block", F.pmod("h", F.col("blocks")))
    blocks = dealt.groupBy("rank", "block").agg(F.sum("size").alias("block_size"))
    blocks = blocks.join(small(plan.select("rank", "passes", "rest", "ranges"), BROADCAST_ROWS), "rank")
    blocks = _in_order(blocks, F.col("ranges"), [F.lit(seed + 1), "rank", "block"], "block_size")
    blocks = blocks.withColumn("left", F.col("rest") - (F.col("upto") - F.col("block_size")))
    whole, cut = F.col("left") >= F.col("block_size"), (F.col("left") > 0) & (F.col("left") < F.col("block_size"))
    blocks = saved(blocks.withColumn("rest_of", F.when(whole, "whole").when(cut, "cut").otherwise("none")), "mix-blocks")

    # the draws of blocks, in the order in which shards take them
    draws = blocks.select("rank", "block", "ranges", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("pass"), "passes", "rest_of").where((F.col("pass") < F.col("passes")) | (F.col("rest_of") != "none"))
    draws = saved(_in_order(draws, F.col("ranges") * (most + 1), [F.lit(seed + 2), "rank", "pass", "block"], F.lit(1)).drop("ranges"), "mix-draws")
    counts = plan.select("rank").join(draws.groupBy("rank").agg(F.count("*").alias("n")), "rank", "left").select("rank", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    root = counts.agg(F.array_sort(F.collect_list(F.struct("rank", "n"))).alias("quotas"))
    shares = split_tree(root, depth, seed).select("shard", F.inline("quotas"))
    shares = shares.withColumn("end", F.sum("n").over(Window.partitionBy("rank").orderBy("shard"))).where(F.col("n") > 0)
    places = shares.repartition("rank", "shard").select("rank", "shard", F.explode(F.sequence(F.col("end") - F.col("n") + 1, "end")).alias("upto"))
    taken = draws.join(places, ["rank", "upto"])
    taken = taken.groupBy("rank", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
    taken = saved(taken.join(blocks.select("rank", "block", "rest_of", "left"), ["rank", "block"]), "mix-taken")

    # of a block in which the rest ends, the documents that fit whole, and the one other nearest to what is left then
    rows = dealt.join(small(taken, BROADCAST_ROWS), ["rank", "block"], "left")
    is_cut = F.coalesce((F.col("rest_of") == "cut") & (F.col("size") > 0), F.lit(False))
    block = Window.partitionBy("rank", "block")
    inside = block.orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0)
    within = rows.where(is_cut).withColumn("upto", F.sum("size").over(inside))
    within = within.withColumn("fits", F.col("upto") <= F.col("left"))
    within = within.withColumn("gap", F.col("left") - F.coalesce(F.max(F.when(F.col("fits"), F.col("upto"))).over(block), F.lit(0)))
    nearest = block.orderBy("fits", F.abs(F.col("size") - F.col("gap")), "h", "size")
    nearest = (F.row_number().over(nearest) == 1) & (F.abs(F.col("size") - F.col("gap")) < F.col("gap"))
    within = within.withColumn("nearest", nearest).withColumn("in_rest", F.col("fits") | F.col("nearest")).drop("upto", "fits", "gap", "nearest")
    rows = rows.where(~is_cut).withColumn("in_rest", F.coalesce(F.col("rest_of") != "cut", F.lit(True))).unionByName(within)
    mine = F.filter("draws", lambda d: (d["pass"] < F.col("passes")) | F.col("in_rest"))
    placed = F.transform(mine, lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), F.xxhash64(F.lit(seed + 4), "h", d["pass"]).alias("place")))
    empty = F.array().cast("array<struct<pass:int,shard:int,place:bigint>>")
    return rows.select(*[F.col(f"k_{c}").alias(c) for c in keep], "size", "source_size", "target", F.coalesce(placed, empty).alias("draws"))


def shuffled(mixed: DataFrame) -> DataFrame:
    """The mix itself: one row a draw with its shard, each shard whole in one partition and in the order of its places."""
    drawn = mixed.withColumn("draw", F.explode("draws")).select("*", "draw.shard", "draw.place").drop("draws", "draw")
    return drawn.repartition("shard").sortWithinPartitions("shard", "place")


def op3_mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and draws (pass, shard, place of each) of every document; empty and null texts have size 0, null sources are the last source."""
    mixed = mix(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).cast("long").alias("taken"), "draws")
