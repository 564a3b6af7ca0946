"""Exact top-k by inner product: a dual-tree search over one cover tree of queries and data.

The tree's upper levels are fitted on a bounded sample (farthest first, levels by
shrinking covering radius; a leaf for each ``LEAF_ROWS`` rows within ``LEAVES``);
every row is then assigned to its nearest leaf centre, and covering radii are
measured over all rows, so results do not depend on the sample.  The rows of a
leaf lie in slots by a hash, a block each, and each block goes on downwards: nets
of halving radius down to balls of some ``BALL`` rows around rows of its own.  A
first pass over each query leaf's most promising leaves gives every query a k-th
score.  The traversal descends pairs of nodes together and drops a pair when
cq.cd + rq|cd| + rd|cq| + rq rd  is below the worst k-th score of the query node;
pairs of leaves that survive meet as pairs of blocks, by leaf and slot, where the
descent goes on through the data's balls against each query,  q.cd + rd|q|,  and
only rows of balls that some query of the block may need are multiplied.

Vectors are integers, floor(scale * x).  Defined cases: a vector that is null or
holds null or non-finite components takes no part; shorter vectors are padded
with 0; rows of a repeated vec_id are candidates each, and as queries share one
ranking; null ids take no part; ties go to the smaller vec_id; fewer candidates than k give fewer rows.
Blocks hold at most ``BLOCK`` rows, also of one hot leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.llm.shared import saved

FIT_ROWS, SHRINK = 4000, 1.3
#: Leaves at least and at most, and the rows of a leaf between them.
LEAVES, LEAF_ROWS = (64, 512), 512
BLOCK, QUERY_BLOCK = 4096, 512
#: Rows of a lowest ball, on average, and queries that go through a block's balls together.
BALL, TOGETHER = 16, 32
SEEDS = 3


@dataclass(frozen=True)
class Tree:
    """centres: leaf centres, a node of a level is a prefix's centre; levels: of each, the node of every node of the next."""

    centres: np.ndarray
    levels: tuple[np.ndarray, ...]


def fit(sample: np.ndarray, leaves: int) -> Tree:
    """Nested nets by farthest-first insertion; level i holds the centres inserted at a radius of at least R / SHRINK ** i."""
    order, radius = [0], []
    distance = np.linalg.norm(sample - sample[0], axis=1)
    while len(order) < min(leaves, len(sample)):
        far = int(distance.argmax())
        if distance[far] == 0:
            break
        order.append(far)
        radius.append(distance[far])
        distance = np.minimum(distance, np.linalg.norm(sample - sample[far], axis=1))
    centres = sample[order]
    sizes, scale = [1], (radius[0] if radius else 0) / SHRINK
    while sizes[-1] < len(order):
        n = 1 + sum(r >= scale for r in radius)
        scale /= SHRINK
        if n >= 2 * sizes[-1] or n == len(order):
            sizes.append(n)
    levels = []
    for few, many in zip(sizes, sizes[1:]):
        levels.append(np.linalg.norm(centres[:many, None] - centres[None, :few], axis=2).argmin(1))
    return Tree(centres, tuple(levels))


def survivors(tree: Tree, query_radius: np.ndarray, data_radius: np.ndarray, worst: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (query leaf, data leaf) that may hold a score of at least the worst k-th of the query leaf.

    A radius below 0 marks a leaf without queries or rows.  A node's ball covers
    its leaves' balls; bounds carry a little slack for rounding.
    """
    nodes = [(tree.centres, query_radius, data_radius, worst)]  # from the leaves up
    for up in reversed(tree.levels):
        centres, rq, rd, low = nodes[0]
        n = int(up.max()) + 1
        gap = np.linalg.norm(centres - tree.centres[up], axis=1)
        new = [np.full(n, -1.0), np.full(n, -1.0), np.full(n, np.inf)]
        np.maximum.at(new[0], up, np.where(rq >= 0, rq + gap, -1))
        np.maximum.at(new[1], up, np.where(rd >= 0, rd + gap, -1))
        np.minimum.at(new[2], up, np.where(rq >= 0, low, np.inf))
        nodes.insert(0, (tree.centres[:n], *new))
    pairs = np.array([(0, 0)])
    for depth, (centres, rq, rd, low) in enumerate(nodes):
        q, d = pairs[:, 0], pairs[:, 1]
        length = np.linalg.norm(centres, axis=1)
        bound = (centres[q] * centres[d]).sum(1) + rq[q] * length[d] + rd[d] * length[q] + rq[q] * rd[d]
        keep = (rq[q] >= 0) & (rd[d] >= 0) & (bound * (1 + 1e-9) + 1e-6 * (1 + np.abs(bound)) >= low[q])
        pairs = pairs[keep]
        if depth < len(tree.levels):
            up = tree.levels[depth]
            below = [np.flatnonzero(up == i) for i in range(len(centres))]
            pairs = np.concatenate([np.stack([np.repeat(below[q], len(below[d])), np.tile(below[d], len(below[q]))], 1) for q, d in pairs] or [pairs])
    return [(int(q), int(d)) for q, d in pairs]


def balls(x: np.ndarray, ball: int = BALL) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lowest nodes below one block's root: each row's ball, and of each ball its centre's row, its radius, and the ball above.

    Farthest-first centres; the upper half-deep net is the first sqrt(n) of them, and a lower centre hangs under its nearest upper one.
    """
    x = x.astype(np.float64)
    own, distance, order = np.zeros(len(x), np.int32), np.full(len(x), np.inf), [0]
    norm = (x**2).sum(1)
    for c in range(max(1, len(x) // ball)):
        d = np.sqrt(np.maximum(norm - 2 * (x @ x[order[c]]) + norm[order[c]], 0))
        nearer = d < distance
        own[nearer], distance[nearer] = c, d[nearer]
        far = int(distance.argmax())
        if distance[far] == 0:
            break
        order.append(far)
    order = np.array(order[: int(own.max()) + 1])
    # measured anew, as the differences of large numbers above round
    exact = np.sqrt(((x - x[order[own]]) ** 2).sum(1))
    radius = np.zeros(len(order))
    np.maximum.at(radius, own, exact)
    top = x[order[: max(1, int(len(order) ** 0.5))]]
    up = ((top**2).sum(1) - 2 * x[order] @ top.T).argmin(1).astype(np.int32)
    return own, order.astype(np.int32), radius, up


def needed(q: np.ndarray, low: np.ndarray, centres: np.ndarray, radius: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Balls that may hold a row of score at least ``low`` for one of the queries, by descent from the balls above."""
    top = centres[: int(up.max(initial=0)) + 1]
    wide = np.zeros(len(top))
    np.maximum.at(wide, up, np.linalg.norm(centres - top[up], axis=1) + radius)
    length = np.linalg.norm(q, axis=1)

    def reach(c, r):
        bound = q @ c.T + length[:, None] * r
        return (bound * (1 + 1e-9) + 1e-6 * (1 + np.abs(bound)) >= low[:, None]).any(0)

    at = np.flatnonzero(reach(top, wide)[up])
    return at[reach(centres[at], radius[at])]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as float64, padded with 0."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(int)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """Integers in the smallest type."""
    top = np.abs(matrix).max(initial=0)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max or t is np.int64)
    return matrix.astype(kind)


def _packed(rows: DataFrame, limit: int, width: int, below: bool = False) -> DataFrame:
    """leaf, slot, ids, vectors, item bytes and k-th scores of blocks of at most ``limit`` rows of one leaf and slot.

    ``below``: rows lie by ball, and the balls' sizes, centres' rows, radii and balls above come with them.
    """
    names = ["leaf", "slot", "ids", "vectors", "item", "low", "sizes", "centres", "radii", "above"]

    def flush(place, parts):
        ids, vectors, low = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(ids, kind="stable")
        tree = [b""] * 4
        if below:
            own, centre, radius, up = balls(vectors)
            order = np.lexsort((ids, own))
            at = np.empty(len(order), np.int32)
            at[order] = np.arange(len(order))
            tree = [np.bincount(own, minlength=len(centre)).astype(np.int32).tobytes(), at[centre].tobytes(), radius.tobytes(), up.tobytes()]
        matrix = _narrow(vectors[order])
        columns = [pa.array([place >> 32], pa.int32()), pa.array([place & 0xFFFFFFFF], pa.int32()), pa.array([ids[order].tobytes()]), pa.array([matrix.tobytes()]), pa.array([matrix.itemsize], pa.int32()), pa.array([low[order].tobytes()])]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([x]) for x in tree)], names=names)

    def pack(batches):
        place, held, size = None, [], 0
        for batch in batches:
            leaf, slot, ids, low = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "slot", "vec_id", "low"))
            leaf = leaf.astype(np.int64) << 32 | slot
            vectors = _matrix(batch.column("vec"), width)
            cuts = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1])).tolist() if len(leaf) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(leaf)]):
                if held and leaf[lo] != place:
                    yield flush(place, held)
                    held, size = [], 0
                place = int(leaf[lo])
                while lo < hi:
                    end = min(hi, lo + limit - size)
                    held.append((ids[lo:end], vectors[lo:end], low[lo:end]))
                    size += end - lo
                    lo = end
                    if size == limit:
                        yield flush(place, held)
                        held, size = [], 0
        if held:
            yield flush(place, held)

    schema = "leaf int, slot int, ids binary, vectors binary, item int, low binary, sizes binary, centres binary, radii binary, above binary"
    # a task holds one block at a time
    return rows.select("leaf", "slot", "vec_id", "vec", "low").sortWithinPartitions("leaf", "slot").mapInArrow(pack, schema)


def _scored(queries: DataFrame, data: DataFrame, pairs: DataFrame, k: int, width: int, seen=None) -> DataFrame:
    """query_id, vec_id, score: of each pair of blocks, each query's k best that reach its k-th score so far.

    ``seen``: an accumulator of the (query, row) pairs multiplied.
    """
    kinds = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}

    def best(qid, q, low, did, d):
        """Rows of the k best of each query of a few."""
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * width < 2**53
        kind = np.float64 if exact else np.int64
        score = q.astype(kind) @ d.T.astype(kind)
        mine = qid[:, None] == did[None, :]
        ranked = np.where(mine, -np.inf, score.astype(np.float64))
        if len(did) > k:
            low = np.maximum(low, np.partition(ranked, len(did) - k, axis=1)[:, len(did) - k])
        i, j = np.nonzero((ranked >= low[:, None]) & ~mine)
        s = score[i, j].astype(np.int64)
        order = np.lexsort((did[j], -s, i))
        i, j, s = i[order], j[order], s[order]
        keep = np.arange(len(i)) - np.searchsorted(i, np.arange(len(qid)))[i] < k
        return qid[i[keep]], did[j[keep]], s[keep]

    def multiply(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qid, did, low = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_low"], np.float64)
                q = np.frombuffer(r["q_vectors"], kinds[r["q_item"]]).reshape(-1, width)
                d = np.frombuffer(r["vectors"], kinds[r["item"]]).reshape(-1, width)
                size, centre, up = (np.frombuffer(r[c], np.int32) for c in ("sizes", "centres", "above"))
                start, radius = np.cumsum(size) - size, np.frombuffer(r["radii"], np.float64)
                middle, wide = d[centre].astype(np.float64), q.astype(np.float64)
                # queries that point alike go together
                alike = np.argsort((wide @ middle.T).argmax(1), kind="stable")
                found = []
                for lo in range(0, len(qid), TOGETHER):
                    some = alike[lo : lo + TOGETHER]
                    ball = needed(wide[some], low[some], middle, radius, up)
                    at = np.repeat(start[ball], size[ball]) + np.arange(size[ball].sum()) - np.repeat(np.cumsum(size[ball]) - size[ball], size[ball])
                    if seen is not None:
                        seen.add(len(some) * len(at))
                    if len(at):
                        found.append(best(qid[some], q[some], low[some], did[at], d[at]))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["query_id", "vec_id", "score"])

    q = queries.select(F.col("leaf").alias("q_leaf"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("item").alias("q_item"), F.col("low").alias("q_low"))
    both = q.join(F.broadcast(pairs), "q_leaf").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).drop("slots")
    both = both.join(data.drop("low"), ["leaf", "slot"]).drop("leaf", "slot", "q_leaf")
    return both.mapInArrow(multiply, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = 64, fit_rows: int = FIT_ROWS, leaves: tuple[int, int] = LEAVES, seen=None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query row's k largest integer inner products with all other rows.

    ``seen``: an accumulator of the (query, row) pairs that were multiplied.
    """
    spark = vectors.sparkSession
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vec"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    width, many = rows.agg(F.max(F.size("vec")), F.count("*")).first()
    sample = rows.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(fit_rows).select("vec").toArrow()
    if not sample.num_rows or not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    tree = fit(_matrix(sample.column("vec").combine_chunks(), width), min(max(many // LEAF_ROWS, leaves[0]), leaves[1]))
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches):
        centres = shared.value.centres
        for batch in batches:
            x = _matrix(batch.column("vec"), width)
            leaf = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(np.linalg.norm(x - centres[leaf], axis=1))], names=["vec_id", "vec", "row", "leaf", "distance"])

    placed = rows.mapInArrow(assign, "vec_id long, vec array<bigint>, row long, leaf int, distance double")
    placed = saved(placed.withColumn("is_query", F.coalesce(is_query, F.lit(False))).withColumn("low", F.lit(float("-inf"))), "leaves")
    # one row a leaf comes to the driver: covering radii and counts over all rows
    found = placed.groupBy("leaf").agg(F.max("distance").alias("d"), F.max(F.when(F.col("is_query"), F.col("distance"))).alias("q"), F.count("*").alias("n")).collect()
    n = len(tree.centres)
    rq, rd, count = np.full(n, -1.0), np.full(n, -1.0), np.zeros(n)
    for r in found:
        rd[r["leaf"]], count[r["leaf"]] = r["d"], r["n"]
        rq[r["leaf"]] = -1.0 if r["q"] is None else r["q"]
    slots = (count // BLOCK).astype(int) + 1
    held = F.array(*map(F.lit, slots.tolist()))
    spread = placed.withColumn("slot", F.pmod(F.xxhash64("row"), held[F.col("leaf")]).cast("int"))
    data = saved(_packed(spread.repartition(int(parts), "leaf", "slot"), BLOCK, width, True), "blocks")
    asked = placed.where("is_query").withColumn("slot", F.lit(0))

    seeds = []
    for q in np.flatnonzero(rq >= 0):
        best = np.argsort(-(tree.centres @ tree.centres[q]) - 1e18 * (np.arange(n) == q), kind="stable")
        best = best[count[best] > 0]
        enough = int(np.searchsorted(np.cumsum(count[best]), k + 1)) + 1
        seeds += [(int(q), int(d)) for d in best[: max(SEEDS, enough)]]

    def pair_table(pairs):
        # at most the square of the leaves
        q, d = np.array(pairs).T
        return spark.createDataFrame(pa.table({"q_leaf": q.astype(np.int32), "leaf": d.astype(np.int32), "slots": slots[d].astype(np.int32)}))

    first = saved(_scored(_packed(asked, QUERY_BLOCK, width), data, pair_table(seeds), k, width, seen), "first")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    first = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    kth = first.groupBy("query_id").agg(F.min("score").cast("double").alias("kth"), F.count("*").alias("n")).where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "kth")
    asked = saved(asked.join(kth, "vec_id", "left").withColumn("low", F.coalesce("kth", "low")).drop("kth"), "asked")
    worst = np.full(n, np.inf)
    for r in asked.groupBy("leaf").agg(F.min("low").alias("low")).collect():
        worst[r["leaf"]] = r["low"]
    left = sorted(set(survivors(tree, rq, rd, worst)) - set(seeds))
    out = first.drop("rank")
    if left:
        out = out.unionByName(_scored(_packed(asked, QUERY_BLOCK, width), data, pair_table(left), k, width, seen))
    out = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_topk(vectors: DataFrame) -> DataFrame:
    """Each query id's 20 best; every row is a candidate but those of its own id, and rows of one id are candidates each.

    Vectors that are null or hold null or non-finite numbers, and null ids, take no part; several query rows of one id share a ranking.
    """
    return top_k(vectors, F.col("vec_id") % 20 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
