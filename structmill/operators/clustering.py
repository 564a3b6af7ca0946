"""Clustering, cliques and orders over distance tables, one group at a time.

Each kernel takes rows group, a, b, distance and works on the matrix of one
group, in one row of a Spark table: memory is the square of a group's items, so
groups are meant to be classes of some thousands at most.  With a cutoff, what
is farther apart than the cutoff never shares a cluster or clique: groups are
first parted into connected components; small groups within one task, of large
ones a task holds one component.
Missing and negative distances count as the group's largest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.operators.components import connected_components
from structmill.shared import saved

#: Heights that stand for "forced apart"; two tight groups of some size stay apart where a merge's height and nearest pair are both large and alike.
FORCED_HEIGHT, SOME_SIZE, LARGE_GAP, ALIKE, TIGHT = 10.0, 3, 0.6, 0.2, 0.4
CLIQUE_RATIO = 0.9
#: Sums held at once by the search for leaf orders; distances of a group up to which one task parts it into components.
MOST_SUMS, MOST_AT_ONCE = 1_000_000, 50_000


def matrix(rows: Mapping[str, np.ndarray] | pd.DataFrame, directed: bool = False) -> tuple[list, np.ndarray]:
    ids, at = np.unique(np.concatenate([rows["a"], rows["b"]]), return_inverse=True)
    out = np.full((len(ids), len(ids)), np.nan)
    half = len(at) // 2
    d = np.asarray(rows["distance"], float)
    out[at[:half], at[half:]] = np.where(d < 0, np.nan, d)
    if not directed:
        out = np.fmin(out, out.T)
    top = np.nanmax(out) if np.isfinite(out).any() else 0.0
    out[np.isnan(out)] = top
    np.fill_diagonal(out, 0.0)
    return ids.tolist(), out


def average_linkage(d: np.ndarray, cutoff: float = np.inf) -> list[tuple[int, int, float]]:
    """Merges (i, j, height) by average linkage up to the cutoff; merged clusters take numbers from n on."""
    n = len(d)
    number, size = np.arange(n), np.ones(n)
    mean = np.where(np.eye(n, dtype=bool), np.inf, d).astype(float)
    out: list[tuple[int, int, float]] = []
    for k in range(n - 1):
        # of equal heights the clusters of smallest numbers
        at = np.argwhere(mean == mean.min())
        at = at[number[at[:, 0]] < number[at[:, 1]]] if k < n - 2 else at
        i, j = at[0].tolist() if len(at) == 1 else min((tuple(sorted((int(number[a]), int(number[b])))) + (int(a), int(b)) for a, b in at))[2:]
        if number[i] > number[j]:
            i, j = j, i
        if mean[i, j] > cutoff:
            break
        out.append((int(number[i]), int(number[j]), float(mean[i, j])))
        joined = (mean[i] * size[i] + mean[j] * size[j]) / (size[i] + size[j])
        size[i] += size[j]
        mean[i], mean[:, i] = joined, joined
        mean[i, i] = np.inf
        mean[j], mean[:, j] = np.inf, np.inf
        number[i], number[j] = n + k, 2 * n + k
    return out


def guarded_clusters(d: np.ndarray) -> list[list[int]]:
    """Clusters of the average-linkage tree whose merges may be refused; a refused merge leaves both sides as they are, and all merges above it fall away."""
    n = len(d)
    members = {i: [i] for i in range(n)}
    for k, (i, j, height) in enumerate(average_linkage(d)):
        a, b = members[i], members[j]
        if not a or not b or height >= FORCED_HEIGHT:
            members[n + k] = []
            continue
        nearest = d[np.ix_(a, b)].min()
        apart = min(len(a), len(b)) >= SOME_SIZE and height > LARGE_GAP and nearest > LARGE_GAP and abs(height - nearest) < ALIKE
        if apart and d[np.ix_(a, a)].max() < TIGHT and d[np.ix_(b, b)].max() < TIGHT:
            members[n + k] = []
            continue
        members[n + k], members[i], members[j] = a + b, [], []
    return sorted((sorted(g) for g in members.values() if g), key=lambda g: (-len(g), g))


def clusters(merges: list[tuple[int, int, float]], n: int) -> np.ndarray:
    """Cluster number of each item, by smallest item."""
    root = list(range(n + len(merges)))
    for k, (i, j, _) in enumerate(merges):
        root[i] = root[j] = n + k

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    tops = [top(i) for i in range(n)]
    first = {}
    return np.array([first.setdefault(t, len(first)) for t in tops])


def leaf_order(d: np.ndarray) -> list[int]:
    """Leaves of the average-linkage tree, each pair of subtrees turned so that their nearest ends meet."""
    n = len(d)
    order = {i: [i] for i in range(n)}
    for k, (i, j, _) in enumerate(average_linkage(d)):
        a, b = order.pop(i), order.pop(j)
        ways = [(d[x[-1], y[0]], t, x + y) for t, (x, y) in enumerate([(a, b), (a[::-1], b), (a, b[::-1]), (a[::-1], b[::-1])])]
        order[n + k] = min(ways)[2]
    return next(iter(order.values()), [])


def insertion_order(d: np.ndarray) -> list[int]:
    """Greedy path: starts with the nearest pair, then inserts the item whose best place adds least."""
    n = len(d)
    if n < 3:
        return list(range(n))
    free = np.where(np.eye(n, dtype=bool), np.inf, d)
    path = list(map(int, np.unravel_index(free.argmin(), free.shape)))
    left = set(range(n)) - set(path)
    while left:
        best = min(((d[x, path[0]], 0, x) for x in left), default=None)
        for x in left:
            ends = [(d[x, path[0]], 0), *((d[path[p - 1], x] + d[x, path[p]] - d[path[p - 1], path[p]], p) for p in range(1, len(path))), (d[x, path[-1]], len(path))]
            best = min(best, min((c, p, x) for c, p in ends))
        path.insert(best[1], best[2])
        left.discard(best[2])
    return path if path[0] <= path[-1] else path[::-1]


def tree_penalty(d: np.ndarray) -> np.ndarray:
    """Height of the tree's merge that joins two items, scaled to the mean distance."""
    n = len(d)
    out, members = np.zeros((n, n)), {i: np.array([i]) for i in range(n)}
    for k, (i, j, height) in enumerate(average_linkage(d)):
        a, b = members.pop(i), members.pop(j)
        out[a[:, None], b] = out[b[:, None], a] = height
        members[n + k] = np.concatenate([a, b])
    return out * d.mean() / max(1e-8, out.mean())


@lru_cache(16)
def _permutations(n: int, repetitions: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.array([rng.permutation(n) for _ in range(repetitions)])


def inserted_paths(d: np.ndarray, orders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``inserted_path`` of each row of ``orders``, all at once: the paths and their lengths."""
    every, paths = np.arange(len(orders)), orders[:, :2]
    lengths = d[paths[:, 0], paths[:, 1]]
    for k in range(2, orders.shape[1]):
        x, before, after = orders[:, k], paths[:, :-1], paths[:, 1:]
        growth = np.concatenate([d[x, paths[:, 0]][:, None], d[paths[:, -1], x][:, None], d[before, x[:, None]] + d[x[:, None], after] - d[before, after]], axis=1)
        best = growth.argmin(1)
        lengths = lengths + growth[every, best]
        at = np.where(best == 0, 0, np.where(best == 1, k, best - 1))
        place = np.arange(k + 1)
        paths = paths[every[:, None], np.minimum(place - (place > at[:, None]), k - 1)]
        paths[every, at] = x
    return paths, lengths


def inserted_path(d: np.ndarray, order: np.ndarray) -> tuple[list[int], float]:
    """Items in ``order``, each put where the path grows least: of equal places the front, then the end, then the first."""
    path = [int(x) for x in order[:2]]
    length = float(d[path[0], path[1]])
    for x in map(int, order[2:]):
        at = np.array(path)
        growth = np.concatenate([[d[x, at[0]], d[at[-1], x]], d[at[:-1], x] + d[x, at[1:]] - d[at[:-1], at[1:]]])
        best = int(growth.argmin())
        length += float(growth[best])
        path.insert(0 if best == 0 else len(path) if best == 1 else best - 1, x)
    return path, length


def oriented(d: np.ndarray, path: list[int]) -> list[int]:
    """The path or its reverse, so that its first third holds the smaller distances."""
    n = len(path)
    if n <= 2:
        return path
    m = {3: 2, 4: 3, 5: 3, 6: 4}.get(n, -(-n // 3) + 1)
    ends = [np.triu(d[np.ix_(some, some)], 1).sum() for some in (path[:m], path[::-1][:m])]
    return path[::-1] if ends[0] > ends[1] else path


def penalised_order(d: np.ndarray, repetitions: int = 100, seed: int = 1) -> list[int]:
    """The shortest of many greedily inserted paths over distances plus the tree's penalty, oriented."""
    n = len(d)
    if n <= 2:
        return list(range(n))
    paths, lengths = inserted_paths(d + tree_penalty(d), _permutations(n, repetitions, seed))
    return oriented(d, paths[lengths.argmin()].tolist())


def optimal_leaf_order(d: np.ndarray) -> list[int]:
    """Of all turns of the average-linkage tree's subtrees, the order of leaves whose path is shortest; oriented.

    For each subtree the least path between each two of its outer leaves is kept: the cube of the items in time, their square in memory, exact at any size.
    """
    n = len(d)
    if n <= 2:
        return list(range(n))
    leaves = {i: np.array([i]) for i in range(n)}
    cost = np.full((n, n), np.inf)
    np.fill_diagonal(cost, 0.0)
    # the leaves that meet inside the path from u to w, u's first
    near, far = np.zeros((n, n), np.int32), np.zeros((n, n), np.int32)
    for k, (i, j, _) in enumerate(average_linkage(d)):
        a, b = leaves.pop(i), leaves.pop(j)
        inside_a, inside_b = cost[a[:, None], a], cost[b[:, None], b]
        across = d[a[:, None], b]
        # blocks of rows, so that the sums over all three leaves stay small
        step = max(1, MOST_SUMS // (len(a) * len(b)))
        for low in range(0, len(a), step):
            over = inside_a[low : low + step, :, None] + across
            by = over.argmin(1)
            reach = over.min(1)
            u = a[low : low + step]
            for left in range(0, len(u), wide := max(1, MOST_SUMS // len(b) ** 2)):
                some, rows = u[left : left + wide], slice(left, left + wide)
                over = reach[rows, :, None] + inside_b
                into = over.argmin(1)
                here, there = (some[:, None], b), (b[:, None], some)
                cost[here] = over.min(1)
                near[here], far[here] = a[np.take_along_axis(by[rows], into, 1)], b[into]
                cost[there], near[there], far[there] = cost[here].T, far[here].T, near[here].T
        # a path through both ends in both
        cost[np.ix_(a, a)], cost[np.ix_(b, b)] = np.inf, np.inf
        leaves[n + k] = np.concatenate([a, b])
    ends = np.where(np.isin(np.arange(n), a)[:, None] & np.isin(np.arange(n), b)[None], cost, np.inf)
    path: list[int] = []
    stack = [tuple(map(int, np.unravel_index(ends.argmin(), ends.shape)))]
    while stack:
        u, w = stack.pop()
        if u == w:
            path.append(u)
        else:
            stack += [(int(far[u, w]), w), (u, int(near[u, w]))]
    return oriented(d, path)


def all_cliques(linked: np.ndarray) -> list[list[int]]:
    """All maximal cliques, by sets with a pivot of most neighbours; as many as the graph has, which can be exponential in its items."""
    near = [set(np.flatnonzero(row).tolist()) - {i} for i, row in enumerate(linked)]
    out, stack = [], [(set(), set(range(len(near))), set())]
    while stack:
        clique, some, done = stack.pop()
        if not some and not done:
            out.append(sorted(clique))
            continue
        pivot = max(some | done, key=lambda v: (len(some & near[v]), -v))
        for v in sorted(some - near[pivot]):
            stack.append((clique | {v}, some & near[v], done & near[v]))
            some, done = some - {v}, done | {v}
    return sorted(out)


def tight_cliques(linked: np.ndarray, d: np.ndarray, ratio: float = CLIQUE_RATIO, criterion: str = "average") -> list[list[int]]:
    """Cliques taken one after another: of those of at least ``ratio`` times the largest's size the one of least average (or largest: "complete") distance, of equal ones the larger, then the first; each item once."""

    def looseness(clique):
        inner = d[np.ix_(clique, clique)][np.triu_indices(len(clique), 1)]
        return float(inner.sum() / (len(inner) + 0.0001) if criterion == "average" else inner.max(initial=0.0))

    left, out = [set(c) for c in all_cliques(linked)], []
    while left:
        left = sorted({tuple(sorted(c)) for c in left}, key=lambda c: (-len(c), c))
        largest = len(left[0])
        if largest == 1:
            return out + [list(c) for c in left]
        best = min((c for c in left if len(c) >= max(2, round(largest * ratio))), key=lambda c: looseness(list(c)))
        out.append(list(best))
        left = [c for c in (set(c) - set(best) for c in left) if c]
    return out


def maximal_cliques(linked: np.ndarray) -> list[list[int]]:
    """Cliques taken one after another, the largest first (of ties the first items), each item once."""
    n = len(linked)
    near = [set(np.flatnonzero(linked[i])) - {i} for i in range(n)]
    left, out = set(range(n)), []
    while left:
        best: list[int] = []
        stack: list[tuple[list[int], list[int]]] = [([], sorted(left))]
        while stack:  # cliques in lexicographic order, each once
            clique, later = stack.pop()
            if len(clique) > len(best):
                best = clique
            for k in range(len(later) - 1, -1, -1):
                more = [w for w in later[k + 1 :] if w in near[later[k]]]
                if len(clique) + 1 + len(more) > len(best):
                    stack.append((clique + [later[k]], more))
        out.append(sorted(map(int, best)))
        left -= set(best)
    return out


def _lists(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    """The columns a, b and distance of each row."""
    parts = []
    if not batch.num_rows:
        return
    for c in ("a", "b", "distance"):
        column = batch.column(c)
        parts.append(np.split(column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy())[:-1]))
    for a, b, distance in zip(*parts):
        yield {"a": a, "b": b, "distance": distance}


def _listed(rows: DataFrame, group: str) -> DataFrame:
    return rows.groupBy(F.col(group).alias("_g")).agg(*[F.collect_list(F.struct("a", "b", F.coalesce(F.col("distance").cast("double"), F.lit(-1.0)).alias("distance"))).alias("_x")]).select("_g", *[F.col(f"_x.{c}").alias(c) for c in ("a", "b", "distance")])


def grouped(rows: DataFrame, group: str, kernel: Callable[[np.ndarray], list[list[int]]], value: str, item_type: str) -> DataFrame:
    """group, item and ``value``: the kernel's lists of items of each group, numbered; an item's number is its list's, or its place if there is one list alone."""
    schema = f"_g {dict(rows.dtypes)[group]}, item {item_type}, {value} int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, items, values = [], [], []
            for columns in _lists(batch):
                ids, d = matrix(columns)
                lists = kernel(d)
                numbered = list(enumerate(lists[0]) if value == "place" else ((n, i) for n, some in enumerate(lists) for i in some))
                counts.append(len(numbered))
                items += [ids[i] for _, i in numbered]
                values += [n for n, _ in numbered]
            groups = batch.column("_g").take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([groups, pa.array(items, batch.schema.field("a").type.value_type), pa.array(values, pa.int32())], names=["_g", "item", value])

    return _listed(rows, group).mapInArrow(run, schema).withColumnRenamed("_g", group)


def _components(d: np.ndarray, cutoff: float) -> list[np.ndarray]:
    """Items of each component of the pairs at most ``cutoff`` apart, by least item."""
    linked = d <= cutoff
    left, out = np.ones(len(d), bool), []
    for first in range(len(d)):
        if left[first]:
            here = new = np.arange(len(d)) == first
            while new.any():
                new = linked[new].any(0) & ~here
                here = here | new
            left &= ~here
            out.append(np.flatnonzero(here))
    return out


def _parted(rows: DataFrame, group: str, cutoff: float, kernel: Callable[[np.ndarray], list[list[int]]], item_type: str) -> DataFrame:
    """_g, _part, item, _list, _first and _size of groups that one task parts into components."""
    schema = f"_g {dict(rows.dtypes)[group]}, _part {item_type}, item {item_type}, _list int, _first {item_type}, _size long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, out = [], []
            for columns in _lists(batch):
                before = len(out)
                ids, d = matrix(columns)
                # without any distance nothing is near
                parts = _components(d, cutoff) if (columns["distance"] >= 0).any() else [np.array([i]) for i in range(len(d))]
                for part in parts:
                    for n, some in enumerate(kernel(d[np.ix_(part, part)])):
                        out += [(ids[part[0]], ids[part[i]], n, ids[part[min(some)]], len(some)) for i in some]
                counts.append(len(out) - before)
            item = batch.schema.field("a").type.value_type
            columns = zip(*out) if out else ((),) * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, (item, item, pa.int32(), item, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("_g").take(pa.array(np.repeat(np.arange(len(counts)), counts))), *arrays], names=["_g", "_part", "item", "_list", "_first", "_size"])

    return _listed(rows, group).mapInArrow(run, schema)


def by_component(rows: DataFrame, group: str, cutoff: float) -> DataFrame:
    """The distances within each component of the pairs at most ``cutoff`` apart, with ``_part``: its least item; an item that is near none is a component."""
    rows = rows.select(F.col(group).alias("_g"), "a", "b", F.when(F.col("distance") >= 0, F.col("distance")).alias("distance"))
    top = rows.groupBy("_g").agg(F.max("distance").alias("_top"))
    node = lambda c: F.struct("_g", F.col(c).alias("item"))
    ends = lambda df: df.select(node("a").alias("u"), node("b").alias("v"))
    every = rows.select("_g", F.explode(F.array("a", "b")).alias("a"))
    # where the largest distance is near, so are pairs without one
    all_near = every.join(top.where(F.col("_top") <= cutoff), "_g").join(every.groupBy("_g").agg(F.min("a").alias("b")), "_g")
    alone = every.select(node("a").alias("u"), node("a").alias("v"))
    edges = ends(rows.where(F.col("distance") <= cutoff)).unionByName(ends(all_near)).unionByName(alone)
    found = connected_components(edges, lambda df: saved(df, "near"), small_plans=True)
    part = lambda c: found.select(F.col("node._g").alias("_g"), F.col("node.item").alias(c), F.col("component.item").alias(f"_{c}"))
    inside = rows.join(part("a"), ["_g", "a"]).join(part("b"), ["_g", "b"]).where("_a = _b").select("_g", F.col("_a").alias("_part"), "a", "b", "distance")
    itself = found.select(F.col("node._g").alias("_g"), F.col("component.item").alias("_part"), F.col("node.item").alias("a"), F.col("node.item").alias("b"), F.lit(None).cast("double").alias("distance"))
    # what a component lacks counts as the whole group's largest, which the pairs of items with themselves carry
    return inside.unionByName(itself).join(top, "_g").withColumn("distance", F.coalesce("distance", "_top", F.lit(0.0))).drop("_top")


def _within(rows: DataFrame, group: str, cutoff: float, kernel, item_type: str) -> DataFrame:
    """Lists of each component of a group, with their least item and size.

    A group of at most ``MOST_AT_ONCE`` distances is parted in one task, larger ones (and those with NaN) by Spark.
    """
    odd = F.max(F.isnan(F.col("distance").cast("double")))
    large = saved(rows.groupBy(group).agg(F.count("*").alias("_n"), odd.alias("_odd")).where((F.col("_n") > MOST_AT_ONCE) | F.col("_odd")).select(group), "large-groups")
    if large.isEmpty():
        return _parted(rows, group, cutoff, kernel, item_type).withColumnRenamed("_g", group)
    same = F.col(group).eqNullSafe(F.col("_large"))
    named = large.withColumnRenamed(group, "_large")
    small, rest = rows.join(named, same, "left_anti"), rows.join(named, same, "left_semi")
    parts = by_component(rest, group, cutoff).withColumn("_key", F.struct("_g", "_part"))
    found = grouped(parts, "_key", kernel, "_list", item_type).select("_key._g", "_key._part", "item", "_list")
    order = found.groupBy("_g", "_part", "_list").agg(F.min("item").alias("_first"), F.count("*").alias("_size"))
    found = found.join(order, ["_g", "_part", "_list"]).select("_g", "_part", "item", "_list", "_first", "_size")
    return found.unionByName(_parted(small, group, cutoff, kernel, item_type)).withColumnRenamed("_g", group)


def cluster_groups(rows: DataFrame, group: str, cutoff: float, item_type: str = "long") -> DataFrame:
    """group, item, cluster by average linkage up to the cutoff; clusters are numbered by their least item."""
    lists = lambda d: [np.flatnonzero(c).tolist() for c in (lambda labels: labels == np.arange(labels.max() + 1)[:, None])(clusters(average_linkage(d, cutoff), len(d)))]
    found = _within(rows, group, cutoff, lists, item_type)
    return found.select(group, "item", (F.dense_rank().over(Window.partitionBy(group).orderBy("_first")) - 1).cast("int").alias("cluster"))


def guarded_cluster_groups(rows: DataFrame, group: str, item_type: str = "long") -> DataFrame:
    """group, item, cluster by average linkage with merges that may be refused; the largest cluster first, then by least item."""
    found = _within(rows, group, FORCED_HEIGHT, guarded_clusters, item_type)
    order = Window.partitionBy(group).orderBy(F.desc("_size"), "_first")
    return found.select(group, "item", (F.dense_rank().over(order) - 1).cast("int").alias("cluster"))


def clique_groups(rows: DataFrame, group: str, cutoff: float, item_type: str = "long", ratio: float | None = None, criterion: str = "average") -> DataFrame:
    """group, item, clique: mutually near items, the largest clique first; with ``ratio`` the tightest of those nearly as large as the largest.

    Cliques are numbered by size, then by least item, over the components of a group.
    """
    kernel = (lambda d: maximal_cliques(d <= cutoff)) if ratio is None else (lambda d: tight_cliques(d <= cutoff, d, ratio, criterion))
    found = _within(rows, group, cutoff, kernel, item_type)
    order = Window.partitionBy(group).orderBy(F.desc("_size"), "_first", "_part")
    return found.select(group, "item", (F.dense_rank().over(order) - 1).cast("int").alias("clique"))


def order_groups(rows: DataFrame, group: str, item_type: str = "long", method=leaf_order) -> DataFrame:
    """group, item, place: items in an order in which neighbours are near."""
    return grouped(rows, group, lambda d: [method(d)], "place", item_type)
