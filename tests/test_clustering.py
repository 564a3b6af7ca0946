"""Linkage, cliques and orders against plain programs and all possibilities."""

from itertools import combinations, permutations

import numpy as np
import pytest
from conftest import SMALLEST

from structmill.operators import clustering as C
from structmill.plans.groups import QUERIES, _apart


def distances(n, seed, points=2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random((n, points)) * (1, 0.2)[:points] * 2, 3)
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))


def plain_linkage(d, cutoff=np.inf):
    live, out = {i: [i] for i in range(len(d))}, []
    while len(live) > 1:
        height, i, j = min((round(d[np.ix_(live[i], live[j])].mean(), 12), i, j) for i, j in combinations(sorted(live), 2))
        if height > cutoff:
            break
        live[len(d) + len(out)] = live.pop(i) + live.pop(j)
        out.append((i, j, height))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 9, 20])
def test_linkage(n):
    d = distances(n, n)
    for cutoff in (np.inf, 0.4):
        got, expected = C.average_linkage(d, cutoff), plain_linkage(d, cutoff)
        assert [m[:2] for m in got] == [m[:2] for m in expected] and np.allclose([m[2] for m in got], [m[2] for m in expected])


def test_refused_merges():
    """Two tight groups of three, far and evenly apart, stay apart; a loose one joins; forced distances never."""
    tight = np.full((6, 6), 0.7)
    tight[:3, :3] = tight[3:, 3:] = 0.1
    np.fill_diagonal(tight, 0)
    assert C.guarded_clusters(tight) == [[0, 1, 2], [3, 4, 5]]
    pairs = tight[np.ix_([0, 1, 3, 4, 5], [0, 1, 3, 4, 5])]
    assert C.guarded_clusters(pairs) == [[0, 1, 2, 3, 4]]
    uneven = tight.copy()
    uneven[0, 3] = uneven[3, 0] = 0.3
    assert C.guarded_clusters(uneven) == [list(range(6))]
    loose = tight.copy()
    loose[0, 1] = loose[1, 0] = 0.45
    assert C.guarded_clusters(loose) == [list(range(6))]
    forced = np.where(tight == 0.7, 99999999999.0, tight)
    assert C.guarded_clusters(forced) == [[0, 1, 2], [3, 4, 5]]
    # what a refused merge would have joined takes no part in later merges
    third = np.full((7, 7), 0.9)
    third[:6, :6] = tight
    third[6, 6] = 0
    assert C.guarded_clusters(third) == [[0, 1, 2], [3, 4, 5], [6]]


@pytest.mark.parametrize("seed", range(12))
def test_cliques(seed):
    rng = np.random.default_rng(seed)
    n = 9
    d = distances(n, seed)
    linked = d <= rng.choice([0.2, 0.5, 1.0])
    cliques = [c for k in range(1, n + 1) for c in combinations(range(n), k) if linked[np.ix_(c, c)].all()]
    maximal = sorted(list(c) for c in cliques if not any(set(c) < set(x) for x in cliques))
    assert C.all_cliques(linked) == maximal
    for ratio, criterion in ((0.9, "average"), (0.6, "complete"), (0.5, "average")):
        left, expected = [set(c) for c in maximal], []
        while left:
            left.sort(key=lambda c: (-len(c), sorted(c)))
            if len(left[0]) == 1:
                break
            least, best = None, None
            for c in left:
                if len(c) < round(len(left[0]) * ratio) or len(c) < 2:
                    break
                inner = [d[i, j] for i, j in combinations(sorted(c), 2)]
                value = sum(inner) / (len(inner) + 0.0001) if criterion == "average" else max(inner)
                if least is None or value < least - 1e-12:
                    least, best = value, c
            expected.append(sorted(best))
            left = [c - best for c in left if c - best]
        expected += [[i] for i in sorted({i for c in left for i in c})]
        assert C.tight_cliques(linked, d, ratio, criterion) == expected


def path(d, order):
    return sum(d[i, j] for i, j in zip(order, order[1:]))


def tree_orders(n, merges):
    trees = {i: [[i]] for i in range(n)}
    for k, (i, j, _) in enumerate(merges):
        trees[n + k] = [x + y for a, b in ((i, j), (j, i)) for x in trees[a] for y in trees[b]]
    return trees[n + len(merges) - 1] if merges else trees[0]


@pytest.mark.parametrize("n", range(1, 9))
def test_leaf_order_is_the_shortest_of_all_turns(n):
    for seed in range(4):
        d = distances(n, 100 + seed)
        orders = tree_orders(n, C.average_linkage(d))
        got = C.optimal_leaf_order(d)
        assert got in orders and path(d, got) == pytest.approx(min(path(d, o) for o in orders))


def test_penalised_order():
    for n, seed in ((5, 1), (7, 2), (8, 3)):
        d = distances(n, seed)
        costs = d + C.tree_penalty(d)
        best = min(path(costs, o) for o in permutations(range(n)))
        got = C.penalised_order(d)
        assert sorted(got) == list(range(n)) and path(costs, got) <= 1.02 * best
        assert C.tree_penalty(d).mean() == pytest.approx(d.mean())
    line = np.abs(np.arange(9)[:, None] - np.arange(9)[None]).astype(float)
    shuffled = np.random.default_rng(4).permutation(9)
    assert [int(shuffled[i]) for i in C.penalised_order(line[np.ix_(shuffled, shuffled)])] in ([*range(9)], [*range(8, -1, -1)])


def test_orientation_puts_near_items_first():
    x = np.array([0.0, 5, 9, 12, 14, 15, 15.5])
    assert C.oriented(np.abs(x[:, None] - x[None]), [*range(7)]) == [*range(6, -1, -1)]


def test_groups_part_into_components(spark):
    """What Spark parts into components equals the kernel on whole groups, missing distances included."""
    rng = np.random.default_rng(9)
    rows = []
    for g in range(6):
        x = rng.random(12) * (0.3 if g == 5 else 4)
        rows += [(g, i, j, None if rng.random() < 0.05 else float(abs(x[i] - x[j]))) for i, j in combinations(range(12), 2) if rng.random() < 0.9]
    table = spark.createDataFrame(rows, "g int, a long, b long, distance double")
    frames = {g: part for g, part in table.toPandas().groupby("g")}

    def sets(df, value):
        out = {}
        for r in df.collect():
            out.setdefault((r.g, r[value]), set()).add(r["item"])
        return sorted((g, sorted(s)) for (g, _), s in out.items())

    def plain(kernel):
        out = []
        for g, part in frames.items():
            ids, d = C.matrix(part)
            out += [(g, sorted(ids[i] for i in c)) for c in kernel(d)]
        return sorted(out)

    labels = lambda d: (lambda k: [np.flatnonzero(k == c).tolist() for c in set(k)])(C.clusters(C.average_linkage(d, 0.5), len(d)))
    assert sets(C.cluster_groups(table, "g", 0.5), "cluster") == plain(labels)
    assert sets(C.guarded_cluster_groups(table, "g"), "cluster") == plain(C.guarded_clusters)
    assert C.cluster_groups(table.limit(0), "g", 0.5).count() == 0 and C.order_groups(table.limit(0), "g").count() == 0
    whole = {(r.g, r.clique): r.n for r in C.clique_groups(table, "g", 0.5, ratio=0.9).groupBy("g", "clique").count().withColumnRenamed("count", "n").collect()}
    assert all(whole[g, k] >= whole[g, k + 1] for g, k in whole if (g, k + 1) in whole)


@pytest.mark.parametrize("name, kernel, value", [("guarded_clusters", C.guarded_clusters, "cluster"), ("penalised_order", C.penalised_order, "place"), ("optimal_leaf_order", C.optimal_leaf_order, "place"), ("tight_cliques", None, "clique")])
def test_queries(spark, name, kernel, value):
    got = QUERIES[name](spark, SMALLEST).toPandas()
    frames = {g: part for g, part in _apart(spark.read.parquet(f"{SMALLEST}/orders.parquet")).toPandas().groupby("g")}
    assert set(got.g) == set(frames) and not got.duplicated(["g", "item"]).any()
    for g, part in got.groupby("g"):
        ids, d = C.matrix(frames[g])
        assert sorted(part["item"]) == ids
        if value == "place":
            assert part.sort_values("place")["item"].tolist() == [ids[i] for i in kernel(d)]
        elif value == "cluster":
            assert sorted(sorted(c["item"]) for _, c in part.groupby("cluster")) == sorted(sorted(ids[i] for i in c) for c in kernel(d))
        else:
            at = {x: i for i, x in enumerate(ids)}
            assert all((d[np.ix_(c, c)] <= 0.5).all() for c in ([at[i] for i in x["item"]] for _, x in part.groupby("clique")))


def test_groups_at_once_or_by_spark(spark, monkeypatch):
    """Groups parted in one task (without a round of Spark's components) give what large ones give."""
    rows = [(g, f"i{i}", f"i{j}", None if (i + j) % 5 == 0 else float(abs(i * i - j * j) % 17) - (g == 3)) for g in range(5) for i in range(9) for j in range(i)]
    rows += [(7, "x", "y", None), (8, "x", "y", 1.0)]
    table = spark.createDataFrame(rows, "g long, a string, b string, distance double")
    asks = [lambda: C.cluster_groups(table, "g", 3.0, "string"), lambda: C.guarded_cluster_groups(table, "g", "string"), lambda: C.clique_groups(table, "g", 3.0, "string"), lambda: C.clique_groups(table, "g", 3.0, "string", ratio=0.9)]
    large = []
    for most in (0, 40):
        monkeypatch.setattr(C, "MOST_AT_ONCE", most)
        large.append([sorted(map(tuple, ask().collect())) for ask in asks])
    monkeypatch.setattr(C, "MOST_AT_ONCE", 50_000)
    monkeypatch.setattr(C, "connected_components", None)
    assert [sorted(map(tuple, ask().collect())) for ask in asks] == large[0] == large[1]


def test_paths_at_once():
    """All insertions of many orders together are those of each alone, ties included."""
    for n in (3, 4, 9, 17):
        for d in (distances(n, n), np.round(distances(n, n + 1))):
            orders = C._permutations(n, 40, 3)
            paths, lengths = C.inserted_paths(d, orders)
            assert [C.inserted_path(d, o) for o in orders] == [(p.tolist(), x) for p, x in zip(paths, lengths)]


def test_leaf_orders_in_blocks(monkeypatch):
    for n in (3, 8, 15):
        expected = C.optimal_leaf_order(distances(n, n))
        for most in (1, 10, 40):
            monkeypatch.setattr(C, "MOST_SUMS", most)
            assert C.optimal_leaf_order(distances(n, n)) == expected
