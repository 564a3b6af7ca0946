import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from structmill.functions import geometry, ids, sequences
from structmill.operators import clustering, lineage, quality, relational, resolve
from structmill.operators.components import connected_components
from structmill.plans import stages
from structmill.shared import saved

VALUES = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40)


def column(spark, expression, **values):
    return spark.range(1).select(expression.alias("x")).first().x


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 60, (45, 2))] + [(200 + i, 201 + i) for i in range(12)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    found = connected_components(spark.createDataFrame(edges, "u long, v long"), lambda df: saved(df, "test"))
    assert {r.node: r.component for r in found.collect()} == {x: top(x) for x in parent}


@pytest.mark.parametrize("a,b,want", [(10, 300, False), (53, 102, True), (50, 102, False), (1999, 2001, False), (2001, 2002, True), (18, 20, False), (30, 30, True)])
def test_length_band(spark, a, b, want):
    rows = spark.createDataFrame([("rna", 1, a), ("rna", 2, b)], "kind string, id long, length long")
    assert (relational.length_band(rows, "kind", "id", "length").count() == 1) == want


def test_length_band_of_many_rows(spark, monkeypatch):
    """Parts of a block change no pair, and no group of the join holds a whole octave of it."""
    rows = spark.range(600).selectExpr("if(id % 7 = 0, 'b', 'a') AS kind", "id", "5 + (id * 37) % 400 AS length")
    once = sorted(map(tuple, relational.length_band(rows, "kind", "id", "length").collect()))
    monkeypatch.setattr(relational, "BAND_ROWS", 20)
    parted = relational.length_band(rows, "kind", "id", "length")
    assert sorted(map(tuple, parted.collect())) == once and len(once) > 10_000
    assert "_i" in parted._jdf.queryExecution().optimizedPlan().toString()


def test_unit_ids(spark):
    rows = spark.createDataFrame([("1ABC|1|A|G|7",), ("1ABC|1|A|G|7||||P_2",), ("1ABC|1|A",)], "u string").select(ids.unit_fields(F.col("u")).alias("f"))
    got = [r.f for r in rows.collect()]
    assert got[0].sym_op == "1_555" and got[1].sym_op == "P_2" and got[1].atom is None and got[2] is None


def test_loop_ids(spark):
    rows = spark.createDataFrame([(7,), (1234,)], "n int").select(ids.loop_id(F.lit("IL"), F.lit("1ABC"), F.col("n")).alias("i"))
    assert [r.i for r in rows.collect()] == ["IL_1ABC_007", "IL_1ABC_001234"]


def test_normalised(spark):
    rows = spark.createDataFrame([("ACIUNN",), ("ACGUNX",), ("ACBGN",)], "s string").select(sequences.normalised(F.col("s"), {"I": "G"}).alias("n"))
    assert [r.n for r in rows.collect()] == ["ACGUNN", "ACGUN", None]


@settings(max_examples=60, deadline=None)
@given(st.text("ACGU", max_size=9), st.text("ACGU", max_size=9))
def test_alignment_is_best(a, b):
    found = sequences.align(a, b)
    assert [i for i, _ in found if i >= 0] == list(range(len(a))) and [j for _, j in found if j >= 0] == list(range(len(b)))
    table = {(0, 0): 0}
    for i, j in itertools.product(range(len(a) + 1), range(len(b) + 1)):
        ways = ([table[i - 1, j] - 1] if i else []) + ([table[i, j - 1] - 1] if j else []) + ([table[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1)] if i and j else [])
        table[i, j] = max(ways, default=0)
    assert sum(1 if i >= 0 and j >= 0 and a[i] == b[j] else -1 for i, j in found) == table[len(a), len(b)]


def random_rotation(rng):
    q, r = np.linalg.qr(rng.normal(size=(3, 3)))
    q = q * np.sign(np.diag(r))
    return q * np.linalg.det(q)


@pytest.mark.parametrize("n", [2, 3, 8])
def test_discrepancy_ignores_rigid_motion(n):
    rng = np.random.default_rng(n)
    centres, frames = rng.normal(size=(n, 3)) * 5, np.array([random_rotation(rng) for _ in range(n)])
    turn, shift = random_rotation(rng), rng.normal(size=3)
    moved = geometry.discrepancy(centres, frames, centres @ turn.T + shift, np.array([turn @ f for f in frames]))
    assert moved < 1e-5
    assert geometry.discrepancy(centres, frames, centres + rng.normal(size=(n, 3)), frames) > 0.05
    assert geometry.discrepancy(centres[:1], frames[:1], centres[:1], frames[:1]) == -1


def test_linkage_and_orders():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(5, 2)), rng.normal(size=(4, 2)) + 30])
    d = np.linalg.norm(points[:, None] - points[None], axis=2)
    groups = clustering.clusters(clustering.average_linkage(d, 10), 9)
    assert len(set(groups[:5])) == 1 and len(set(groups[5:])) == 1 and groups[0] != groups[5]
    for order in (clustering.leaf_order(d), clustering.insertion_order(d)):
        assert sorted(order) == list(range(9))
        assert sum((a < 5) != (b < 5) for a, b in zip(order, order[1:])) == 1


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 8), st.integers(0, 10**6))
def test_first_clique_is_largest(n, seed):
    linked = np.random.default_rng(seed).random((n, n)) < 0.5
    linked = linked | linked.T | np.eye(n, dtype=bool)
    best = max(k for k in range(1, n + 1) for c in itertools.combinations(range(n), k) if all(linked[a, b] for a, b in itertools.combinations(c, 2)))
    found = clustering.maximal_cliques(linked)
    assert len(found[0]) == best and sorted(x for c in found for x in c) == list(range(n))
    assert all(linked[a, b] for c in found for a, b in itertools.combinations(c, 2))


def test_status(spark):
    flags = {name: False for _, name in quality.CASCADE}
    schema = ", ".join(f"{c} boolean" for c in flags)
    cases = [({}, 1), ({"has_modified": True}, 3), ({"has_modified": True, "is_complementary": True}, 6), ({"all_low_q_score": True}, 8), ({"has_breaks": True, "has_modified": None}, 2)]
    rows = spark.createDataFrame([tuple({**flags, **c}.values()) for c, _ in cases], schema).select(quality.status().alias("s"))
    assert [r.s for r in rows.collect()] == [s for _, s in cases]


def test_complementary(spark):
    rows = spark.createDataFrame([("GC", "GC"), ("GA", "UC"), ("GA", "CC"), ("G", "CC")], "a string, b string").select(quality.is_complementary(F.col("a"), F.col("b")).alias("x"))
    assert [r.x for r in rows.collect()] == [True, True, False, False]


def test_species_match(spark):
    cases = [(["1"], ["1", "2"], True), (["1"], ["2"], False), (["1"], ["32630"], True), (["1"], [None], True), ([], ["2"], True)]
    rows = spark.createDataFrame([c[:2] for c in cases], "a array<string>, b array<string>").select(resolve.species_match(F.col("a"), F.col("b")).alias("x"))
    assert [r.x for r in rows.collect()] == [c[2] for c in cases]


def test_names(spark):
    old = spark.createDataFrame([("x", 2, m) for m in "ABC"] + [("y", 1, m) for m in "DE"], "name_handle string, name_version int, member string")
    new = spark.createDataFrame([(1, m) for m in "ABC"] + [(2, m) for m in "DEF"] + [(3, m) for m in "GH"], "group int, member string")
    got = {r.group: (r.handle, r.version, r.kind) for r in lineage.named(new, old).collect()}
    assert got[1] == ("x", 2, "exact") and got[2] == ("y", 2, "updated") and got[3][1:] == (1, "new")
    names = lineage.named(new, old).select("handle", "version")
    changes = lineage.group_changes(names, old.select(F.col("name_handle").alias("handle"), F.col("name_version").alias("version"))).first()
    assert changes.asDict() == {"added": 1, "removed": 0, "updated": 1, "unchanged": 1}
    assert [lineage.next_release("3.9", m) for m in ("major", "minor", "none")] == ["4.0", "3.10", "3.9"]


def test_percent_increase_climbs(spark):
    """The first in naive order beyond the cutoffs, not the largest; it stays where the next step is too small."""
    rows = [(1, "s", 10, 50, 2.0), (1, "a", 1000, 10000, 2.0), (1, "b", 999, 9000, 2.0), (2, "x", 5, 10, None), (2, "y", 5, 10, 1.0), (3, "z", 0, 0, 1.0), (3, "w", 0, 5, 1.0)]
    df = spark.createDataFrame(rows, "g int, id string, bp long, length long, resolution double")
    got = resolve.REPRESENTATIVES["percent-increase"](df, "g")
    assert {r.g: r.id for r in got.collect()} == {1: "b", 2: "y", 3: "z"}
    got = resolve.REPRESENTATIVES["any-increase"](df, "g")
    assert {r.g: r.id for r in got.collect()} == {1: "a", 2: "y", 3: "w"}


def test_metrics_are_multiplied(spark):
    rows = [(1, "p", 10, 20, 2.0, "X-RAY DIFFRACTION", 10.0, 20.0, 1.0), (1, "q", 10, 20, 2.0, "X-RAY DIFFRACTION", 9.0, 20.0, 50.0)]
    df = spark.createDataFrame(rows, "g int, id string, bp long, length long, resolution double, method string, rsrz double, backbone double, clashscore double")
    assert [r.id for r in resolve.REPRESENTATIVES["quality-metrics"](df, "g").collect()] == ["p"]


def test_a_crash_while_replacing_loses_nothing(spark, tmp_path, monkeypatch):
    from structmill.sources import sinks

    path = f"{tmp_path}/t"
    assert sinks.current(spark, path) is None
    sinks.replace(spark, spark.range(3), path)
    # a write that breaks off leaves files without the mark
    broken = spark.range(9).withColumn("x", F.raise_error(F.lit("gone")))
    with pytest.raises(Exception, match="gone"):
        sinks.replace(spark, broken, path)
    (tmp_path / "t" / "_versions" / "000000001-abc").mkdir()
    assert sinks.current(spark, path).count() == 3
    # a crash after the write, before old versions go
    with monkeypatch.context() as m:
        m.setattr(sinks, "_hadoop", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.replace(spark, spark.range(5), path)
    for n in (4, 5, 6):
        sinks.replace(spark, spark.range(n), path)
        assert sinks.current(spark, path).count() == n
    assert len(sinks.versions(spark, path)) == 2


def test_overlapping_sets(spark):
    """Every pair that shares an element once, however many it shares."""
    sets = {k: sorted({(k * a) % 7 for a in range(1, k % 5 + 2)}) for k in range(1, 30)}
    found = relational.overlapping_sets(spark.createDataFrame(list(sets.items()), "o long, s array<long>"), "o", "s").collect()

    def kind(a, b):
        return "exact" if a == b else "contained" if a < b else "enclose" if a > b else "partial"

    plain = [(x, y, kind(set(sets[x]), set(sets[y]))) for x in sets for y in sets if x < y and set(sets[x]) & set(sets[y])]
    assert sorted(map(tuple, found)) == sorted(plain)


@pytest.mark.parametrize("most", [1, 3, 12])
def test_maximal_sets_of_few_members(spark, monkeypatch, most):
    """Sets over few members, so that most are inside others; larger ones than ``most`` are compared by their rarest member."""
    monkeypatch.setattr(relational, "MOST_MEMBERS", most)
    sets = {k: {(k * a * a + a) % 9 for a in range(k % 6 + 1)} for k in range(120)}
    rows = spark.createDataFrame([(k, m) for k, s in sets.items() for m in sorted(s)] + [(0, None)], "o long, p long")
    found = {r.o for r in relational.maximal_sets(rows, "o", "p").collect()}
    assert found == {k for k, s in sets.items() if not any(s < t for t in sets.values())}


def test_maximal_sets_over_fifty_parts():
    """The query's SQL keeps its fifty members, which make orders meet."""
    from structmill.plans.queries import ORACLES

    assert "l_partkey % 50" in ORACLES["maximal_sets"]


def test_parts_grow_with_the_table(spark):
    from structmill.plans.queries import _near
    from structmill.shared import parts_of

    assert [parts_of(spark.range(n), 10) for n in (0, 80, 81, 400)] == [8, 8, 9, 40]
    orders = spark.createDataFrame([(i % 7, i, float(i)) for i in range(40)], "o_custkey long, o_orderkey long, o_totalprice double")
    assert "REPARTITION_BY_NUM" in _near(orders)._jdf.queryExecution().toString()
