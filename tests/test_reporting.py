"""Reports by hand: partners, pseudoknots and unobserved positions, interactions within and beyond loops, carried interactions, missing positions, hubs."""

import pytest

from structmill.operators import elements, reporting
from conftest import SMALLEST
from structmill.operators import motifs
from structmill.plans import tables
from structmill.shared import saved


def test_pairing(spark):
    positions = spark.createDataFrame([("c", 0, "A", "u0"), ("c", 1, "G", None), ("c", 2, "U", "u2"), ("c", 3, "C", "u3")], "chain string, index int, letter string, unit string")
    pairs = spark.createDataFrame([("c", "u0", "u2", "cWW", 0), ("c", "u0", "u3", "cWW", 5), ("c", "u2", "u0", "tHS", 0), ("c", "u3", "elsewhere", "cWW", 0)], "chain string, unit_1 string, unit_2 string, label string, crossing int")
    rows = lambda df: [tuple(r)[1:] for r in df.orderBy("index_1").collect()]
    assert rows(reporting.pairing(positions, pairs, "chain")) == [(1, "A", 1, 4, "C"), (2, "G", 0, None, None), (3, "U", 1, None, None), (4, "C", 1, None, None)]
    assert rows(reporting.pairing(positions, pairs, "chain", remove_pseudoknots=True))[0] == (1, "A", 1, 3, "U")


def test_loop_quality(spark):
    frame = spark.createDataFrame
    loops, positions = frame([("l", "HL"), ("m", "IL"), ("n", "IL")], "loop string, type string"), frame([("l", "a"), ("l", "b"), ("m", "z"), ("n", "a")], "loop string, unit string")
    statuses = frame([("l", 3), ("m", 9)], "loop string, status int")
    interactions = frame([("a", "b", "cWW", "s35", None), ("a", "x", "ncWW", "s33", ""), ("a", "a", None, None, "0BPh"), ("a", "b", "tHS", None, "3BPh"), ("b", "b", None, None, "5BPh")], "unit_1 string, unit_2 string, pairs string, stacks string, basephosphate string")
    got = {(r.loop, r.unit): r for r in reporting.loop_quality(loops, positions, statuses, frame([("l", "M1")], "loop string, motif string"), frame([("a", 0.5, 1.0)], "unit string, rsr double, rsrz double"), interactions).collect()}
    assert set(got) == {("l", "a"), ("l", "b"), ("m", "z")}  # n has no status
    a = got["l", "a"]
    assert (a.status, a.motif, a.rsr, a.internal_pairs, a.external_pairs, a.internal_stacks, a.external_stacks, a.internal_basephosphate) == ("Has Modifications", "M1", 0.5, 1, 0, 1, 1, 1)
    assert (a.internal_interactions, a.external_interactions, a.total_interactions) == (3, 1, 4)
    assert got["l", "b"].internal_basephosphate == 1 and got["m", "z"].status is None and got["m", "z"].motif is None and got["m", "z"].total_interactions == 0


def test_carried_interactions(spark):
    frame = spark.createDataFrame
    first = frame([(1, 10, "a", "b"), (1, 11, "b", "c"), (2, 12, "a", "b")], "k int, id int, unit_1 string, unit_2 string")
    second = frame([(1, 20, "x", "y"), (1, 21, "x", "y"), (1, 22, "y", "x"), (1, 23, "y", "w")], "k int, id int, unit_1 string, unit_2 string")
    mapping = frame([(1, "x", "a"), (1, "y", "b")], "k int, from string, to string")
    assert sorted(map(tuple, reporting.interaction_correspondence(first, second, mapping, "k").collect())) == [(1, 10, 21), (1, 11, None), (2, 12, None)]


def test_units_by_index(spark):
    positions = spark.createDataFrame([("c", 0, 100), ("c", 1, 101)], "chain string, index int, position int")
    units = spark.createDataFrame([("c", "u", 1), ("c", "v", 2), ("c", "w", None)], "chain string, unit string, chain_index int")
    assert sorted(map(tuple, reporting.units_by_index(units, positions, "chain").collect())) == [("c", "u", 100), ("c", "v", 101)]
    with pytest.raises(ValueError, match="no position"):
        reporting.units_by_index(units.selectExpr("chain", "unit", "chain_index + 1 AS chain_index"), positions, "chain")


def test_hubs(spark):
    counts = [("s", "h", f"p{k:02}", 4) for k in range(10)] + [("s", "p00", "h", 4), ("s", "h", "weak", 3), ("t", "h", "p", 9)]
    table = spark.createDataFrame(counts, "structure string, chain_1 string, chain_2 string, n int")
    got = elements.hub_elements(table).orderBy("index").collect()
    assert [r.chain for r in got] == ["h"] + [f"p{k:02}" for k in range(10)] and {r.structure for r in got} == {"s"}
    assert [r.is_integral for r in got] == [True] + [False] * 10 and got[0].element == "h" and got[0].length == 11
    assert elements.hub_elements(table.where("chain_2 <> 'p09'")).count() == 0


def test_loops_join_their_units_last(spark):
    """A loop's type and motif are not shuffled with its units, nor interactions twice."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tables.QUERIES["loop_quality_report"](spark, SMALLEST)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= 20


def test_loops_are_gathered_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(motifs, "saved", lambda df, name: written.append(name) or saved(df, name))
    plan = tables.QUERIES["loop_identity"](spark, SMALLEST)._jdf.queryExecution().executedPlan().toString()
    assert written == ["new_loops", "old_loops"] and "lineitem" not in plan
