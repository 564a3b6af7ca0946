"""Corrections of unit ids against trying rewrites one by one; species problems by hand."""

import random

import pytest
from pyspark.sql import functions as F

from structmill.operators import corrections


def plain(unit, known):
    pdb, model, chain, _, number, _, alt, ins, symmetry = (unit.split("|") + [""] * 9)[:9]
    model, alt, symmetry = int(model), alt or None, symmetry or "1_555"
    turned, same = model != 1 and symmetry != "1_555", symmetry == "1_555"
    tries = [(model, alt, symmetry), turned and (1, alt, symmetry), alt is None and (model, "A", symmetry), alt is None and turned and (1, "A", symmetry), same and (model, alt, "P_1"), same and alt is None and (model, "A", "P_1"), model == 2 and (1, alt, symmetry)]
    return next((known[pdb, chain, number, ins, *t] for t in tries if t and (pdb, chain, number, ins, *t) in known), None)


def spell(n, model, alt, symmetry):
    full = f"X|{model}|A|G|{n}||{alt or ''}||{symmetry}"
    return f"X|{model}|A|G|{n}" if symmetry == "1_555" and not alt else full


@pytest.mark.parametrize("seed", range(4))
def test_corrections(spark, seed):
    rng = random.Random(seed)
    draw = lambda: (rng.choice([1, 2, 3]), rng.choice([None, "A", "B"]), rng.choice(["1_555", "P_1", "2_655"]))
    known = {("X", "A", str(n), "", *k): spell(n, *k) for n in range(60) for k in {draw() for _ in range(2)}}
    wanted = sorted({spell(n, *draw()) for n in range(60)})
    expected = {u: plain(u, known) for u in wanted}
    frame = lambda units: spark.createDataFrame([(u,) for u in units], "unit string")
    got = corrections.corrected(frame(wanted), frame(known.values()), require_all=False)
    assert {r.unit: r.corrected for r in got.collect()} == {u: c for u, c in expected.items() if c} and set(expected.values()) > {None}
    with pytest.raises(ValueError, match="could not correct"):
        corrections.corrected(frame(wanted), frame(known.values()))
    rows = frame([*wanted, wanted[0]]).select(F.lit(1).alias("x"), F.col("unit").alias("u")).unionByName(spark.createDataFrame([(2, None)], "x int, u string"))
    fixed = corrections.corrected_column(rows, "u", frame(known.values())).collect()
    assert sorted(str(r.u) for r in fixed) == sorted(str(expected.get(r.u) or r.u) for r in rows.collect()) and fixed[0].__fields__ == ["x", "u"]


def test_ambiguous_units(spark):
    frame = lambda *units: spark.createDataFrame([(u,) for u in units], "unit string")
    with pytest.raises(ValueError, match="several units of"):
        corrections.corrected(frame("X|1|A|G|1"), frame("X|1|A|G|1", "X|1|A|C|1"))
    with pytest.raises(ValueError, match="several units became"):
        corrections.corrected(frame("X|2|A|G|1", "X|1|A|G|1"), frame("X|1|A|G|1"))


def test_species_problems(spark):
    chains = [("a", "s", 1, "E. coli"), ("b", "s", 2, "Human"), ("c", "s", None, None), ("d", "s", 3, "synthetic construct"), ("e", "t", 4, None), ("f", "u", 5, "Yeast sp."), ("g", "v", 6, "Fly"), ("h", "v", 7, "Frog"), ("i", "v", 8, "Bee")]
    known = spark.createDataFrame([("v", "Fly"), ("w", "Ant")], "sequence string, species_name string")
    got = {r.id: r.problems for r in corrections.species_problems(spark.createDataFrame(chains, "id string, sequence string, species_id int, species_name string"), known).collect()}
    several = "Multiple species assigned to this sequence: E. coli: (a), Human: (b)"
    unexpected = "Unexpected species Bee, Frog assigned to this sequence Expected one of Fly"
    assert got == {"a": several, "b": several, "c": several, "d": several, "e": "Species with no assigned name. Taxon id: 4", "f": "Unlikely species name: (Yeast sp.)", "g": unexpected, "h": unexpected, "i": unexpected}


def test_rewrites_are_not_written_out(spark):
    """A wanted unit is joined once, by what no rewrite changes: the plan holds no row per rewrite."""
    known = spark.createDataFrame([("1S72|1|A|G|5||A||2_555",), ("1S72|1|A|G|6||||P_1",)], "unit string")
    wanted = spark.createDataFrame([("1S72|2|A|G|5||||2_555",), ("1S72|1|A|G|6",), ("1S72|1|A|G|7",)], "unit string")
    planned = []
    before = corrections.saved
    corrections.saved = lambda df, name: planned.append(df._jdf.queryExecution().toString()) or before(df, name)
    try:
        found = corrections.corrected(wanted, known, require_all=False).collect()
    finally:
        corrections.saved = before
    assert sorted(map(tuple, found)) == [("1S72|1|A|G|6", "1S72|1|A|G|6||||P_1"), ("1S72|2|A|G|5||||2_555", "1S72|1|A|G|5||A||2_555")]
    assert len(planned) == 2 and not any("Generate" in p for p in planned)


def test_wanted_units_are_dealt_once(spark):
    """Wanted units are dealt out by what no rewrite changes alone, for the join and for the count of a correction's units."""
    known = spark.createDataFrame([("1S72|1|A|G|5||A||2_555",), ("1S72|1|A|G|6||||P_1",)], "unit string")
    wanted = spark.createDataFrame([("1S72|2|A|G|5||||2_555",), ("1S72|1|A|G|6",), ("1S72|1|A|G|6",)], "unit string")
    plans = {}
    before = corrections.saved
    corrections.saved = lambda df, name: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or before(df, name)
    try:
        assert corrections.corrected(wanted, known).count() == 2
    finally:
        corrections.saved = before
    dealt = [line.split("hashpartitioning(")[1] for line in plans["corrected"].splitlines() if "hashpartitioning(" in line]
    assert dealt and all(line.startswith("kept#") for line in dealt)
