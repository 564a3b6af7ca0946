"""Consuming matches against walking in order; report entries, clashes, assemblies, operator expressions and diagrams from files."""

import random

import pytest
from pyspark.sql import functions as F

from structmill.operators import correspondence as C
from structmill.sources import readers


@pytest.mark.parametrize("seed", range(5))
def test_consuming_matches(spark, seed):
    rng = random.Random(seed)
    one = [(p, f"u{k}", rng.randrange(12)) for p in range(4) for k in range(12)] + [(9, f"u{k}", k) for k in range(25)]
    two = [(p, f"v{k}", rng.randrange(12)) for p in range(4) for k in range(rng.choice([1, 9, 14]))] + [(9, f"v{k}", k) for k in range(2)]
    positions = sorted({(rng.randrange(12), rng.randrange(12)) for _ in range(25)})
    expected = []
    for p in range(4):
        there, left = {}, set()
        for _, unit, position in sorted((r for r in two if r[0] == p), key=lambda r: r[1]):
            there[position] = unit
            left.add(position)
        units = sorted((position, unit) for q, unit, position in one if q == p)
        if len(units) > 10 * len({u for q, u, _ in two if q == p}):
            continue
        for position, unit in units:
            common = {b for a, b in positions if a == position} & left
            left -= common
            if len(common) == 1:
                expected.append((p, unit, there[common.pop()]))
    got = C.consuming_matches(spark.createDataFrame(one, "pair int, unit string, position int"), spark.createDataFrame(two, "pair int, unit string, position int"), spark.createDataFrame(positions, "position_1 int, position_2 int"), "pair")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_corresponding_units(spark):
    aligned = spark.createDataFrame([(1, 10, 20), (1, 11, 21), (2, 10, 20)], "correspondence int, position_1 int, position_2 int")
    mapping = spark.createDataFrame([("a|1", 10, "A"), ("b|1", 20, "B"), (None, 11, "A"), ("c|1", 21, "B"), ("gap", 11, "A"), ("d|1", 20, "C")], "unit string, position int, chain string")
    chains = spark.createDataFrame([(1, "A", "B"), (2, "A", "C")], "correspondence int, chain_1 string, chain_2 string")
    assert sorted(map(tuple, C.corresponding_units(aligned, mapping, chains).collect())) == [(1, "a|1", "b|1"), (2, "a|1", "d|1")]


XML = """<r>
<ModelledSubgroup model="1" chain="A" resnum="1" icode=" " altcode=" "><clash atom="P" cid="7" clashmag="0.5" dist="2.0"/><clash atom="C1" cid="8" clashmag="0.1" dist="3.0"/></ModelledSubgroup>
<ModelledSubgroup chain="A" resnum="2" icode=" " altcode="."><clash atom="O" cid="7" clashmag="0.6" dist="2.1"/></ModelledSubgroup>
<ModelledSubgroup model="1" chain="B" resnum="3" icode="X" altcode=" "><clash atom="N" cid="8" clashmag="NotAvailable" dist="3.1"/><clash atom="N" cid="7" clashmag="9" dist="9"/></ModelledSubgroup>
<ModelledSubgroup model="1" chain="Z" resnum="9"><clash atom="N" cid="9" clashmag="1" dist="1"/></ModelledSubgroup>
</r>"""
UNITS = [("A1", "A", 1, None, None, 1), ("A1'", "A", 1, None, None, 1), ("A2", "A", 2, None, None, 1), ("A2#2", "A", 2, None, None, 2), ("B3", "B", 3, "X", None, 1)]


def test_clashes(spark, tmp_path):
    (tmp_path / "v.xml").write_text(XML)
    clashes = readers.validation_clashes(spark, str(tmp_path / "v.xml"))
    assert [(r.cid, r.place, r.atom, r.model, r.ins_code) for r in clashes.orderBy("place").collect()][2:4] == [("7", 2, "O", None, None), ("8", 3, "N", 1, "X")]
    path = clashes.first().path
    units = lambda rows: spark.createDataFrame([(path, *u) for u in rows], "path string, unit string, chain string, number int, ins_code string, alt string, model int")
    # an entry without a model names both models of A2: their pair of models differs, so the file gives nothing
    assert C.clash_units(clashes, units(UNITS), "path").count() == 0
    got = sorted(tuple(r)[1:] for r in C.clash_units(clashes, units(u for u in UNITS if u[0] != "A2#2"), "path").collect())
    # lists of two and one meet as far as both go; magnitude and distance are the last entry's; the third entry of 7 and the unknown residue are left out
    assert got == [("7", "A1", "A2", "P", "O", 9.0, 9.0), ("8", "A1", "B3", "C1", "N", 3.1, None)]
    single = sorted(tuple(r)[2:4] for r in C.clash_units(clashes, units([UNITS[0], UNITS[2], ("A2'", "A", 2, None, None, 1)]), "path").collect())
    assert single == [("A1", "A2"), ("A1", "A2'")]


def test_clashes_of_a_catalogue(spark, monkeypatch):
    """One catalogue of units serves all files, sent to every task or joined, without a row for each file and unit."""
    catalogue = spark.createDataFrame(UNITS, "unit string, chain string, number int, ins_code string, alt string, model int")
    rows = [("f", 1, 1, "A", 1, None, None), ("f", 1, 2, "A", 2, None, 1), ("g", 1, 1, "A", 2, None, None), ("g", 1, 2, "A", 1, None, None), ("h", 1, 1, "B", 3, "X", 1), ("h", 1, 2, "Z", 3, None, 1), ("h", 1, 3, "A", 2, None, 1), ("h", 2, 4, "A", 1, None, 1)]
    clashes = spark.createDataFrame([(*r, None, str(r[2]), float(r[2]), None) for r in rows], "file string, cid int, place int, chain string, number int, ins_code string, model int, alt string, atom string, distance double, magnitude double")
    for few in (C._FEW, 0):
        monkeypatch.setattr(C, "_FEW", few)
        got = sorted(tuple(r)[:7] for r in C.clash_units(clashes, catalogue, "file").collect())
        assert got == [("f", 1, "A1", "A2", "1", "2", 2.0), ("h", 1, "B3", "A2", "1", "3", 3.0)]


def test_entries_name_any_model(spark):
    units = spark.createDataFrame([("f", *u) for u in UNITS], "file string, unit string, chain string, number int, ins_code string, alt string, model int")
    entries = spark.createDataFrame([("f", 1, "A", 2, None, None, None), ("f", 2, "A", 2, None, None, 2), ("f", 3, "A", 2, "X", None, None), ("g", 4, "A", 2, None, None, None)], "file string, id int, chain string, number int, ins_code string, alt string, model int")
    assert sorted((r.id, r.unit) for r in C.units_of_entries(entries, units, "file").collect()) == [(1, "A2"), (1, "A2#2"), (2, "A2#2")]


def test_operator_products(spark):
    texts = ["1", "1,3-5", "P", "(1-2)(P,7)", "(1,2)", "1,(2-3)(X0)", "(1-2)(3-4)(5)"]
    got = {r.t: r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.operator_products(F.col("t")).alias("p")).collect()}
    assert got == {
        "1": [["1"]], "1,3-5": [["1"], ["3"], ["4"], ["5"]], "P": [["P"]], "(1-2)(P,7)": [["1", "P"], ["1", "7"], ["2", "P"], ["2", "7"]], "(1,2)": [["1"], ["2"]],
        "1,(2-3)(X0)": [["1"], ["2", "X0"], ["3", "X0"]], "(1-2)(3-4)(5)": [["1", "3", "5"], ["1", "4", "5"], ["2", "3", "5"], ["2", "4", "5"]],
    }


CIF = """data_X
loop_
_atom_site.label_asym_id
_atom_site.auth_asym_id
A R
B R
C S
#
loop_
_pdbx_struct_oper_list.id
_pdbx_struct_oper_list.name
1 1_555
2 2_655
#
loop_
_pdbx_struct_assembly_gen.assembly_id
_pdbx_struct_assembly_gen.oper_expression
_pdbx_struct_assembly_gen.asym_id_list
1 1,2 A,B,C,D
PAU '(1-60)(P)' C
4 1 C
"""


def test_assemblies(spark, tmp_path):
    (tmp_path / "a.cif").write_text(CIF)
    (tmp_path / "b.cif").write_text("data_Y\nloop_\n_ihm_struct_assembly_details.assembly_id\n_ihm_struct_assembly_details.asym_id\n1 A\n2 B\n")
    got = [tuple(r)[1:] for r in readers.assemblies(spark, str(tmp_path)).collect() if r.path.endswith("a.cif")]
    assert got == [(1, "R", "1", "1_555"), (1, "R", "2", "2_655"), (1, "S", "1", "1_555"), (1, "S", "2", "2_655"), (2, "S", "0", "(1-60)(P)"), (4, "S", "1", "1_555")]
    rows = readers.assemblies(spark, str(tmp_path / "b.cif")).collect()
    assert [tuple(r)[1:] for r in rows] == [(1, "A", "1", "1_555"), (2, "B", "1", "1_555")]
    assert readers.parse_assemblies("data_Z\n_entry.id Z\n") == []


def test_diagram(spark, tmp_path):
    head = "%!PS\n(A) 1.0 2.0 lwstring\nnot a letter\n"  # what precedes other lines is no diagram, but moves the edges
    body = "2.00 2.00 scale\n10.00 -5.00 translate% shift\n" + "".join(f"({'gy'[i % 2]}) {i}.0 {2 * i}.0 lwstring\n" for i in range(5)) + "0.50 0.50 scale\n" + "".join(f"(c) {i}.0 0.0 lwstring\n" for i in range(6)) + "showpage\n"
    (tmp_path / "d.ps").write_text(head + body)
    got = readers.diagrams(spark, str(tmp_path / "d.ps")).orderBy("index").collect()
    assert "".join(r.unit for r in got) == "GUGUG" + "C" * 6
    # x: i * 2 + 20 less the left edge 1; y: the top 6 (4 * 4 - 10) less 4 i - 10
    assert [(r.x, r.y) for r in got[:3]] == [(round(96 / 72 * (2 * i + 19), 3), round(96 / 72 * (16 - 4 * i), 3)) for i in range(3)]
    assert (got[6].x, got[6].y) == (round(96 / 72 * 20, 3), round(96 / 72 * 16, 3))
    assert readers.parse_diagram("") == [] and readers.parse_diagram("(A) 1.0 1.0 lwstring\nend\n") == []


def test_consuming_by_what_is_alike(spark):
    """Positions that are alike need no table of their pairs: the same matches as with one."""
    units = [(p, u, (7 * u + 3 * p) % 12) for p in range(4) for u in range(9)]
    first, second = (spark.createDataFrame([(p, u + shift, (x + shift) % 12) for p, u, x in units], "pair long, unit long, position long") for shift in (0, 5))
    kinds = spark.createDataFrame([(x, x % 5 if x != 3 else None) for x in range(12)], "position long, kind long")
    side = lambda k: kinds.withColumnRenamed("position", f"position_{k}")
    pairs = side(1).join(side(2), "kind").select("position_1", "position_2")
    plain = C.consuming_matches(first, second, pairs, "pair").collect()
    found = C.consuming_matches(first, second, kinds, "pair", ["kind"])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain)) and plain
