import datetime
import gzip

import pytest
from pyspark.sql import functions as F

from structmill.plans import stages
from structmill.sources import readers, sinks
from structmill.streaming import incremental

CIF = """data_X
#
_entry.id X
loop_
_atom_site.group_PDB
_atom_site.label_comp_id
_atom_site.Cartn_x
_atom_site.note
ATOM G 1.5 'a b'
ATOM "U" 2.5 ?
#
loop_
_other.a
1
"""


def test_cif(spark, tmp_path):
    (tmp_path / "x.cif").write_text(CIF)
    (tmp_path / "y.cif.gz").write_bytes(gzip.compress(CIF.encode()))
    rows = readers.cif_loop(spark, str(tmp_path), "_atom_site", ["label_comp_id", "Cartn_x", "note", "absent"]).collect()
    assert sorted(tuple(r)[1:4] for r in rows) == [("G", "1.5", "a b")] * 2 + [("U", "2.5", None)] * 2
    assert readers.parse_cif(CIF, "_entry", ["id"]) == [("X",)]


def test_fasta_and_stockholm(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 first\nAC\nGU\n>s2\nGG\n")
    assert [tuple(r)[1:] for r in readers.fasta(spark, str(tmp_path / "a.fa")).collect()] == [("s1", "s1 first", "ACGU"), ("s2", "s2", "GG")]
    (tmp_path / "a.sto").write_text("# STOCKHOLM 1.0\ns1  A-C\ns2  ..G\n\ns1  GU\ns2  A-\n//\n")
    aligned = readers.stockholm(spark, str(tmp_path / "a.sto"))
    assert {r.id: r.aligned for r in aligned.collect()} == {"s1": "A-CGU", "s2": "..GA-"}
    columns = readers.alignment_columns(aligned).where("id = 's1'").orderBy("column").collect()
    assert [r.position for r in columns] == [1, None, 2, 3, 4]


def test_tables(spark, tmp_path):
    (tmp_path / "MotifList.csv").write_text('"IL_1_001","m1"\n')
    assert readers.motif_table(spark, str(tmp_path), "MotifList").first().name == "m1"
    (tmp_path / "MotifPositions.csv").write_text("")
    with pytest.raises(ValueError):
        readers.motif_table(spark, str(tmp_path), "MotifPositions")
    (tmp_path / "loops.tsv").write_text("L1\ta,b\tmerged\nL2\tb,c\t\n")
    loops = readers.loop_file(spark, str(tmp_path / "loops.tsv"))
    assert {r.unit: r.partners for r in readers.partners(loops).collect()} == {"a": ["b"], "b": ["a", "c"], "c": ["b"]}
    (tmp_path / "hits.txt").write_text("# head\nt a q a cm 1 70 2 71 + no 1 0.5 0.0 55.5 1e-9 ! d\n")
    assert readers.search_hits(spark, str(tmp_path / "hits.txt")).first().score == 55.5


def test_xml(spark, tmp_path):
    (tmp_path / "v.xml").write_text('<r><ModelledSubgroup chain="A" resnum="3" icode=" " altcode="." rsr="0.2" rsrz="1.5"/></r>')
    r = readers.validation_residues(spark, str(tmp_path / "v.xml")).first()
    assert (r.chain, r.number, r.ins_code, r.rsrz, r.rscc) == ("A", 3, None, 1.5, None)
    (tmp_path / "t.xml").write_text('<ROOT><taxon scientificName="x" taxId="9" rank="strain"><lineage><taxon scientificName="sp" taxId="5" rank="species"/></lineage></taxon></ROOT>')
    assert readers.taxonomy(spark, str(tmp_path / "t.xml")).first().rank_taxid == "5"


def test_renamed(spark):
    rows = spark.createDataFrame([(" 1.5 ", "NotAvailable")], "`a-b` string, c string")
    got = readers.renamed(rows, {"a-b": ("a_b", "double"), "c": ("c", "double"), "d": ("d", "int")}).first()
    assert got.asDict() == {"a_b": 1.5, "c": None}
    with pytest.raises(KeyError):
        readers.renamed(rows, {"d": ("d", "int")}, skip_absent=False)


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.append(rows, path)
    sinks.merge(spark, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), path, ["k"])
    sinks.delete(spark, path, spark.createDataFrame([(1,)], "k int"), ["k"])
    assert sorted(tuple(r) for r in sinks.current(spark, path).collect()) == [(2, "c"), (3, "d")]
    with pytest.raises(ValueError):
        sinks.csv(rows.where("k > 9"), str(tmp_path / "c"))
    sinks.csv(rows, str(tmp_path / "c"), gzip=True)
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    sinks.nested_export(rows, str(tmp_path / "n"), "k", ["v"])
    assert spark.read.json(str(tmp_path / "n")).count() == 2


def test_stages(spark, tmp_path):
    calls = []

    def compute(name):
        def f(spark, entries):
            calls.append(name)
            return entries.select(F.col("entry").alias("id"), F.lit(name).alias("by"))

        return f

    known = {n: stages.Stage(n, compute(n), ("id",), needs, datetime.timedelta(days=7)) for n, needs in (("a", ()), ("b", ("a",)))}
    entries = spark.createDataFrame([("x",), ("y",)], "entry string")
    day = datetime.datetime(2024, 1, 1)
    go = lambda e, now, **k: stages.run(spark, "b", e, str(tmp_path / "s"), now, stages=known, **k)
    assert go(entries, day, dry_run=True) == ["a", "b"] and not (tmp_path / "s" / "b").exists()
    assert go(entries, day) == ["a", "b"]
    assert go(entries, day + datetime.timedelta(days=1)) == []
    more = entries.union(spark.createDataFrame([("z",)], "entry string"))
    assert go(more, day + datetime.timedelta(days=2)) == ["a", "b"]
    assert go(more, day + datetime.timedelta(days=8)) == ["a", "b"]
    assert sorted(r.id for r in sinks.current(spark, str(tmp_path / "s" / "b")).collect()) == ["x", "y", "z"]


def test_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.createDataFrame([(1, "a", datetime.datetime(2024, 1, 1, 5)), (2, "b", datetime.datetime(2024, 1, 1, 6))], "id long, e string, ts timestamp")
    rows.write.parquet(source)
    out, marks, check = (str(tmp_path / x) for x in ("out", "marks", "check"))
    run = lambda: incremental.run_incremental(spark, spark.readStream.schema(rows.schema).parquet(source), lambda b: b.groupBy("e").count(), out, marks, "e", "counts", check)
    run()
    rows.limit(1).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(out).groupBy().sum("count").first()[0] == 3 and spark.read.parquet(marks).count() == 3
    counts = incremental.windowed_counts(spark.readStream.schema(rows.schema).parquet(source), "ts", "e")
    query = counts.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("w").count() == 2
