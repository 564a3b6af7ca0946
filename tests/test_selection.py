"""Loops left out for each reason, and export tables, by hand."""

from pyspark.sql import functions as F

from structmill.operators import relational, selection


def plain(names):
    return [f"X|1|A|G|{n}" for n in names]


def test_select_loops(spark):
    loops, positions, statuses = [], [], []

    def loop(name, kind, units, borders, length=9, deprecated=False, status=1):
        loops.append((name, kind, length, deprecated))
        statuses.append((name, status))
        positions.extend((name, k, int(k <= borders), u) for k, u in enumerate(units, 1))

    turned = lambda names, s: [f"{u}||||{s}" for u in plain(names)]
    loop("kept", "HL", plain("abc"), 2)
    loop("modified", "HL", plain("bcd"), 2, status=3)
    loop("invalid", "HL", plain("cde"), 2, status=2)
    loop("old", "HL", plain("def"), 2, deprecated=True)
    loop("short", "IL", plain("efgh"), 4, length=4)
    loop("internal", "IL", plain("fghij"), 4, length=5)
    loop("few", "IL", plain("ghijk"), 3, length=5)
    loop("junction", "J3", plain("abcdefg"), 6)
    loop("loose", "J3", plain("bcdefgh"), 5)
    loop("symmetric", "HL", turned("xyz", "2_555"), 2)
    loop("identity", "HL", turned("uvw", "P_1"), 2)
    loop("two", "HL", turned("op", "2_555") + turned("q", "3_555"), 2)
    loop("copy", "HL", [*plain("a"), *turned("bc", "2_555")], 2)  # the units of "kept", but for symmetry; its first unit is as short, its name smaller
    loop("again", "HL", [*turned("b", "2_555"), *plain("cd")], 2)  # the units of "modified", whose first unit has fewer fields
    loop("excluded", "HL", plain("rst"), 2)
    positions += [("nofirst", 2, 1, "X|1|A|G|a"), ("nofirst", 3, 1, "X|1|A|G|b"), ("nofirst", 4, 1, "X|1|A|G|c")]
    loops.append(("nofirst", "HL", 3, False))
    statuses.append(("nofirst", 1))
    frame = spark.createDataFrame
    args = frame(loops, "loop string, kind string, length int, deprecated boolean"), frame(positions, "loop string, position int, border int, unit string"), frame(statuses, "loop string, status int")
    got = selection.select_loops(*args, exclude=frame([("excluded",)], "loop string"))
    assert {r.loop for r in got.collect()} == {"copy", "modified", "internal", "junction", "identity", "two", "nofirst"}
    assert got.where("loop = 'internal'").count() == 5
    assert {r.loop for r in selection.select_loops(*args, size_limit=6).collect()} == {"internal", "nofirst"}


def test_export_tables(spark):
    frame = spark.createDataFrame
    loops = frame([("l", "e", ["b", "a"]), ("m", "e", [])], "loop string, entry string, units array<string>")
    motifs = frame([("l", "1.0", "old"), ("l", "2.0", "new"), ("m", "1.0", "old")], "loop string, release string, motif string")
    assert sorted(map(tuple, selection.loops_table(loops, motifs, "2.0").collect())) == [("l", "e", "b,a", "new"), ("m", "e", "", None)]
    similar = frame([(1, 2, 0.5), (2, 1, 0.5), (1, 3, 0.1), (2, 2, 0.0), (2, 4, 0.7)], "chain_1 int, chain_2 int, discrepancy double")
    chains = frame([("A", 1, 0), ("B", 2, 0), ("B+C", 2, 0), ("A", 3, 1), ("D", 4, 0)], "element string, chain int, index int")
    assert sorted(map(tuple, selection.discrepancy_table(similar, chains).collect())) == [("A", "B", 0.5), ("A", "B+C", 0.5), ("B", "D", 0.7), ("B+C", "D", 0.7)]


def test_similar_pairs_are_not_made_distinct(spark):
    """Pairs that are listed once are not shuffled again, and large groups' pairs are dealt out."""
    rows = spark.range(300).selectExpr("id % 2 AS nation", "id AS chain", "id * id % 101 AS x")
    dealt = relational.dealt_pairs(rows, "nation", "chain", ("x",), most=20)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, relational.pairs_within(rows, "nation", "chain", ("x",)).collect()))
    assert len({r.p for r in dealt.select(F.spark_partition_id().alias("p")).distinct().collect()}) > 8
    chains = rows.selectExpr("chain AS element", "chain", "0 AS index")
    found = selection.discrepancy_table(dealt.selectExpr("chain_1", "chain_2", "abs(x_1 - x_2) AS discrepancy"), chains, once=True)
    assert found.count() == dealt.count() and "Aggregate [element_1" not in found._jdf.queryExecution().optimizedPlan().toString()
