"""Equivalence classes and elements, against plain programs over random chains that reach every rule."""

import random

import pytest
from conftest import SMALLEST
from pyspark.sql import functions as F

from structmill.operators import elements, equivalence
from structmill.plans.groups import _elements


def random_chains(rng, n):
    species = lambda: rng.choice([None, "32630", "562", "562", "9606"])
    method = lambda: rng.choice(["X-RAY DIFFRACTION"] * 3 + ["SOLUTION NMR", "SOLID-STATE NMR"])
    return [(i, rng.randrange(6), species(), rng.choice([0, 2, 3, 40, 90]), method(), rng.choice([None, 3.0, 20.0, 20.5]), rng.choice([None, 0, 5, 9]), rng.choice("abAB")) for i in range(n)]


def plain_classes(chains, alignments, discrepancies, always):
    chains = [c for c in chains if c[3] > 0]
    good = {(a, b) for s, t, g in alignments if g >= 1 for a, b in ((s, t), (t, s))}
    d = {k: v for a, b, v in discrepancies for k, v in (((a, b), v), ((b, a), v))}
    known = {a for a, _ in d}
    valid = lambda c: c[3] >= 3 and (c[4] == "SOLUTION NMR" or c[5] is not None and c[5] <= 20)

    def equivalent(a, b):
        if (a[0], b[0]) in always or (b[0], a[0]) in always:
            return True
        if None not in (a[2], b[2]) and "32630" not in (a[2], b[2]) and a[2] != b[2] or (a[1], b[1]) not in good:
            return False
        if not valid(a) or not valid(b):
            return True
        if not d:
            return False
        if a[0] not in known:
            return True
        return (a[0], b[0]) in d and 0 <= d[a[0], b[0]] <= 0.4

    root = {c[0]: c[0] for c in chains}
    for k, a in enumerate(chains):
        for b in chains[k + 1 :]:
            if equivalent(a, b) and root[a[0]] != root[b[0]]:
                low, high = sorted((root[a[0]], root[b[0]]))
                root = {i: low if r == high else r for i, r in root.items()}
    out = {}
    for group in set(root.values()):
        members = [c for c in chains if root[c[0]] == group]
        parts = {None: members}
        if max(c[3] for c in members) >= 70 and len(members) > 1:
            named = sorted({c[2] for c in members} - {None, "32630"}, key=lambda s: (-sum(c[2] == s for c in members), s))
            if named:
                parts = {s: [c for c in members if c[2] == s or s == named[0] and c[2] in (None, "32630")] for s in named}
        for part, some in parts.items():
            for rank, c in enumerate(sorted(some, key=lambda c: (-(c[6] or 0) / c[3], -c[3], c[7], c[0]))):
                out[c[0]] = (group, part, rank)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_classes_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    chains = random_chains(rng, 40)
    alignments = [(s, t, rng.choice([0, 1, 1, 5])) for s in range(6) for t in range(s, 6) if rng.random() < 0.4]
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 40) if rng.random() < 0.06]
    discrepancies = [] if seed == 5 else [(a, b, rng.choice([-1.0, 0.0, 0.2, 0.4, 0.41])) for a, b in pairs if a % 5 and b % 5]
    always = [(0, 39), (3, 77)]
    got = equivalence.equivalence_classes(
        spark.createDataFrame(chains, "id int, seq int, species string, length int, method string, resolution double, bp int, name string"),
        spark.createDataFrame(alignments, "seq_1 int, seq_2 int, good int"),
        spark.createDataFrame(discrepancies, "id_1 int, id_2 int, discrepancy double"),
        spark.createDataFrame(always, "id_1 int, id_2 int"),
    )
    assert {r.id: (r.group, r.part, r.rank) for r in got.collect()} == plain_classes(chains, alignments, discrepancies, always)


def test_edges_of_a_busy_sequence_grow_with_its_chains(spark):
    chains = spark.range(3000).select(F.col("id"), F.lit(1).alias("seq"), F.lit(None).cast("string").alias("species"), F.lit(2).alias("length"), F.lit("X").alias("method"), F.lit(1.0).alias("resolution"))
    edges = equivalence.equivalence_edges(chains, spark.createDataFrame([(1, 1, 1)], "seq_1 int, seq_2 int, good int"), spark.createDataFrame([], "id_1 long, id_2 long, discrepancy double"))
    assert edges.count() <= 8 * 3000


@pytest.mark.parametrize("seed", range(6))
def test_sets_of_sequences_against_all_pairs(spark, seed):
    """Sequences of one set align with all others of it; classes are those of the pairs written out, edges are not their number."""
    rng = random.Random(seed)
    chains = random_chains(rng, 40)
    sets = [(k, s) for k in range(4) for s in range(6) if rng.random() < (0.2, 0.4, 0.6)[seed % 3]]
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 40) if rng.random() < 0.06]
    discrepancies = [] if seed == 5 else [(a, b, rng.choice([-1.0, 0.0, 0.2, 0.4, 0.41])) for a, b in pairs if a % 5 and b % 5]
    itself = [(s, s, rng.choice([0, 1])) for s in range(6)]
    written = [(s, t, 1) for k, s in sets for j, t in sets if j == k and s < t]
    got = equivalence.equivalence_classes(
        spark.createDataFrame(chains, "id int, seq int, species string, length int, method string, resolution double, bp int, name string"),
        spark.createDataFrame(itself, "seq_1 int, seq_2 int, good int"),
        spark.createDataFrame(discrepancies, "id_1 int, id_2 int, discrepancy double"),
        alike=spark.createDataFrame(sets + sets[:2], "set int, seq int"),
    )
    assert {r.id: (r.group, r.part, r.rank) for r in got.collect()} == plain_classes(chains, itself + written, discrepancies, [])


def test_edges_of_a_large_set_grow_with_its_chains(spark):
    chains = spark.range(3000).select(F.col("id"), F.col("id").alias("seq"), F.lit(None).cast("string").alias("species"), F.lit(2).alias("length"), F.lit("X").alias("method"), F.lit(1.0).alias("resolution"))
    sets = spark.range(3000).select(F.lit("s").alias("set"), F.col("id").alias("seq"))
    nothing = spark.createDataFrame([], "seq_1 long, seq_2 long, good int"), spark.createDataFrame([], "id_1 long, id_2 long, discrepancy double")
    assert 3000 <= equivalence.equivalence_edges(chains, *nothing, alike=sets).count() <= 10 * 3000


class Group:
    def __init__(self, chain):
        self.chains = {chain}


def plain_elements(chains, counts):
    """Merging one pair after the other, by the rules in words."""
    chains = sorted(chains, key=lambda c: c["chain"])
    n = lambda a, b: max(counts.get((a["chain"], b["chain"]), 0), counts.get((b["chain"], a["chain"]), 0))
    firm = lambda c: c["internal"] >= 5
    groups, part, strip = {c["chain"]: Group(c["chain"]) for c in chains}, {c["chain"]: False for c in chains}, set()

    def joins(a, b, k):
        if a is b or k < 2:
            return False
        if a["length"] < 10 and b["length"] < 10 or k >= 3 and not (firm(a) and firm(b)) or k >= 6:
            return True
        if k < 3 and not firm(a) and not firm(b):
            return False
        return max(k / (0.001 + a["internal"]), k / (0.001 + b["internal"])) >= 0.6

    for a in chains:
        for b in chains:
            if firm(a) == firm(b) and joins(a, b, n(a, b)):
                for c in (a, b):
                    part[c["chain"]] |= firm(c) or n(a, b) >= 5
                groups[a["chain"]].chains |= groups[b["chain"]].chains
                for c in list(groups[a["chain"]].chains):
                    groups[c] = groups[a["chain"]]
    structured, loose = [c for c in chains if firm(c)], [c for c in chains if not firm(c)]
    longest = max([c["length"] for c in structured], default=0)
    for a in structured:
        for b in loose:
            k = n(a, b)
            if a["length"] > 1000 or k < 3:
                continue
            part[a["chain"]] = True
            part[b["chain"]] |= k >= 6 or k > 3 and longest < 60
            groups[a["chain"]].chains |= groups[b["chain"]].chains
            if part[b["chain"]]:
                groups[b["chain"]].chains |= groups[a["chain"]].chains
            else:
                strip.add(b["chain"])
    kept = {id(g): g.chains for c, g in groups.items() if c not in strip}.values()
    order = lambda c: (-c["bps"], -c["internal"], -c["length"], -c["full_length"], c["chain"])
    out = {}
    for g in kept:
        if any(g < h for h in kept):
            continue
        ordered = sorted((c for c in chains if c["chain"] in g), key=order)
        named = ordered if len({firm(c) for c in ordered}) == 1 else [c for c in ordered if part[c["chain"]]]
        if ordered[0]["length"] < 2:
            continue
        name = "+".join(c["chain"] for c in named)
        while len(name) > 100 and "+" in name:
            name = name.rpartition("+")[0]
        out[name] = [c["chain"] for c in ordered]
    return out


def compare(spark, chains, counts):
    got = {}
    for r in elements.elements(chains, counts).orderBy("structure", "element", "index").collect():
        got.setdefault(r.structure, {}).setdefault(r.element, []).append(r.chain)
    rows, pairs, expected = {}, {}, {}
    for r in chains.collect():
        rows.setdefault(r.structure, []).append(r.asDict())
    for r in counts.collect():
        pairs.setdefault(r.structure, {})[r.chain_1, r.chain_2] = r.n
    for structure, some in rows.items():
        found = plain_elements(some, pairs.get(structure, {}))
        if found:
            expected[structure] = found
    assert got == expected
    return expected


def test_elements_of_all_orders(spark):
    lineitem = spark.read.parquet(f"{SMALLEST}/lineitem.parquet")
    found = compare(spark, *_elements(lineitem))
    assert any(len(c) > 2 for s in found.values() for c in s.values())


def test_elements_of_random_structures(spark):
    """Many chains a structure, so that merges depend on earlier ones; long and short structures; names beyond the limit."""
    rng = random.Random(7)
    chains, counts = [], []
    for s in range(60):
        size, scale = rng.randrange(1, 14), rng.choice([8, 50, 300, 3000])
        names = [f"{chr(97 + i)}{'x' * rng.choice([0, 0, 30])}" for i in range(size)]
        chains += [(f"s{s}", c, rng.randrange(12), rng.choice([0, 3, 5, 9]), rng.randrange(1, scale), 5) for c in names]
        counts += [(f"s{s}", a, b, rng.choice([1, 2, 3, 4, 5, 6])) for a in names for b in names if a != b and rng.random() < 2 / size]
    found = compare(spark, spark.createDataFrame(chains, "structure string, chain string, bps int, internal int, length int, full_length int"), spark.createDataFrame(counts, "structure string, chain_1 string, chain_2 string, n int"))
    assert any(len(a) < len(b) for s in found.values() for a, b in ((n.split("+"), c) for n, c in s.items()))


def test_structures_at_once_or_by_rounds(spark, monkeypatch):
    """Structures of few pairs, whose components one task finds, give what rounds of Spark give."""
    rng = random.Random(4)
    chains = [(f"s{s}", f"c{c}", rng.randint(0, 12), rng.randint(0, 9), rng.randint(1, 70), 80) for s in range(12) for c in range(7)]
    counts = [(f"s{s}", f"c{a}", f"c{b}", rng.randint(0, 8)) for s in range(12) for a in range(7) for b in range(7) if a != b and rng.random() < 0.35]
    tables = spark.createDataFrame(chains, "structure string, chain string, bps int, internal int, length int, full_length int"), spark.createDataFrame(counts, "structure string, chain_1 string, chain_2 string, n int")
    by_size = []
    for most in (0, 7):
        monkeypatch.setattr(elements, "MOST_AT_ONCE", most)
        by_size.append(sorted(map(tuple, elements.element_members(*tables).collect())))
    monkeypatch.setattr(elements, "MOST_AT_ONCE", 1000)
    monkeypatch.setattr(elements, "connected_components", None)
    assert sorted(map(tuple, elements.element_members(*tables).collect())) == by_size[0] == by_size[1] and by_size[0]
