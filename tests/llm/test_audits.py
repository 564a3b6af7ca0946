"""Divergence, packing and filter interaction: against SQL, brute force and exact round trips, over messy rows."""

import random
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from compare import same
from conftest import SMALLEST
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from structmill.llm import divergence, interactions, packing

EXTRA = ["part", "mask", "hash", "place", "term", "row", "length", "cell", "value", "rank", "n", "count", "terms", "block", "sequence_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
BASE = "alpha Beta gamma delta epsilon zeta"
ROWS = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "b"),
    (3, BASE + " alpha alpha", "en", None),
    (4, None, "en", "c"),
    (5, "", None, None),
    (6, "ÄÖ äö ÄÖ Straße", "de", "a"),
    (7, "äö Straße STRASSE ÄÖ", "de", "b"),
    (7, "äö Straße STRASSE ÄÖ", "de", "b"),
    (None, BASE, "en", "a"),
    (None, None, None, "a"),
    (8, "w$ " * 60_000 + "x" * 50_000, "en", "b"),
    (9, "lonely", "xx", "z"),
    (10, " ".join(f"w{i}" for i in range(300)), "en", "a"),
    (11, " ".join(f"w{i}" for i in range(300)), "en", "b"),
    (12, "<|endoftext|> SHOUTING " * 3, "en", "b"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, 1, None), (None, 1, 1), (11, 1, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, g, s, 0, *["x"] * len(EXTRA)) for i, t, g, s in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(ROWS, columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"}))
    con.register("labels", pd.DataFrame(LABELS, columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    return con


def test_divergence_of_messy_rows(docs, sql):
    got = divergence.op11_divergence(docs).toPandas()
    same(got, sql.execute(divergence.ORACLE).df())
    assert {("", ""), ("en", "")} <= set(zip(got.lang, got.source)) and "lonely" not in set(got.item)
    pair = got[(got.part == "pair") & (got.lang == "en")]
    assert len(pair) == 4 * 3


def test_divergence_in_many_blocks(docs, sql, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 40)
    monkeypatch.setattr(divergence, "HELD", 5)
    same(divergence.op11_divergence(docs).toPandas(), sql.execute(divergence.ORACLE).df())


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = "ab " * 30 + "x" * 40 + " Ä-b, "
    assert [t.decode() for p in divergence._pieces(text.encode()) for t in p] == ["ab"] * 30 + ["x" * 40, "Ä", "b"]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=30))
def test_runs_give_back_the_column(column):
    column = np.array(column)
    rows = np.flatnonzero(column)
    starts, values = divergence.runs(rows, column[rows])
    lengths = np.diff(np.append(starts, len(column)))
    assert np.repeat(values, np.maximum(lengths, 0))[: len(column)].tolist() == column.tolist()
    assert len(starts) == len(set(starts))


def test_shares_are_exact():
    whole = 8_999_999_999_999_999
    counts = np.array([0, 1, 12_345_678_901_234, whole - 1, whole])
    assert divergence.share(counts, whole).tolist() == [1 + 10**9 * int(c) // whole for c in counts]


def test_interactions_of_messy_rows(docs, labels, sql):
    same(interactions.op13_interactions(docs, labels).toPandas(), sql.execute(interactions.ORACLE).df())


def test_walk_against_all_subsets():
    counts = np.random.default_rng(5).integers(0, 100, (32, 3))
    survivors = interactions.gray_walk(counts)
    for subset in range(32):
        assert survivors[subset].tolist() == sum((counts[m] for m in range(32) if not m & subset), np.zeros(3, int)).tolist()


def test_interactions_by_hand(spark):
    """Each order applied to the rows themselves."""
    rows = [(i, random.Random(i).choice(["a A $", "word " * 250, " ".join(map(str, range(250))), "X" * 30, "a A $"]), "en", "s") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(30)], "doc_id long, quality int, toxic int")
    got = interactions.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), labels).toPandas().set_index(["filter_order", "step"])
    texts = [t for _, t, _, _ in rows]

    def fails(f, i):
        t, w = texts[i], texts[i].split()
        return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t), "E": t in texts[:i]}[f]

    removed = {f: 0 for f in "ABCDE"}
    for order in permutations("ABCDE"):
        left = list(range(40))
        for step, f in enumerate(order, 1):
            gone = [i for i in left if fails(f, i)]
            left = [i for i in left if i not in gone]
            row = got.loc["".join(order), step]
            removed[f] += len(gone)
            assert (row.kept, row.removed, row.redundant) == (len(left), len(gone), sum(fails(f, i) for i in range(40)) - len(gone))
            assert (row.good_lost, row.toxic_lost) == (sum(i % 2 for i in gone if i < 30), sum(i % 3 == 0 for i in gone if i < 30))
    assert all(got.loc["".join(o), s].shapley == removed[o[s - 1]] for o in permutations("ABCDE") for s in (1, 5))


SLOW = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_ids_are_the_tokenizer_s(text):
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert encode.fast is not None
    assert encode.ids(text).tolist() == SLOW.encode(text, add_special_tokens=False).ids


def check_packing(got, rows, capacity=1024):
    """Every document's ids in order and whole, sequences without gaps; returns the number of sequences."""
    ids = {i: np.array([*SLOW.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in rows}
    for doc, some in got.groupby("doc_id", dropna=False):
        some = some.sort_values("piece").drop_duplicates("piece")
        mine = ids[None if pd.isna(doc) else int(doc)]
        assert some.length.sum() == len(mine) and some.start.tolist() == (some.length.cumsum() - some.length).tolist()
        assert (some.length[1:] == capacity).all() and len(some) == -(-len(mine) // capacity) and some.piece.tolist() == list(range(len(some)))
        assert all(zlib.crc32(mine[s : s + n].tobytes()) == c for s, n, c in zip(some.start, some.length, some.ids_crc32))
    got = got.sort_values(["sequence_id", "offset"])
    filled = got.groupby("sequence_id").length
    assert (filled.cumsum() - got.length == got.offset).all() and filled.sum().max() <= capacity
    return got.sequence_id.nunique()


def test_packing_of_messy_rows(docs):
    rows = [(i, t) for i, t, _, _ in ROWS if i is not None]
    got = packing.op12_packing(docs.where("doc_id IS NOT NULL")).toPandas()
    assert check_packing(got, rows) == -(-got.length.sum() // 1024)
    assert got[got.doc_id == 4].length.tolist() == [1] and len(got[got.doc_id == 7]) == 2
    null = packing.op12_packing(docs.where("doc_id IS NULL")).toPandas()
    assert null.doc_id.isna().all() and len(null) == 2


def test_packing_in_many_cells(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    got = packing.pack(docs, cell=25).toPandas()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert set(got.doc_id) == {i for i, _ in rows}
    assert check_packing(got, rows) <= 1.05 * got.length.sum() / 1024 + 1
    assert check_packing(packing.pack(docs).toPandas(), rows) <= 1.01 * got.length.sum() / 1024 + 1


def fewest(lengths, capacity):
    """By trying all places of all pieces."""
    best = [len(lengths)]

    def go(i, room):
        if len(room) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(room)
            return
        for k in {r: k for k, r in enumerate(room) if r >= lengths[i]}.values():
            go(i + 1, [r - lengths[i] * (j == k) for j, r in enumerate(room)])
        go(i + 1, [*room, capacity - lengths[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_evolved_packings_are_the_fewest(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(10, 70, 12))[::-1].copy()
    bound, fewest_bins = packing.least_bins(lengths, 100), fewest(lengths.tolist(), 100)
    assert bound <= fewest_bins
    population = [packing.first_packing(lengths, 100)] + [packing.first_packing(lengths, 100, rng) for _ in range(5)]
    best = packing.evolve(lengths, population, 100, bound, rng)[0]
    assert np.bincount(best, lengths).max() <= 100 and best.max() + 1 == fewest_bins


def test_crossover_beats_best_fit():
    """Pieces that fill bins by threes, where best fit needs more."""
    rng = np.random.default_rng(1)
    a = rng.integers(380, 490, 40)
    b = np.array([rng.integers(190, (1000 - x) // 2 + 1) for x in a])
    lengths = np.sort(np.concatenate([a, b, 1000 - a - b]))[::-1].copy()
    population = [packing.first_packing(lengths, 1000)] + [packing.first_packing(lengths, 1000, rng) for _ in range(5)]
    before = int(population[0].max()) + 1
    for epoch in range(3):
        population = packing.evolve(lengths, population, 1000, 40, np.random.default_rng(epoch))
    assert before == 43 and population[0].max() + 1 <= 41
    assert np.bincount(population[0], lengths).max() <= 1000 and len(population[0]) == len(lengths)


def test_empty_tables(docs, labels):
    empty = docs.limit(0)
    assert divergence.op11_divergence(empty).count() == 0
    assert packing.op12_packing(empty).count() == 0
    assert interactions.op13_interactions(empty, labels.limit(0)).count() == 0
    got = interactions.op13_interactions(docs, labels.limit(0)).toPandas()
    assert len(got) and not got.good_lost.any()
