"""Packing token pieces of documents into sequences: a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens: only longer ones are cut,
into full pieces after a shorter first one, and a full piece is a sequence of its
own.  The other pieces are dealt at random into cells of about ``CELL``; several
islands evolve packings of each cell, each in its own row of a Spark table:
crossover injects whole well-filled bins of one parent into the other, bins that
hold a piece twice go, and their displaced pieces are placed by best fit, longest
first.  Between epochs the best packing of each island migrates to the next one
by a join; cells that have reached a lower bound of their number of bins, or that
an epoch has not helped, leave.  Each cell then gives up its least filled bin; what they held is dealt into
fewer cells and packed again, until one cell is left.

A cell's pieces, and the packings of one island of one cell, are what a task holds
at once.  Draws are seeded by cell, island and epoch, from saved rows.

Defined cases: null and empty texts have the end token alone; repeated rows are
packed each; without documents there are no rows.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from structmill.llm.shared import discard, saved, short_batches

CAPACITY, END = 1024, 2
#: Bins of a child that exchange pieces with the displaced ones, drawn anew for each child.
TRIED = 100
CELL, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 1000, 3, 3, 6, 4


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a tokenizer file, without special tokens added.

    Byte-level vocabularies whose ids follow their merges are encoded by rank
    (the same ids, several times faster), but for texts that hold an added token.
    """

    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = None
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        if plain and all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges)):
            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in self.added}
            self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(a in text for a in self.added):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


encoder = lru_cache(2)(Encoder)
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones, after a shorter first one."""
    if tokens <= capacity:
        return [(0, tokens)]
    first = tokens % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, tokens, capacity)]


def _tokenize(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path)
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            ids = np.append(encode.ids(text.as_py()), np.uint32(end)).astype("<u4")
            rows += [(doc, k, start, n, zlib.crc32(ids[start : start + n])) for k, (start, n) in enumerate(cuts(len(ids), capacity))]
        columns = zip(*rows) if rows else ((),) * 5
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Saved pieces with a key ``row``: doc_id, piece, start, length and the crc32 of their ids."""
    texts = short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cut = texts.mapInArrow(partial(_tokenize, path=path, capacity=capacity, end=end), _PIECES)
    return saved(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound of the bins: large pieces exclude each other, and leave room for what the smaller ones need."""
    total = np.append(0, np.cumsum(lengths))  # longest first
    above = lambda x: int(np.searchsorted(-lengths, -x, "left"))  # pieces longer than x
    half = above(capacity // 2)
    best = -(-int(total[-1]) // capacity)
    for k in np.unique(lengths[half:]):
        alone, from_k = above(capacity - k), above(k - 1)
        room = (half - alone) * capacity - (total[half] - total[alone])
        best = max(best, half - -(-max(0, int(total[from_k] - total[half] - room)) // capacity))
    return max(best, half)


def best_fit(order: list[int], lengths: list[int], capacity: int, bins: list[int], free: list[tuple[int, int]], new: int) -> int:
    """Places the pieces ``order`` in ``bins``, each where least room stays; ``free`` holds sorted (room, bin); returns the next bin."""
    for i in order:
        at = bisect_left(free, (lengths[i],))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b, new = capacity, new, new + 1
        bins[i] = b
        if room > lengths[i]:
            insort(free, (room - lengths[i], b))
    return new


def _dense(bins) -> np.ndarray:
    return np.unique(np.asarray(bins), return_inverse=True)[1].astype(np.int32)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    """Fewer bins first, then the more unequally filled packing, whose free room is in few places."""
    fill = np.bincount(bins, lengths) / capacity
    return float((fill**2).mean()) - len(fill)


def cross(into: np.ndarray, donor: np.ndarray, lengths: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Whole well-filled bins of ``donor`` in ``into``: bins that share a piece with them go, and their other pieces are placed by best fit."""
    fill = np.bincount(donor, lengths)
    ranked = np.argsort(-(fill + rng.random(len(fill)) * capacity * 0.1))
    chosen = np.zeros(len(fill), bool)
    well = ranked[: max(1, len(ranked) // 2)]
    chosen[rng.permutation(well)[: max(1, len(well) // 2)]] = True
    injected = chosen[donor]
    spoilt = np.zeros(into.max() + 1, bool)
    spoilt[into[injected]] = True
    # beside duplicates, a few poorly filled bins are opened
    mine = np.bincount(into, lengths)
    spoilt[np.argsort(mine + rng.random(len(mine)) * capacity * 0.2)[: 1 + len(mine) // 50]] = True
    child = np.where(injected, donor + len(spoilt), into)
    displaced = np.flatnonzero(~injected & spoilt[into]).tolist()
    room = capacity - np.bincount(child, lengths, len(spoilt) + len(fill)).astype(np.int64)
    held = np.zeros(len(room), bool)
    held[child] = True
    held[: len(spoilt)] &= ~spoilt
    loose, sizes, room, out = np.flatnonzero(held & (room > 0)), lengths.tolist(), room.tolist(), child.tolist()
    tried = np.zeros(len(room), bool)
    tried[rng.permutation(loose)[:TRIED]] = True
    displaced = exchange(displaced, np.flatnonzero((injected | ~spoilt[into]) & tried[child]).tolist(), sizes, out, room)
    best_fit(displaced, sizes, capacity, out, sorted((room[b], b) for b in loose.tolist() if room[b] > 0), len(room))
    return _dense(out)


def exchange(displaced: list[int], placed: list[int], lengths: list[int], bins: list[int], room: list[int]) -> list[int]:
    """Displaced pieces take the place of a shorter one where they fill its bin better, alone or in twos; what is then displaced, longest first."""
    waiting = sorted((lengths[i], i) for i in displaced)
    for i in placed:
        b = bins[i]
        own = lengths[i]
        if not waiting or not room[b]:
            continue
        most = own + room[b]
        at = bisect_left(waiting, (most + 1,)) - 1
        if at < 0:
            continue
        taken = [at]
        if waiting[at][0] < most:
            for low in (0, at // 2):  # a short one, and the longest that fits beside it
                other = min(bisect_left(waiting, (most - waiting[low][0] + 1,)) - 1, len(waiting) - 1)
                if other > low and waiting[low][0] + waiting[other][0] > sum(waiting[k][0] for k in taken):
                    taken = [other, low]
        length = sum(waiting[k][0] for k in taken)
        if length <= own:
            continue
        for k in taken:  # the larger place first
            bins[waiting.pop(k)[1]] = b
        room[b] = most - length
        bins[i] = -1
        insort(waiting, (own, i))
    return [i for _, i in reversed(waiting)]


def first_packing(lengths: np.ndarray, capacity: int, rng=None) -> np.ndarray:
    """Best fit, longest first; with ``rng`` the order is shaken."""
    order = np.arange(len(lengths)) if rng is None else np.argsort(-lengths * (1 - 0.3 * rng.random(len(lengths))), kind="stable")
    out = [0] * len(lengths)
    best_fit(order.tolist(), lengths.tolist(), capacity, out, [], 0)
    return _dense(out)


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, bound: int, rng) -> list[np.ndarray]:
    """``GENERATIONS`` of crossovers, best packing first; ends when the bound is reached."""
    ranked = sorted(((fitness(p, lengths, capacity), k, p) for k, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    made = len(ranked)
    for _ in range(GENERATIONS * POPULATION):
        if ranked[0][2].max() + 1 <= bound:
            break
        a, b = np.sort(rng.integers(0, len(ranked), (2, 2)), axis=1)[:, 0]  # the better of two, twice
        into, donor = ranked[a][2], ranked[b][2] if b != a else ranked[(a + 1) % len(ranked)][2]
        child = cross(into, donor, lengths, capacity, rng)
        value, made = fitness(child, lengths, capacity), made + 1
        if value > ranked[-1][0] and all(value != f for f, _, _ in ranked):
            ranked = sorted([*ranked[: POPULATION - 1], (value, made, child)], key=lambda x: (-x[0], x[1]))
    return [p for _, _, p in ranked]


_ISLANDS = "cell long, island int, bins int, bound int, before int, elite binary, population binary"


def _islands(batches: Iterator[pa.RecordBatch], epoch: int, capacity: int) -> Iterator[pa.RecordBatch]:
    """One row per island of a cell: its packings after an epoch, from those before and a neighbour's best."""
    for batch in batches:
        for r in batch.to_pylist():
            lengths = np.array([x["length"] for x in r["items"]], np.int64)
            bound = least_bins(lengths, capacity)
            rng = np.random.default_rng((r["cell"], r["island"], epoch))
            if r["population"] is None:
                population = [first_packing(lengths, capacity)]
                if population[0].max() + 1 > bound:
                    population += [first_packing(lengths, capacity, rng) for _ in range(POPULATION - 1)]
            else:
                population = list(np.frombuffer(r["population"], np.int32).reshape(-1, len(lengths)))
                if len(population) > 1:  # the migrant replaces the worst
                    population[-1] = np.frombuffer(r["migrant"], np.int32)
            before = min(int(p.max()) + 1 for p in population)
            population = evolve(lengths, population, capacity, bound, rng) if len(population) > 1 else population
            columns = [[r["cell"]], [r["island"]], [int(population[0].max()) + 1], [bound], [before], [population[0].tobytes()], [np.concatenate(population).tobytes()]]
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["cell", "island", "bins", "bound", "before", "elite", "population"])


def _places(batches: Iterator[pa.RecordBatch], capacity: int, release: bool) -> Iterator[pa.RecordBatch]:
    """row, sequence_id (the row of the sequence's first piece), offset, and whether its bin is given up."""
    for batch in batches:
        for r in batch.to_pylist():
            lengths = np.array([x["length"] for x in r["items"]], np.int64)
            rows = np.array([x["row"] for x in r["items"]], np.int64)
            bins = np.frombuffer(r["elite"], np.int32)
            order = np.argsort(bins, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(bins[order]) > 0))
            sizes = np.diff(np.append(first, len(order)))
            before = np.cumsum(lengths[order]) - lengths[order]
            offset = before - np.repeat(before[first], sizes)
            fill = np.bincount(bins, lengths)
            given = bins[order] == np.argmin(fill) if release and fill.min() < capacity else np.zeros(len(order), bool)
            columns = [rows[order], np.repeat(rows[order][first], sizes), offset, given, lengths[order]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "sequence_id", "offset", "given_up", "length"])


def _pack_cells(items: DataFrame, cells: int, capacity: int, release: bool, seed: int) -> DataFrame:
    """Saved places of the rows and lengths ``items``, dealt into ``cells``."""
    cell = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(cells)).alias("cell")
    listed = F.sort_array(F.collect_list(F.struct("length", "row")), asc=False).alias("items")  # about CELL of them
    dealt = saved(items.select(cell, "length", "row").groupBy("cell").agg(listed), "cells")
    islands = dealt.select("cell", "items", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    start = islands.select("*", F.lit(None).cast("binary").alias("population"), F.lit(None).cast("binary").alias("migrant"))
    epochs = []
    for epoch in range(EPOCHS):
        state = saved(start.repartition("cell", "island").mapInArrow(partial(_islands, epoch=epoch, capacity=capacity), _ISLANDS), "islands")
        epochs.append(state.withColumn("epoch", F.lit(epoch)))
        # a cell goes on while it is above its bound and still gains
        now = state.groupBy("cell").agg(F.min("bins").alias("bins"), F.max("bound").alias("bound"), F.min("before").alias("before"))
        going = now.where("bins > bound AND bins < before").select("cell")
        if epoch + 1 == EPOCHS or going.isEmpty():
            break
        migrants = state.select("cell", ((F.col("island") + 1) % ISLANDS).cast("int").alias("island"), F.col("elite").alias("migrant"))
        start = islands.join(going, "cell").join(state.select("cell", "island", "population"), ["cell", "island"]).join(migrants, ["cell", "island"])
    all_epochs = epochs[0]
    for state in epochs[1:]:
        all_epochs = all_epochs.unionByName(state)
    best = all_epochs.groupBy("cell").agg(F.min_by("elite", F.struct("bins", "epoch", "island")).alias("elite"))
    places = dealt.join(best, "cell").mapInArrow(partial(_places, capacity=capacity, release=release), "row long, sequence_id long, offset long, given_up boolean, length long")
    out = saved(places, "places")
    discard(dealt)
    return out


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, cell: int = CELL) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document."""
    cut = pieces(docs, path or public_tokenizers.path("byte_bpe_50k.json"), capacity, end)
    whole = F.col("length") == capacity
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    out = cut.where(whole).select("*", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).select(columns)
    left, level = cut.where(~whole).select("row", "length"), 0
    placed = None
    while True:
        cells = max(1, -(-left.count() // cell))
        places = _pack_cells(left, cells, capacity, cells > 1, level)
        mine = places.where(~F.col("given_up")).select("row", "sequence_id", "offset")
        placed = mine if placed is None else placed.unionByName(mine)
        if cells == 1:
            break
        left, level = places.where("given_up").select("row", "length"), level + 1
    return out.unionByName(cut.join(placed, "row").select(columns))


def op12_packing(docs: DataFrame) -> DataFrame:
    """Pieces of at most 1024 tokens packed into sequences; cases as above (every document has a piece)."""
    return pack(docs)
