"""Documents linked by n-gram Jaccard similarity: a size-aware heavy-light join.

Documents with equal shingle sets are one class, represented by the smallest
doc_id.  Of a light class (few shingles) all subsets of the fixed size that a
pair of two sizes must share are enumerated as keys; of a heavy class the rarest
shingles, of which every partner must hold one (its prefix), are inverted lists
with the shingle's place: linked classes' first shared shingle stands early in both.
Sizes are light up to where enumerating costs more than scanning lists.  Classes
that share a key are candidates; exact set intersections decide.

Rarity comes from a count sketch of fixed size over all documents; it orders
shingles only, so results do not depend on it.  All pairs of a list are never
emitted.  A round tests a list's members against one member of it (its centre,
that with the fewest rarer shingles, which an original has among its copies)
and drops lists whose members are connected.  After ``ROUNDS`` rounds the few
members of a list that are not connected with its largest part ask all others,
block by block in tasks of their own, where sizes, places and histograms decide
before a pair is made.  So classes are connected exactly as all links would
connect them.

Defined cases: documents without words, null ones too, have 0 shingles and are
their own component; a null doc_id counts as the largest id, and each row without
one is a document of its own; for ``near_copies`` rows of one doc_id are one
document, while ``keep_one`` judges each row.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.llm import words as W
from structmill.llm.shared import discard, keyed_rows, saved, short_batches, small
from structmill.operators.components import connected_components

WIDTH, PERCENT = 3, 90
SKETCH_BITS, SLICE = 21, 1 << 15
LIGHT_AT_MOST = 64
#: Subsets of one set at most, for its worker's memory; sizes with more are heavy.
SUBSETS = 4096
HISTOGRAM = 64
#: Rounds of tests against centres, and members of a list in one task after them.
ROUNDS, BLOCK = 2, 512
#: Rows of an Arrow batch: of texts, and of pairs of whole sets.
TEXTS, PAIRS = 1000, 200
BROADCAST_ROWS = 300_000
_NONE = (1 << 63) - 1


def overlap(n, m, percent: int = PERCENT):
    """Least intersection of linked sets of n and m elements."""
    return -(-percent * (n + m) // (100 + percent))


def shingle_sets(column: pa.Array, width: int):
    """(first document, last + 1, shingle, document) by slices: each document's distinct shingle hashes, sorted."""
    for lo, hi, h, doc in W.words(column, True):
        s, inside = W.windows(h, doc, width)
        s, owner = s[inside], doc[: len(s)][inside]
        count = np.bincount(doc, minlength=hi - lo)
        short = np.flatnonzero((count > 0) & (count < width))
        if len(short):  # the whole sequence is the one shingle
            begin = np.searchsorted(doc, short)
            whole = np.zeros(len(short), np.uint64)
            with np.errstate(over="ignore"):
                for k in range(width - 1):
                    has = count[short] > k
                    whole[has] = W.mix(whole[has] + h[begin[has] + k], 500 + k)
            s, owner = np.append(s, W.mix(whole, 510)), np.append(owner, short)
        order = np.lexsort((s, owner))
        s, owner = s[order], owner[order]
        new = np.append(True, (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])) if len(s) else np.zeros(0, bool)
        yield lo, hi, s[new], owner[new]


def _bucket(s: np.ndarray) -> np.ndarray:
    return (W.mix(s, 520) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sketch(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents by shingle bucket, and documents by set size up to LIGHT_AT_MOST, over all documents; of fixed size."""

    def count(batches):
        counts, sizes = np.zeros(1 << SKETCH_BITS, np.uint32), np.zeros(SLICE, np.uint32)
        for batch in batches:
            for lo, hi, s, owner in shingle_sets(batch.column("text"), width):
                np.add.at(counts, _bucket(s), np.uint32(1))  # without a second table of its size
                n = np.bincount(owner, minlength=hi - lo)
                sizes[: LIGHT_AT_MOST + 1] += np.bincount(n[n <= LIGHT_AT_MOST], minlength=LIGHT_AT_MOST + 1).astype(np.uint32)
        parts = [sizes, *counts.reshape(-1, SLICE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([np.minimum(x, 65535).astype(np.uint16).tobytes() for x in parts])], names=["slice", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                x = np.frombuffer(x.as_buffer(), np.uint16)
                sums[k] = sums[k] + x if k in sums else x.astype(np.uint32)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()])], names=["slice", "counts"])

    kind = "slice int, counts binary"
    rows = short_batches(docs).select("text").mapInArrow(count, kind).repartition("slice").mapInArrow(add, kind).collect()
    parts = {r["slice"]: np.frombuffer(r["counts"], np.uint32) for r in rows}
    if not parts:
        return np.zeros(1 << SKETCH_BITS, np.uint32), np.zeros(LIGHT_AT_MOST + 1, np.uint32)
    return np.concatenate([parts[k] for k in range(1, len(parts))]), parts[0][: LIGHT_AT_MOST + 1]


def boundary(counts: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> int:
    """The largest light size: up to it, enumerating all sets' subsets costs no more than scanning their prefix lists."""
    length = counts.sum() / max(1, np.count_nonzero(counts))
    best, total, x = 0, 0.0, 0
    for n in range(1, LIGHT_AT_MOST + 1):
        subsets = sum(comb(n, gone) for _, gone in _light_sizes(n, percent))
        if subsets > SUBSETS:
            break
        total += max(int(sizes[n]), 1) * (subsets - _prefix(n, percent) * (1 + length))
        if total <= best:
            best, x = total, n
    return x


def _least(n, percent):
    """The size of the smallest partner of a set of n, which is also the least intersection with any."""
    return -(-percent * n // 100)


def _partners(n, percent):
    return range(_least(n, percent), 100 * n // percent + 1)


def _prefix(n, percent):
    """Rarest shingles of a set of n of which a linked set shares one."""
    return n - _least(n, percent) + 1


def _light_sizes(n: int, percent: int) -> list[tuple[int, int]]:
    """(size m of a partner, shingles of n that the shared subset leaves out)."""
    return [(m, n - c) for m in _partners(n, percent) if (c := overlap(n, m, percent)) <= min(n, m)]


def _light_keys(s: np.ndarray, n: np.ndarray, begin: np.ndarray, light: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all subsets that light sets share with linked sets of some size, and the set of each key."""
    keys, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for size in range(1, light + 1):
        every = np.flatnonzero(n == size)
        for m, gone in _light_sizes(size, percent) if len(every) else ():
            left_out = np.array(list(combinations(range(size), gone)), np.int64).reshape(comb(size, gone), gone)
            tag = np.uint64((min(size, m) << 20 | max(size, m)) * 0x9E3779B97F4A7C15 % 2**64)
            step = max(1, (1 << 20) // (len(left_out) * max(gone, 1)))
            for lo in range(0, len(every), step):
                some = every[lo : lo + step]
                matrix = s[begin[some][:, None] + np.arange(size)]
                with np.errstate(over="ignore"):
                    sums = matrix.sum(1, dtype=np.uint64)[:, None] - matrix[:, left_out].sum(2, dtype=np.uint64) + tag
                keys.append(W.mix(sums.ravel(), 536))
                owner.append(np.repeat(some, len(left_out)))
    return np.concatenate(keys), np.concatenate(owner)


def _describe(batches, width, percent, light, shared):
    """doc_id, n, two hashes of the set, its histogram and its keys, of each document with shingles."""
    counts = shared.value
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for lo, hi, s, owner in shingle_sets(batch.column("text"), width):
            n = np.bincount(owner, minlength=hi - lo)
            docs = np.flatnonzero(n)
            if not len(docs):
                continue
            n = n[docs]
            begin = np.cumsum(n) - n
            with np.errstate(over="ignore"):
                k1, k2 = np.add.reduceat(W.mix(s, 530), begin), np.add.reduceat(W.mix(s, 531), begin)
            at = np.repeat(np.arange(len(docs)), n)
            histogram = np.bincount(at * HISTOGRAM + (W.mix(s, 532) >> np.uint64(58)).astype(np.int64), minlength=len(docs) * HISTOGRAM)
            # prefixes of the sets that a heavy set can be linked with
            rarity = np.minimum(counts[_bucket(s)], 65535).astype(np.uint64) << np.uint64(48) | W.mix(s, 533) >> np.uint64(16)
            order = np.lexsort((rarity, at))
            length = np.where(100 * n >= percent * (light + 1), _prefix(n, percent), 0)
            place = np.arange(len(s)) - begin[at]
            mine = place < length[at]
            subsets, of = _light_keys(W.mix(s, 535), n, begin, light, percent)
            keys, place = np.append(W.mix(s[order[mine]], 534), subsets), np.append(place[mine], np.zeros(len(of), np.int64))
            of = np.append(at[mine], of)
            order = np.argsort(of, kind="stable")
            ends = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=len(docs)))).astype(np.int32))
            lists = lambda x: pa.ListArray.from_arrays(ends, pa.array(x[order]))  # noqa: B023, E731
            histogram = pa.ListArray.from_arrays(pa.array(np.arange(0, len(histogram) + 1, HISTOGRAM, np.int32)), pa.array(histogram.astype(np.int32)))
            columns = [pa.array(ids[lo + docs]), pa.array(n.astype(np.int64)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), histogram, lists(keys.view(np.int64)), lists(place.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "k1", "k2", "histogram", "keys", "places"])


def _whole_sets(batches, width):
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for lo, hi, s, owner in shingle_sets(batch.column("text"), width):
            n = np.bincount(owner, minlength=hi - lo)
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi]), pa.array([s[b - k : b].tobytes() for b, k in zip(ends, n)])], names=["doc_id", "set"])


def _near_histograms(batches, percent):
    """Pairs whose histograms differ no more than linked sets' can; the difference bounds that of the sets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch.column(c).flatten().to_numpy().reshape(-1, HISTOGRAM).astype(np.int64) for c in ("ha", "hb"))
        na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
        keep = np.abs(a - b).sum(1) <= na + nb - 2 * overlap(na, nb, percent)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _linked(batches, percent):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            keep.append(int((both[1:] == both[:-1]).sum()) >= overlap(len(x), len(y), percent))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame | None:
    """The linked pairs a, b among the candidate pairs; None for none."""
    side = lambda k: classes.select(F.col("rep").alias(k), F.col("n").alias(f"n{k}"), F.col("histogram").alias(f"h{k}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ha", "hb")
    near = saved(near.mapInArrow(partial(_near_histograms, percent=percent), "a long, b long"), "near")
    if near.isEmpty():
        return None
    ids = saved(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), "ids")
    sets = docs.join(small(ids, BROADCAST_ROWS), "doc_id", "left_semi")
    sets = saved(sets.mapInArrow(partial(_whole_sets, width=width), "doc_id long, set binary"), "sets", TEXTS)
    both = near.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("sb")), "b").join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("sa")), "a")
    links = saved(both.select("a", "b", "sa", "sb").mapInArrow(partial(_linked, percent=percent), "a long, b long"), "links", PAIRS)
    discard(near, ids, sets)
    return None if links.isEmpty() else links


def near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # rows without an id have saved keys, from the largest number down
    nameless = saved(rows.where("doc_id is null").select((F.lit(_NONE) - F.monotonically_increasing_id()).alias("doc_id"), "text"), "nameless")
    out = _components(rows.where("doc_id is not null").unionByName(nameless), width, percent)
    keys = small(nameless.select(F.col("doc_id").alias("__key")), BROADCAST_ROWS)
    null = lambda c: F.when(F.col("__key").isNull(), F.col(c)).alias(c)
    out = out.join(keys, F.col("doc_id") == F.col("__key"), "left").select(null("doc_id"), "n_shingles", "component_id")
    return out.join(keys, F.col("component_id") == F.col("__key"), "left").select("doc_id", "n_shingles", null("component_id"))


def _mixed(lists: DataFrame) -> DataFrame:
    """The lists whose members are not all connected, with the number of members and, of those in the largest connected part (main), whether they are."""
    parts = lists.groupBy("key", "c").agg(F.count("*").alias("many"))
    found = parts.groupBy("key").agg(F.sum("many").alias("members"), F.max(F.struct("many", "c")).alias("top"), F.count("*").alias("parts")).where(F.col("parts") > 1)
    found = found.select("key", "members", (F.col("members") - F.col("top.many")).alias("asking"), F.col("top.c").alias("main_c"))
    return lists.join(found, "key").withColumn("main", F.col("c") == F.col("main_c")).drop("main_c")


def _other(lists: DataFrame, *more: str) -> DataFrame:
    return lists.select("key", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "place", "c", *more)])


def _candidates(both: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of members of one list that may be linked and are not connected."""
    # if this is the first shared shingle in order of rarity, none before its place is shared
    room = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2")) * (100 + percent) >= (F.col("n") + F.col("n2")) * percent
    fits = (F.greatest("n", "n2") * percent <= F.least("n", "n2") * 100) & room & (F.col("c") != F.col("c2"))
    return both.where(fits).select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


def _with_centres(lists: DataFrame) -> DataFrame:
    """Each member beside its list's centre, which stands outside the largest connected part where there is one."""
    first = [F.col("main2")] * ("main" in lists.columns) + [F.col("place2"), F.xxhash64("rep2").alias("h"), F.col("rep2"), F.col("n2"), F.col("c2")]
    other = _other(lists, *["main"] * ("main" in lists.columns))
    centre = other.groupBy("key").agg(F.min(F.struct(*first)).alias("m")).select("key", "m.rep2", "m.n2", "m.place2", "m.c2")
    return lists.join(centre, "key")


def _asked(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Members outside their list's largest part beside all other members, by pairs of blocks; the histograms' bound on the difference goes into the join."""
    rows = lists.join(small(classes.join(lists.select("rep").distinct(), "rep", "left_semi").select("rep", "histogram"), BROADCAST_ROWS // 10), "rep")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    own = lambda n: F.pmod(F.xxhash64("rep"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    asks = rows.where(~F.col("main")).withColumn("i", own("asking")).withColumn("j", every("members"))
    waits = rows.withColumn("j", own("members")).withColumn("i", every("asking"))
    waits = _other(waits, "histogram", "i", "j").withColumnsRenamed({"i2": "i", "j2": "j"})
    difference = F.aggregate(F.zip_with("histogram", "histogram2", lambda x, y: F.abs(x - y)), F.lit(0), lambda a, x: a + x)
    apart = (F.col("n") + F.col("n2") - difference) * (100 + percent) >= 2 * percent * (F.col("n") + F.col("n2"))
    return asks.join(waits, ["key", "i", "j"]).where(apart)


def _components(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id (its smallest doc_id) of every row; doc_id is a long and never null."""
    counts, sizes = sketch(rows, width)
    light = boundary(counts, sizes, percent)
    shared = rows.sparkSession.sparkContext.broadcast(counts)
    kind = "doc_id long, n long, k1 long, k2 long, histogram array<int>, keys array<bigint>, places array<int>"
    sets = saved(rows.mapInArrow(partial(_describe, width=width, percent=percent, light=light, shared=shared), kind), "described", TEXTS)
    shape = ["n", "k1", "k2"]
    reps = saved(sets.groupBy(*shape).agg(F.min("doc_id").alias("rep")), "reps")
    classes = sets.join(reps.withColumnRenamed("rep", "doc_id"), [*shape, "doc_id"]).dropDuplicates([*shape, "doc_id"])
    classes = saved(classes.select(F.col("doc_id").alias("rep"), "n", "histogram", "keys", "places"), "classes")
    members = saved(sets.select("doc_id", *shape), "members")
    discard(sets)

    listed = classes.select(F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("places").alias("place"))), "rep", "n")
    several = listed.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > 1).select("key")
    lists = saved(listed.join(several, "key", "left_semi").withColumn("c", F.col("rep")), "lists")
    save = partial(saved, name="components")
    links = found = None

    def connect(pairs):
        nonlocal links, found
        new = _verified(pairs, classes, rows, width, percent)
        if new is None:
            return
        old, links = links, new if links is None else saved(links.union(new), "links")
        marks = saved(connected_components(links.toDF("u", "v"), save), "found")
        discard(found, *((old, new) if old is not None else ()))
        found = marks

    for _ in range(ROUNDS):
        connect(_candidates(_with_centres(lists), percent))
        plain = lists.select("key", "place", "rep", "n")
        if found is not None:
            marks = small(found.withColumnsRenamed({"node": "rep", "component": "to"}), BROADCAST_ROWS)
            plain = plain.join(marks, "rep", "left").withColumn("c", F.coalesce("to", "rep")).drop("to")
        else:
            plain = plain.withColumn("c", F.col("rep"))
        old, lists = lists, saved(_mixed(plain), "lists")
        discard(old)
        if lists.isEmpty():
            break
    else:
        connect(_candidates(_asked(lists, classes, percent), percent))
    out = members.join(reps, shape)
    if found is not None:
        out = out.join(small(found.withColumnsRenamed({"node": "rep"}), BROADCAST_ROWS), "rep", "left").withColumn("component_id", F.coalesce("component", "rep"))
    else:
        out = out.withColumn("component_id", F.col("rep"))
    empty = rows.join(members.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(empty)


def op2_jaccard(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; rows without words or text have 0 shingles and their own id, null for a null doc_id."""
    return near_copies(docs)


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, that with the smallest doc_id (null last), with its columns; of rows of one doc_id without words, equal texts once."""
    keyed, restored = keyed_rows(docs, "doc_id", "text")
    found = _components(keyed.select(F.col("row").alias("doc_id"), "text"), width, percent).toDF("row", "n", "component")
    rows = found.join(keyed.select("row", "doc_id", F.xxhash64("text").alias("h")), "row")
    repeats = (F.col("n") == 0) & F.col("doc_id").isNotNull()
    of = [F.when(~repeats, F.col("component")).alias("component"), F.when(repeats, F.col("doc_id")).alias("id"), F.when(repeats, F.col("h")).alias("text")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "h", "row")).alias("m")
    chosen = saved(rows.groupBy(*of).agg(first).select(F.col("m.row").alias("kept")), "kept")
    return restored(keyed.join(small(chosen, BROADCAST_ROWS), F.col("row") == F.col("kept"), "left_semi"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY d.doc_id, n
"""
