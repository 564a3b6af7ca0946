"""How filters act on each other: what every order of a set of filters keeps, removes and would have removed.

Spark reduces documents to cells: one row per part and set of failed filters,
with its documents, good ones and toxic ones.  A Gray-code walk then visits every
subset of filters and toggles one filter a step: each cell counts how many
active filters it fails, leaves the survivors as that count leaves zero, and
joins them again as it falls back.  What survives each subset is stored; each
step of an order is the difference of two stored subsets.

Whether a smaller doc_id has the same text is decided table-wide by one join of
documents to the least doc_id of each text on both columns, so that a text held
by many rows meets nowhere; texts are told apart by SHA-256.

Defined cases: null and empty texts are one text of no words; a null source is
the part ''; a null doc_id is smaller than none; rows of one doc_id are counted
each and do not make each other fail, with several labels of one doc_id any 1
counts; without documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.llm.shared import saved

FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
_SPACES = r"[\x20\x09-\x0D]+"


def failures(text) -> list:
    """Conditions under which the filters A to D reject a text; E needs the other texts."""
    words = F.array_remove(F.split(text, _SPACES), "")
    return [
        F.size(words) < 200,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) * 100 > F.length(text) * 2,
        text.rlike("[#$%&*|]"),
    ]


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit i: filter i fails), and the documents n, good and toxic of each cell."""
    text = F.coalesce("text", F.lit(""))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures(text))), F.lit(0))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("hash"), mask.alias("mask"))
    # equal rows become one before anything is shuffled by document
    rows = saved(narrow.groupBy("doc_id", "part", "hash", "mask").agg(F.count("*").alias("n")), "masks")
    least = rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id")).select("hash", "doc_id", F.lit(True).alias("least"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    repeats = F.col("doc_id").isNotNull() & F.col("least").isNull()
    joined = rows.join(least, ["doc_id", "hash"], "left").join(marks, "doc_id", "left")
    counted = [F.sum("n").alias("n")] + [F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")]
    return joined.groupBy("part", (F.col("mask") + F.when(repeats, 1 << 4).otherwise(0)).alias("mask")).agg(*counted)


def gray_walk(counts: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters, from ``counts`` [cell, ...] by mask; one filter is toggled a step."""
    states = len(counts)
    masks = np.arange(states)
    failing = np.zeros(states, int)
    running = counts.sum(0)
    survivors = np.empty_like(counts)
    survivors[0] = running
    active = 0
    for step in range(1, states):
        now = step ^ step >> 1
        toggled = now ^ active
        hit = np.flatnonzero(masks & toggled)
        if now & toggled:
            running = running - counts[hit[failing[hit] == 0]].sum(0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            running = running + counts[hit[failing[hit] == 0]].sum(0)
        active = now
        survivors[active] = running
    return survivors


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, filters before as a set, filter) of each step of each permutation."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(filters[i] for i in order), step, before, f))
            before |= 1 << f
    return out


_STEPS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _STEPS)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plan = orders()
    name, step = [o for o, _, _, _ in plan], np.array([s for _, s, _, _ in plan], np.int32)
    before, f = np.array([b for _, _, b, _ in plan]), np.array([f for _, _, _, f in plan])
    masks = np.arange(1 << len(FILTERS))
    for batch in batches:
        for part, *measures in zip(*(batch.column(c).to_pylist() for c in ("part", *MEASURES))):
            counts = np.array(measures, np.int64).T
            survivors = gray_walk(counts)
            kept = survivors[before | 1 << f]
            lost = survivors[before] - kept
            fails = np.array([counts[masks >> i & 1 == 1, 0].sum() for i in range(len(FILTERS))])
            shapley = np.bincount(f, lost[:, 0], len(FILTERS)).astype(np.int64)
            columns = [kept[:, 0], lost[:, 0], fails[f] - lost[:, 0], counts[1 << f, 0], lost[:, 1], lost[:, 2], shapley[f]]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(plan)), pa.array(name), pa.array(step), *map(pa.array, columns)], names=["part", "filter_order", "step", *_STEPS])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley of each part, order of filters and step."""
    states = 1 << len(FILTERS)
    table = F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*MEASURES))))
    whole = cells(docs, labels).groupBy("part").agg(table.alias("cell"))  # at most one entry a mask
    column = lambda m: F.transform(F.sequence(F.lit(0), F.lit(states - 1)), lambda i: F.coalesce(F.col("cell")[i][m], F.lit(0).cast("long")))
    return whole.select("part", *[column(m).alias(m) for m in MEASURES]).mapInArrow(_steps, SCHEMA)


def op13_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over whole documents; cases as above (no documents: no rows)."""
    return audit(docs, labels)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), least AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(marks.toxic, 0) AS toxic,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * (length(d.t) - length(regexp_replace(d.t, '[A-Z]', '', 'g'))) > 2 * length(d.t))::INT
    + 8 * regexp_matches(d.t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > first_id, false)::INT AS mask
  FROM d JOIN least ON d.t = least.t LEFT JOIN marks ON d.doc_id = marks.doc_id
), c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT i, substr('ABCDE', i + 1, 1) AS letter FROM range(5) AS r(i)),
o AS (
  SELECT [a.i, b.i, x.i, y.i, z.i] AS ids, a.letter || b.letter || x.letter || y.letter || z.letter AS filter_order
  FROM f a, f b, f x, f y, f z WHERE len(list_distinct([a.i, b.i, x.i, y.i, z.i])) = 5
), s AS (
  SELECT filter_order, step, ids[step] AS f, coalesce(list_sum(list_transform(ids[1:step - 1], lambda i: (1 << i)::INT)), 0)::INT AS before
  FROM o, range(1, 6) AS r(step)
), steps AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (mask & (before | (1 << f)::INT) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND (mask >> f) & 1 = 1), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & before <> 0 AND (mask >> f) & 1 = 1), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = (1 << f)::INT), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND (mask >> f) & 1 = 1), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND (mask >> f) & 1 = 1), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM steps
"""
