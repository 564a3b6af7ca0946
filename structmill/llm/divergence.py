"""How far the sources of a language are from each other, and which terms set one apart.

Each task counts the terms of its texts by language and source in blocks of
bounded size; Spark adds them, keeps a language's terms in at least ``MIN_DOCS``
documents, and writes each term's counts as one sparse row over the sources.

A pair's divergence is a sum over all kept terms, seen or not.  The vocabulary is
reordered so that equal counts lie together (sources with few documents, whose
counts take few values, lead the order), and terms with the same counts everywhere
are one row with a length.  Blocks of such rows hold the sources' counts as
run-length columns; for each pair the boundaries of both columns' runs are
intersected, and f of each stretch is multiplied by its length.  Spark adds the
blocks' sums.

Arithmetic is exact in 64 bits for groups of fewer than 9e15 terms.  A task
holds one block: at most about ``BLOCK`` counts, and the language's sources.

Defined cases: null text, lang and source are ''; texts without terms still make
their group occur; repeated rows count each; a group without kept terms has the
shares of unseen terms only; without documents there are no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from structmill.llm.shared import saved, short_batches

UNIT = 1_000_000_000
MIN_DOCS = 3
TOP = 200
#: Counts of a block of the reordered vocabulary.
BLOCK = 1 << 19
#: Distinct terms that a task holds before it sends them on, and bytes of a text split at once.
HELD = 200_000
PIECE = 1 << 20
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists of bounded size (but for one longer term)."""
    text = text.translate(_LETTERS)
    at = 0
    while at < len(text):
        end = at + PIECE if at + PIECE < len(text) else len(text)
        if end < len(text):
            cut = text.rfind(b" ", at, end)
            end = cut if cut > at else (text.find(b" ", end) + 1 or len(text))
        yield text[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = defaultdict(Counter), defaultdict(Counter)
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.large_binary())):
            group, seen = (lang, source), set()
            for terms in _pieces(text.as_py()):
                total[group].update(terms)
                seen.update(terms)
            docs[group].update(seen)
            if sum(map(len, docs.values())) > HELD:
                yield from _counted(total, docs)
                total, docs = defaultdict(Counter), defaultdict(Counter)
    yield from _counted(total, docs)


def _counted(total, docs) -> Iterator[pa.RecordBatch]:
    for (lang, source), counts in total.items():
        terms = pa.array(counts, pa.binary()).cast(pa.string())
        held = docs[lang, source]
        columns = [pa.array([lang] * len(counts), pa.string()), pa.array([source] * len(counts), pa.string()), terms, pa.array(counts.values(), pa.int64()), pa.array([held[t] for t in counts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def share(count, whole):
    """1 + floor(UNIT * count / whole) of whole numbers, count <= whole, without products above 1000 * whole; on columns or arrays."""
    column = not isinstance(count, np.ndarray)
    out = F.lit(0) if column else np.zeros_like(count)
    for _ in range(3):
        count = count * 1000
        out = out * 1000 + (F.call_function("div", count, whole) if column else count // whole)
        count = count % whole
    return out + 1


def runs(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length column: first rows and values of its runs, from the ascending ``rows`` whose ``values`` are not zero."""
    if not len(rows):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    new = np.append(True, (rows[1:] != rows[:-1] + 1) | (values[1:] != values[:-1]))
    start, value = rows[new], values[new]
    end = rows[np.append(new[1:], True)] + 1
    gap = np.append(end[:-1] != start[1:], True)
    starts, at = np.append(start, end[gap]), np.append(value, np.zeros(gap.sum(), np.int64))
    if start[0]:
        starts, at = np.append(starts, 0), np.append(at, 0)
    order = np.argsort(starts, kind="stable")
    return starts[order], at[order]


def _pairs(vectors: pa.Table, sources: pa.Table) -> pa.Table:
    """The sums of f over the block's terms for each two sources, in both directions."""
    lang = sources.column("lang")[0].as_py() if len(sources) else None
    counts = vectors.column("counts").combine_chunks()
    counts = counts.combine_chunks() if isinstance(counts, pa.ChunkedArray) else counts
    length = vectors.column("length").to_numpy()
    offsets, flat = counts.offsets.to_numpy(), counts.values
    place, n = flat.field("place").to_numpy(), flat.field("n").to_numpy()
    # rows of equal leading counts become neighbours: big-endian bytes sort as the numbers do
    packed = np.empty(len(place), [("place", ">u4"), ("n", ">u8")])
    packed["place"], packed["n"] = place, n
    packed, width = packed.tobytes(), packed.itemsize
    keys = [packed[a * width : b * width] for a, b in zip(offsets[:-1], offsets[1:])]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    del packed, keys
    position = np.empty(len(order), np.int64)
    position[order] = np.arange(len(order))
    row = np.repeat(position, np.diff(offsets))
    before = np.append(0, np.cumsum(length[order]))
    by = np.lexsort((row, place[offsets[0] : offsets[-1]]))
    row, place, n = row[by], place[offsets[0] : offsets[-1]][by], n[offsets[0] : offsets[-1]][by]
    columns = []
    for at, total, vocabulary in sorted(zip(*(sources.column(c).to_pylist() for c in ("place", "terms", "vocabulary")))):
        lo, hi = np.searchsorted(place, (at, at + 1))
        starts, values = runs(row[lo:hi], n[lo:hi])
        columns.append((at, starts, share(values + 1, total + vocabulary)))
    out: list[tuple[int, int, int]] = []
    for (a, starts, p), (b, others, q) in combinations(columns, 2):
        bounds = np.union1d(starts, others)
        bounds = bounds[bounds < len(order)]
        stretch = np.diff(before[np.append(bounds, len(order))])
        x, y = p[np.searchsorted(starts, bounds, "right") - 1], q[np.searchsorted(others, bounds, "right") - 1]
        square = (x - y) * (x - y)
        out += [(a, b, int((square // y * stretch).sum())), (b, a, int((square // x * stretch).sum()))]
    first, second, value = zip(*out) if out else ((), (), ())
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "place": pa.array(first, pa.int32()), "other": pa.array(second, pa.int32()), "value": pa.array(value, pa.int64())})


def vocabulary(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Saved kept terms (lang, term, total, counts of place and n), and groups (lang, source, place, terms, lang_terms, vocabulary)."""
    texts = short_batches(docs).select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = texts.groupBy("lang", "source").count()
    groups = saved(groups.select("lang", "source", F.row_number().over(Window.partitionBy("lang").orderBy("count", "source")).alias("place")), "groups")
    counts = texts.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    listed = F.sort_array(F.collect_list(F.struct("place", "n"))).alias("counts")  # at most one entry a source
    terms = counts.join(groups, ["lang", "source"]).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), listed)
    terms = saved(terms.where(F.col("docs") >= MIN_DOCS).select("lang", "term", "total", "counts"), "terms")
    sizes = terms.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("total").alias("lang_terms"))
    held = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.place").alias("place")).agg(F.sum("c.n").alias("terms"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("terms", "lang_terms", "vocabulary")]
    groups = groups.join(held, ["lang", "place"], "left").join(sizes, "lang", "left").select("lang", "source", "place", *zero)
    return terms, saved(groups, "group-sums")


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source) and value, by run-length columns."""
    vectors = terms.groupBy("lang", "counts").agg(F.count("*").alias("length"))
    blocks = terms.groupBy("lang").agg(F.ceil(F.sum(F.size("counts")) / BLOCK).alias("blocks"))
    vectors = vectors.join(blocks.toDF("lang", "many"), "lang").withColumn("block", F.pmod(F.xxhash64("counts"), "many"))
    spread = groups.join(blocks, "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    parts = vectors.select("lang", "block", "counts", "length").groupBy("lang", "block").cogroup(spread.groupBy("lang", "block"))
    sums = parts.applyInArrow(_pairs, "lang string, place int, other int, value long").groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("other"))
    named = groups.select("lang", "source", "place").join(other, "lang").where("place <> other")  # the result's own rows
    return named.join(sums, ["lang", "place", "other"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))


def marked_terms(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (a term commoner in the source than in its language) and value."""
    seen = terms.select("lang", F.col("term").alias("item"), "total", F.explode("counts").alias("c")).select("*", "c.place", "c.n").join(groups, ["lang", "place"])
    seen = seen.withColumn("p", share(F.col("n") + 1, F.col("terms") + F.col("vocabulary"))).withColumn("q", share(F.col("total") + 1, F.col("lang_terms") + F.col("vocabulary")))
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    return seen.where("p > q").select("lang", "source", "item", value.alias("value"))


def audit(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: all other sources, and the ``top`` terms of each group."""
    terms, groups = vocabulary(docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = source_pairs(terms, groups).withColumn("rank", rank)
    best = marked_terms(terms, groups).withColumn("rank", rank).where(F.col("rank") <= top)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").unionByName(columns(best, "term"))


def op11_divergence(docs: DataFrame) -> DataFrame:
    """The audit of whole documents; cases as above (a language with one source has no pairs)."""
    return audit(docs)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS total FROM kept GROUP BY lang),
n AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(n.total, 0) + v.v) AS p,
    1 + 1000000000::HUGEINT * (kept.total + 1) // (v.total + v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
