"""Benchmark decontamination by a positional inverted index, in DataFrame functions only.

``build_index`` stores the postings (term, row, position) of the corpus's tokens
that any test item uses, and each document's length.  ``phrase_matches`` takes
of each test window the list of its rarest term, shifts it by the term's offset
to window starts, intersects it with the shifted list of the next rarest, and
then with all of them; ``proximity_matches`` lets each term stand a few words off.

Words: runs of 0-9, a-z (A-Z folded) and non-ASCII.  Defined cases: null texts
have no words; an item of fewer words than a window is one window, an item
without words none; equal windows of several items count for each; a null
item_id makes hits but is not listed; repeated documents are judged each on
their own; without items nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.llm.shared import keyed_rows, saved, small

WIDTH = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows up to which a side of a join is broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 200_000
#: Stands in the index for the end of a document: its position is the number of words.
END = ""


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, SEPARATORS), "")


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """phrase (array of words) and item_id of each window of each item, once."""
    rows = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    return rows.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("phrase")).distinct()


def build_index(docs: DataFrame, terms: DataFrame, row: Column | None = None) -> DataFrame:
    """Stored postings row, doc_id, term, pos of the given terms in all documents, and one END posting a document.

    ``row`` is a saved key of the documents' rows, if they have one.  Postings stay with their document's partition, so building it shuffles nothing.
    """
    row = F.monotonically_increasing_id() if row is None else row
    rows = docs.select("doc_id", row.alias("row"), words(F.col("text")).alias("w"))
    rows = rows.select("doc_id", "row", F.posexplode(F.array_append("w", F.lit(END))).alias("pos", "term"))
    known = terms.select("term").unionByName(terms.sparkSession.createDataFrame([(END,)], "term string"))
    return saved(rows.join(small(known, BROADCAST_ROWS), "term", "left_semi").select("row", "doc_id", "term", "pos"), "postings")


def _placed_terms(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """phrase, len, offset, term and rarity (1: rarest by postings) of the phrases whose terms all occur."""
    lists = index.where(F.col("term") != END).groupBy("term").agg(F.count("*").alias("postings"))
    each = phrases.select("phrase", F.size("phrase").alias("len"), F.posexplode("phrase").alias("offset", "term"))
    each = each.join(lists, "term")
    of = Window.partitionBy("phrase")
    each = each.withColumn("found", F.count("*").over(of)).where(F.col("found") == F.col("len"))
    return each.withColumn("rarity", F.row_number().over(of.orderBy("postings", "offset"))).select("phrase", "len", "offset", "term", "rarity")


def _starts(index: DataFrame, placed: DataFrame) -> DataFrame:
    """Window starts where the rarest term stands in place, and the next rarest too."""
    rarest = small(placed.where(F.col("rarity") == 1).drop("rarity"), BROADCAST_ROWS)
    found = index.join(rarest, "term").select("row", "phrase", "len", (F.col("pos") - F.col("offset")).alias("start")).where(F.col("start") >= 0)
    second = placed.where(F.col("rarity") == 2).select("phrase", F.col("offset").alias("offset2"), F.col("term").alias("term2"))
    found = found.join(small(second, BROADCAST_ROWS), "phrase", "left")
    # the next lists, of the rows that are still in question
    lists = index.join(small(second.select(F.col("term2").alias("term")).distinct(), BROADCAST_ROWS), "term", "left_semi")
    lists = lists.select(F.col("row").alias("row2"), F.col("term").alias("term2"), F.col("pos").alias("pos2"))
    alone = found.where(F.col("term2").isNull()).select("row", "phrase", "len", "start")
    both = found.where(F.col("term2").isNotNull()).withColumn("pos2", F.col("start") + F.col("offset2")).withColumnRenamed("row", "row2")
    both = both.join(lists, ["row2", "term2", "pos2"], "left_semi").select(F.col("row2").alias("row"), "phrase", "len", "start")
    return saved(alone.unionByName(both), "starts")


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """row, phrase, len and start of every exact occurrence of the distinct phrases."""
    placed = saved(_placed_terms(phrases.select("phrase").distinct(), index), "placed")
    starts = _starts(index, placed)
    open_rows = small(starts.select("row").distinct(), BROADCAST_ROWS)
    rest = placed.where(F.col("rarity") > 2).select("phrase", "offset", "term")
    rest = small(rest, BROADCAST_ROWS)
    asked = starts.where(F.col("len") > 2).join(rest, "phrase").withColumn("pos", F.col("start") + F.col("offset"))
    lists = index.join(small(placed.where(F.col("rarity") > 2).select("term").distinct(), BROADCAST_ROWS), "term", "left_semi").join(open_rows, "row", "left_semi")
    seen = asked.join(lists.select("row", "term", "pos"), ["row", "term", "pos"], "left_semi")
    seen = seen.groupBy("row", "phrase", "len", "start").count().where(F.col("count") == F.col("len") - 2).drop("count")
    return starts.where(F.col("len") <= 2).unionByName(seen)


def proximity_matches(index: DataFrame, phrases: DataFrame, slop: int = 2) -> DataFrame:
    """row, phrase, len and at (position of the rarest term) of every place where each other term stands within ``slop`` words of its place."""
    placed = saved(_placed_terms(phrases.select("phrase").distinct(), index), "placed")
    rarest = placed.where(F.col("rarity") == 1).select("phrase", "len", F.col("offset").alias("offset1"), "term")
    found = index.join(small(rarest, BROADCAST_ROWS), "term").select("row", "phrase", "len", "offset1", F.col("pos").alias("at"))
    found = saved(found, "near")
    others = placed.where(F.col("rarity") > 1).select("phrase", "offset", "term")
    asked = found.where(F.col("len") > 1).join(small(others, BROADCAST_ROWS), "phrase")
    # each place that a term may take is a key of its own, so that a long list is never scanned for a row
    asked = asked.withColumn("shift", F.explode(F.sequence(F.lit(-slop), F.lit(slop)))).withColumn("pos", F.col("at") + F.col("offset") - F.col("offset1") + F.col("shift"))
    lists = index.join(small(found.select("row").distinct(), BROADCAST_ROWS), "row", "left_semi").select("row", "term", "pos")
    seen = asked.join(lists, ["row", "term", "pos"], "left_semi").groupBy("row", "phrase", "len", "at").agg(F.count_distinct("offset").alias("n"))
    return found.where(F.col("len") == 1).select("row", "phrase", "len", "at").unionByName(seen.where(F.col("n") == F.col("len") - 1).drop("n"))


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, row: Column | None = None) -> DataFrame:
    """row, doc_id, n_words, n_hit (words inside any occurrence) and items (sorted texts of item_id) of every document."""
    windows = saved(item_windows(items, width), "windows")
    index = build_index(docs, windows.select(F.explode("phrase").alias("term")).distinct(), row)
    found = saved(phrase_matches(index, windows), "matches")
    hit = found.select("row", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    named = found.select("row", "phrase").distinct().join(small(windows, BROADCAST_ROWS), "phrase").groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    lengths = index.where(F.col("term") == END).select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = lengths.join(hit, "row", "left").join(named, "row", "left")
    return out.select("row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op10_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contamination(docs, items)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows without a hit, with their columns, each judged by its own text."""
    keyed, restored = keyed_rows(docs, "doc_id", "text")
    bad = contamination(keyed, items, row=F.col("row")).where(F.col("n_hit") > 0).select(F.col("row").alias("bad"))
    return restored(keyed.join(small(bad, BROADCAST_ROWS), F.col("row") == F.col("bad"), "left_anti"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS k, least(len(w), 10) AS n FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
m AS (SELECT doc_id, i, p.n, item_id FROM s JOIN p ON s.k = p.k AND s.n = p.n),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
