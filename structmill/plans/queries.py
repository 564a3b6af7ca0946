"""The operators bound to the test tables, each with the same result in DuckDB's SQL.

Orders stand for structures, lineitems for units and their annotations, parts,
suppliers, customers and nations for dimensions, events for annotations over
time, documents for sequences, and embeddings for coordinates.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from structmill.functions import geometry, ids, sequences
from structmill.operators import aggregates as agg
from structmill.operators import clustering, lineage, quality, relational, resolve, superposition, windows
from structmill.operators.components import connected_components
from structmill.shared import parts_of, saved

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(*tables: str, sql: str | None = None):
    """Registers a function of tables under its name."""

    def register(function):
        def run(spark, sf_dir):
            return function(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

        QUERIES[function.__name__] = run
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def cents(c):
    """Money as whole cents, so that sums do not depend on their order."""
    return F.round(F.col(c) * 100).cast("long")


def units(lineitem):
    """A unit is a part of an order; (order, line number) is not unique."""
    return lineitem.groupBy("l_orderkey", "l_partkey").agg(F.min("l_suppkey").alias("suppkey"), F.min("l_linenumber").alias("line"))


UNITS = "units AS (SELECT l_orderkey, l_partkey, min(l_suppkey) AS suppkey, min(l_linenumber) AS line FROM lineitem GROUP BY 1, 2)"


@query("lineitem", sql=f"WITH {UNITS} SELECT a.l_orderkey, a.l_partkey AS l_partkey_1, b.l_partkey AS l_partkey_2, a.line AS line_1, b.line AS line_2 FROM units a JOIN units b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey")
def pair_forward_dedupe(lineitem):
    return relational.pairs_within(units(lineitem), "l_orderkey", "l_partkey", ("line",))


@query("lineitem", sql=f"WITH {UNITS} SELECT a.suppkey AS s1, b.suppkey AS s2, count(*) AS n FROM units a JOIN units b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey AND a.suppkey <> b.suppkey GROUP BY 1, 2")
def cross_group_pairs(lineitem):
    pairs = relational.pairs_within(units(lineitem), "l_orderkey", "l_partkey", ("suppkey",))
    return pairs.where("suppkey_1 != suppkey_2").groupBy(F.col("suppkey_1").alias("s1"), F.col("suppkey_2").alias("s2")).agg(F.count("*").alias("n"))


@query("lineitem", sql="""
WITH p AS (SELECT 'u' || l_partkey AS unit_id_1, 'u' || l_suppkey AS unit_id_2, CASE l_returnflag WHEN 'A' THEN 'cWW' WHEN 'N' THEN 'tHS' ELSE 'ncWW' END AS f_lwbp, l_linenumber AS f_crossing FROM lineitem)
SELECT unit_id_1, unit_id_2, f_lwbp, f_crossing FROM p WHERE f_crossing <= 3 AND (f_lwbp = 'tHS' OR f_lwbp = 'cWW' AND unit_id_1 < unit_id_2)""")
def base_pairs(lineitem):
    kind = F.when(F.col("l_returnflag") == "A", "cWW").when(F.col("l_returnflag") == "N", "tHS").otherwise("ncWW")
    pairs = lineitem.select(F.concat(F.lit("u"), "l_partkey").alias("unit_id_1"), F.concat(F.lit("u"), "l_suppkey").alias("unit_id_2"), kind.alias("f_lwbp"), F.col("l_linenumber").alias("f_crossing"))
    families = lineitem.sparkSession.createDataFrame([("cWW", True, True, False), ("tHS", True, False, False), ("ncWW", True, True, True)], "bp_family_id string, is_forward boolean, is_symmetric boolean, is_near boolean")
    return relational.base_pairs(pairs, families, most_crossing=3).select("unit_id_1", "unit_id_2", "f_lwbp", "f_crossing")


@query("lineitem", sql="SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 30 AND NOT l_linestatus = 'O' AND l_discount IS NOT NULL")
def dynamic_predicates(lineitem):
    where = relational.all_of(F.col("l_returnflag").isin("A", "R"), F.col("l_quantity").between(10, 30), ~(F.col("l_linestatus") == "O"), F.col("l_discount").isNotNull(), None)
    return lineitem.where(where).select("l_orderkey", "l_partkey", "l_linenumber")


@query("customer", "orders", sql="SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY 1")
def left_const_on(customer, orders):
    right = orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    return relational.left_with_constant(customer, right, "c_custkey", o_orderstatus="F").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("lineitem", sql="""
WITH s AS (SELECT l_partkey AS a, l_suppkey AS b, min(l_linenumber) AS v FROM lineitem GROUP BY 1, 2), w AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem WHERE l_returnflag = 'A')
SELECT w.a, w.b, coalesce(f.v, r.v) AS v FROM w LEFT JOIN s f ON w.a = f.a AND w.b = f.b LEFT JOIN s r ON w.a = r.b AND w.b = r.a""")
def two_direction_left(lineitem):
    stored = lineitem.groupBy(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).agg(F.min("l_linenumber").alias("v"))
    wanted = lineitem.where("l_returnflag = 'A'").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).distinct()
    return relational.either_direction(wanted, stored, "a", "b", "v")


@query("region", "nation", "customer", "supplier", "part", "orders", "lineitem", sql="""
SELECT r_name, s.n_name AS supplier_nation, p_brand, o_orderpriority, count(*) AS n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation c ON c_nationkey = c.n_nationkey JOIN region ON c.n_regionkey = r_regionkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4""")
def star_report(region, nation, customer, supplier, part, orders, lineitem):
    buyer = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    seller = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    rows = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).join(customer, orders.o_custkey == customer.c_custkey).join(F.broadcast(buyer), "c_nationkey")
    rows = rows.join(supplier, rows.l_suppkey == supplier.s_suppkey).join(F.broadcast(seller), "s_nationkey").join(part, rows.l_partkey == part.p_partkey)
    return rows.groupBy("r_name", "supplier_nation", "p_brand", "o_orderpriority").agg(F.count("*").alias("n"), F.sum(cents("l_extendedprice")).alias("cents"))


@query("part", "lineitem", "orders", "customer", sql="SELECT DISTINCT p_brand, c_nationkey FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE p_size < 10")
def bridge_distinct(part, lineitem, orders, customer):
    rows = part.where("p_size < 10").join(lineitem, part.p_partkey == lineitem.l_partkey).join(orders, lineitem.l_orderkey == orders.o_orderkey)
    return rows.join(customer, rows.o_custkey == customer.c_custkey).select("p_brand", "c_nationkey").distinct()


@query("customer", "orders", sql="SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_needed(customer, orders):
    known = orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return relational.unmatched(customer.select("c_custkey"), known, ["c_custkey"])


@query("customer", "orders", sql="SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_known(customer, orders):
    known = orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return relational.matched(customer.select("c_custkey", "c_name"), known, ["c_custkey"])


@query("lineitem", "orders", sql="""
WITH l AS (SELECT l_orderkey AS k, l_partkey AS a, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem), r AS (SELECT o_orderkey AS k, o_custkey AS b FROM orders),
j AS (SELECT k, a, b FROM l JOIN r USING (k) WHERE n = 1), x AS (SELECT *, count(*) OVER (PARTITION BY a) AS na FROM j), y AS (SELECT *, count(*) OVER (PARTITION BY b) AS nb FROM x WHERE na = 1)
SELECT k, a, b FROM y WHERE nb = 1""")
def unique_match_intersection(lineitem, orders):
    left, right = lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("a")), orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("b"))
    return relational.unique_matches(left, right, "k", "a", "b").select("k", "a", "b")


@query("documents", sql="""
WITH d AS (SELECT source, doc_id, n_chars FROM documents)
SELECT a.source, least(a.doc_id, b.doc_id) AS doc_id_1, greatest(a.doc_id, b.doc_id) AS doc_id_2, CASE WHEN a.doc_id > b.doc_id THEN b.n_chars ELSE a.n_chars END AS n_chars_1, CASE WHEN a.doc_id > b.doc_id THEN a.n_chars ELSE b.n_chars END AS n_chars_2
FROM d a JOIN d b ON a.source = b.source AND (b.n_chars > a.n_chars OR b.n_chars = a.n_chars AND a.doc_id < b.doc_id)
WHERE CASE WHEN a.n_chars < 19 THEN b.n_chars = a.n_chars WHEN a.n_chars >= 2000 THEN b.n_chars <= 2 * a.n_chars ELSE b.n_chars <= least(2 * a.n_chars, 2000) END""")
def length_band_pairs(documents):
    return relational.length_band(documents, "source", "doc_id", "n_chars")


@query("lineitem", sql="""
WITH s AS (SELECT l_orderkey AS o, l_partkey AS p FROM lineitem GROUP BY 1, 2), n AS (SELECT o, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.o AS x, b.o AS y, count(*) AS c FROM s a JOIN s b ON a.p = b.p AND a.o < b.o GROUP BY 1, 2)
SELECT x, y, CASE WHEN c = m.n AND c = k.n THEN 'exact' WHEN c = m.n THEN 'contained' WHEN c = k.n THEN 'enclose' ELSE 'partial' END AS overlap FROM c JOIN n m ON x = m.o JOIN n k ON y = k.o""")
def overlap_classify(lineitem):
    sets = lineitem.groupBy(F.col("l_orderkey").alias("o")).agg(F.collect_set("l_partkey").alias("s"))
    return relational.overlapping_sets(sets, "o", "s").select(F.col("o_1").alias("x"), F.col("o_2").alias("y"), "overlap")


@query("lineitem", sql="""
WITH s AS (SELECT DISTINCT l_orderkey AS o, l_partkey % 50 AS p FROM lineitem), n AS (SELECT o, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.o AS x, b.o AS y, count(*) AS c FROM s a JOIN s b ON a.p = b.p AND a.o <> b.o GROUP BY 1, 2)
SELECT o FROM n WHERE o NOT IN (SELECT x FROM c JOIN n m ON x = m.o JOIN n k ON y = k.o WHERE c = m.n AND k.n > m.n)""")
def maximal_sets(lineitem):
    return relational.maximal_sets(lineitem.select(F.col("l_orderkey").alias("o"), (F.col("l_partkey") % 50).alias("p")), "o", "p")


@query("nation", "region", sql="SELECT r_name, string_agg(n_name, '|' ORDER BY n_nationkey) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def group_concat_sorted(nation, region):
    return nation.join(region, nation.n_regionkey == region.r_regionkey).groupBy("r_name").agg(agg.concat_sorted("n_name", "n_nationkey", "|").alias("nations"))


@query("events", sql="SELECT user_id, count(*) FILTER (event_type LIKE '%c%' AND value < 50) AS c_low, count(*) FILTER (event_type LIKE '%c%' AND value >= 50) AS c_high, count(*) FILTER (NOT event_type LIKE '%c%' AND value < 50) AS other_low, count(*) FILTER (NOT event_type LIKE '%c%' AND value >= 50) AS other_high FROM events GROUP BY 1")
def conditional_counts(events):
    has, low = F.col("event_type").rlike("c"), F.col("value") < 50
    high = F.col("value") >= 50
    return events.groupBy("user_id").agg(F.count_if(has & low).alias("c_low"), F.count_if(has & high).alias("c_high"), F.count_if(~has & low).alias("other_low"), F.count_if(~has & high).alias("other_high"))


@query("lineitem", sql="""SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS A, count(*) FILTER (l_returnflag = 'N') AS N, count(*) FILTER (l_returnflag = 'R') AS R, count(*) FILTER (l_returnflag = 'A' AND l_linenumber > 3) AS lr_A,
count(*) FILTER (l_returnflag = 'N' AND l_linenumber > 3) AS lr_N, count(*) FILTER (l_returnflag = 'R' AND l_linenumber > 3) AS lr_R, count(*) AS total, count(*) FILTER (l_linenumber > 3) AS lr_total FROM lineitem GROUP BY 1""")
def label_histogram(lineitem):
    return agg.count_labels(lineitem, "l_suppkey", "l_returnflag", ["A", "N", "R"], F.col("l_linenumber") > 3)


@query("orders", sql="PIVOT (SELECT o_custkey % 100 AS c, o_orderstatus FROM orders) ON o_orderstatus IN ('F', 'O', 'P') USING count(*) GROUP BY c")
def pivot_counts(orders):
    return orders.groupBy((F.col("o_custkey") % 100).alias("c")).pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@query("documents", "labels", sql="SELECT source, round(coalesce(avg(quality), 40.0), 6) AS mean_quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def null_mean_default(documents, labels):
    return documents.join(labels, "doc_id", "left").groupBy("source").agg(F.round(agg.mean_or("quality", 40.0), 6).alias("mean_quality"), F.count("*").alias("n"))


@query("lineitem", sql="""
WITH u AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey AS s FROM lineitem)
SELECT a.s AS s1, b.s AS s2, CASE WHEN a.s = b.s THEN count(*) / 2.0 ELSE CAST(count(*) AS DOUBLE) END AS n FROM u a JOIN u b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber <> b.l_linenumber GROUP BY 1, 2""")
def matrix_count_half_self(lineitem):
    parts = parts_of(lineitem)
    u = lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s")).repartition(parts, "l_orderkey").distinct()
    pairs = u.withColumnsRenamed({"l_linenumber": "x", "s": "s1"}).join(u.withColumnsRenamed({"l_linenumber": "y", "s": "s2"}), "l_orderkey").where("x != y")
    return agg.pair_count_matrix(pairs.select("s1", "s2").repartition(4 * parts, "s1", "s2"), "s1", "s2")


@query("orders", sql="""
WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS k FROM c)
SELECT o_custkey, o_orderpriority, n FROM r WHERE k = 1""")
def best_model(orders):
    return agg.most_frequent(orders, "o_custkey", "o_orderpriority")


@query("orders", sql="SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'P' WHEN bool_or(o_orderstatus = 'O') THEN 'O' ELSE min(o_orderstatus) END AS o_orderstatus FROM orders GROUP BY 1")
def pick_preferred(orders):
    return agg.pick_preferred(orders, "o_custkey", "o_orderstatus", ["P", "O"])


@query("lineitem", sql="""
WITH c AS (SELECT l_orderkey, l_suppkey % 5 AS t, count(*) AS n FROM lineitem GROUP BY 1, 2), a AS (SELECT l_orderkey, count(*) AS m FROM lineitem GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, t) AS k FROM c)
SELECT l_orderkey, t, n, n / m AS share FROM r JOIN a USING (l_orderkey) WHERE k = 1 AND n / m >= 0.5""")
def majority_mapping(lineitem):
    return agg.majority_mapping(lineitem.withColumn("t", F.col("l_suppkey") % 5), "l_orderkey", "t", 0.5)


RANKED = "r AS (SELECT p_brand, p_partkey, p_size, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_size DESC, p_name, p_partkey) - 1 AS INTEGER) AS rank FROM part)"


def _ranked(part):
    order = [F.col("p_retailprice").desc(), F.col("p_size").desc(), F.col("p_name"), F.col("p_partkey")]
    return windows.ranked(part, ["p_brand"], order).select("p_brand", "p_partkey", "p_size", "rank")


@query("part", sql=f"WITH {RANKED} SELECT * FROM r")
def rank_members(part):
    return _ranked(part)


@query("part", sql=f"""
WITH {RANKED}, c(cutoff, bound) AS (VALUES ('5', 5.0), ('15', 15.0), ('30', 30.0), ('all', NULL))
SELECT p_brand, p_partkey, p_size, cutoff, CAST(row_number() OVER (PARTITION BY p_brand, cutoff ORDER BY rank) - 1 AS INTEGER) AS rank FROM r, c WHERE bound IS NULL OR p_size <= bound""")
def resolution_explode(part):
    return windows.at_cutoffs(_ranked(part), "p_brand", "p_size", "rank", [("5", 5.0), ("15", 15.0), ("30", 30.0), ("all", None)])


@query("events", sql="SELECT user_id, event_type, max_by(props, event_id) AS props, min_by(ts, event_id) AS ts FROM events GROUP BY 1, 2")
def keep_latest_rank_earliest_id(events):
    return windows.latest_rank_earliest_id(events, ["user_id", "event_type"], "event_id", "props", "ts")


UNIT_ORDER = "u AS (SELECT l_orderkey, l_partkey, (l_partkey % 3 = 0) AS border FROM lineitem GROUP BY 1, 2)"


def _bordered(lineitem):
    return lineitem.select("l_orderkey", "l_partkey", (F.col("l_partkey") % 3 == 0).alias("border")).distinct()


@query("lineitem", sql=f"""
WITH {UNIT_ORDER}, w AS (SELECT *, l_partkey - lag(l_partkey) OVER o AS gap, sum(border::INT) OVER (PARTITION BY l_orderkey ORDER BY l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM u WINDOW o AS (PARTITION BY l_orderkey ORDER BY l_partkey))
SELECT l_orderkey, l_partkey, border, gap FROM w WHERE b % 2 = 1 AND (gap > 10 OR gap = 0)""")
def gap_detect(lineitem):
    return windows.breaks(_bordered(lineitem), ["l_orderkey"], "l_partkey", "border", most_gap=10)


@query("lineitem", sql=f"WITH {UNIT_ORDER} SELECT *, CAST(floor((sum(border::INT) OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - border::INT) / 2) AS INT) AS strand FROM u")
def strand_split(lineitem):
    return windows.strands(_bordered(lineitem), ["l_orderkey"], "l_partkey", "border")


@query("events", sql="SELECT event_id, user_id, event_type FROM (SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE b = event_type")
def adjacent_dup(events):
    return windows.repeated_neighbours(events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query("orders", sql="""
WITH k AS (SELECT o_orderpriority AS p, max(o_orderkey) AS m FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT p AS kind, o_orderkey AS old, coalesce(m, 0) + row_number() OVER (PARTITION BY p ORDER BY o_orderkey) AS id FROM (SELECT o_orderpriority AS p, o_orderkey FROM orders WHERE o_orderstatus = 'O') LEFT JOIN k USING (p)""")
def next_sequential_id(orders):
    known = orders.where("o_orderstatus = 'F'").select(F.col("o_orderpriority").alias("kind"), F.col("o_orderkey").alias("id"))
    new = orders.where("o_orderstatus = 'O'").select(F.col("o_orderpriority").alias("kind"), F.col("o_orderkey").alias("old"))
    return windows.next_ids(new, known, "kind", "id", ["old"])


@query("lineitem", "orders", sql="SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = (SELECT count(DISTINCT o_orderpriority) FROM orders)")
def relational_division(lineitem, orders):
    return relational.in_every(lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey), "l_partkey", "o_orderpriority")


METRICS = """m AS (SELECT l_orderkey, max(l_quantity) AS resolution, max(l_discount) AS percent_clash, count(*) AS obs, max(l_tax) AS average_rsr, min(l_tax) AS average_rscc, max(l_discount) / 10 AS rfree,
 CASE WHEN bool_or(l_returnflag = 'R') THEN 'ELECTRON MICROSCOPY' ELSE 'X-RAY DIFFRACTION' END AS method, max(CASE WHEN l_linestatus = 'O' THEN l_tax END) AS average_Q_score, max(CASE WHEN l_linestatus = 'F' THEN l_discount END) AS average_residue_inclusion, l_orderkey % 100 AS g FROM lineitem GROUP BY l_orderkey),
f AS (SELECT *, 1 - obs / max(obs) OVER (PARTITION BY g) AS fraction_unobserved FROM m)"""


def _metrics(lineitem):
    rows = lineitem.groupBy("l_orderkey").agg(
        F.max("l_quantity").alias("resolution"), F.max("l_discount").alias("percent_clash"), F.count("*").alias("obs"), F.max("l_tax").alias("average_rsr"), F.min("l_tax").alias("average_rscc"), (F.max("l_discount") / 10).alias("rfree"),
        F.when(F.bool_or(F.col("l_returnflag") == "R"), "ELECTRON MICROSCOPY").otherwise("X-RAY DIFFRACTION").alias("method"),
        F.max(F.when(F.col("l_linestatus") == "O", F.col("l_tax"))).alias("average_Q_score"), F.max(F.when(F.col("l_linestatus") == "F", F.col("l_discount"))).alias("average_residue_inclusion"),
    )
    return windows.fraction_of_best(rows.withColumn("g", F.col("l_orderkey") % 100), "g", "obs", "fraction_unobserved")


CQS2_SQL = """resolution + percent_clash + 2.9 * fraction_unobserved + CASE WHEN method = 'ELECTRON MICROSCOPY' THEN coalesce(7.5 * (1 - average_Q_score), 150) + coalesce(5 * (1 - average_residue_inclusion), 141) + 2.8 ELSE 6.4 * average_rsr + 7 * (1 - average_rscc) + 21 * rfree END"""


@query("lineitem", sql=f"WITH {METRICS} SELECT l_orderkey, round(resolution + 0.6 * percent_clash + 4 * fraction_unobserved + 8 * average_rsr + 8 * (1 - average_rscc) + 18 * rfree, 5) AS score FROM f")
def cqs_v1(lineitem):
    return _metrics(lineitem).select("l_orderkey", F.round(quality.cqs1(), 5).alias("score"))


@query("lineitem", sql=f"WITH {METRICS} SELECT l_orderkey, round({CQS2_SQL}, 5) AS score FROM f")
def cqs_v2(lineitem):
    return _metrics(lineitem).select("l_orderkey", F.round(quality.cqs2(), 5).alias("score"))


@query("lineitem", sql=f"WITH {METRICS}, s AS (SELECT g, l_orderkey, round({CQS2_SQL}, 5) AS c FROM f) SELECT g, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY c, l_orderkey) AS k FROM s) WHERE k = 1")
def representative_compscore(lineitem):
    scored = _metrics(lineitem).withColumn("cqs2", F.round(quality.cqs2(), 5)).withColumn("id", F.col("l_orderkey"))
    return resolve.REPRESENTATIVES["compscore"](scored, "g").select("g", "l_orderkey")


MEMBERS = "m AS (SELECT l_orderkey AS id, l_orderkey % 100 AS g, count(*) AS length, count(*) FILTER (l_returnflag = 'A') AS bp, max(l_quantity) / 10 AS resolution FROM lineitem GROUP BY 1)"


def _members(lineitem):
    return lineitem.groupBy(F.col("l_orderkey").alias("id"), (F.col("l_orderkey") % 100).alias("g")).agg(F.count("*").alias("length"), F.count_if(F.col("l_returnflag") == "A").alias("bp"), (F.max("l_quantity") / 10).alias("resolution"))


@query("lineitem", sql=f"WITH {MEMBERS} SELECT g, id, bp, length FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY CASE WHEN bp = 0 OR length = 0 THEN 0.0 ELSE bp / length END DESC, resolution, id DESC) AS k FROM m) WHERE k = 1")
def representative_naive(lineitem):
    return resolve.REPRESENTATIVES["naive"](_members(lineitem), "g").select("g", "id", "bp", "length")


def _climbing(cutoff, first="SELECT g, max(p) AS p FROM r GROUP BY 1"):
    """The climb in SQL; r: members with p, their place in naive order."""
    grown = lambda c: f"CASE WHEN c.p.{c} = 0 THEN CASE WHEN r.p.{c} = 0 THEN 0.0 ELSE 100.0 END ELSE (r.p.{c}::DOUBLE / c.p.{c} - 1) * 100 END >= {cutoff}"
    return f"""r AS (SELECT g, {{'ratio': CASE WHEN bp = 0 OR length = 0 THEN 0.0::DOUBLE ELSE bp / length END, 'res': -resolution, 'id': id, 'bp': bp, 'length': length}} AS p FROM m),
c AS ({first} UNION ALL SELECT g, p FROM (SELECT c.g, max(r.p) AS p FROM c JOIN r USING (g) WHERE r.p.bp >= c.p.bp AND r.p.length >= c.p.length AND (r.p.bp <> c.p.bp OR r.p.length <> c.p.length) AND {grown("length")} AND {grown("bp")} GROUP BY 1))
SELECT g, p.id AS id, p.bp AS bp, p.length AS length FROM (SELECT g, p, row_number() OVER (PARTITION BY g ORDER BY p.bp + p.length DESC) AS k FROM c) WHERE k = 1"""


@query("lineitem", sql=f"WITH RECURSIVE {MEMBERS}, {_climbing(0.5)}")
def representative_percent_increase(lineitem):
    return resolve.REPRESENTATIVES["percent-increase"](_members(lineitem), "g").select("g", "id", "bp", "length")


@query("lineitem", sql=f"WITH RECURSIVE {MEMBERS}, {_climbing(0)}")
def representative_any_increase(lineitem):
    return resolve.REPRESENTATIVES["any-increase"](_members(lineitem), "g").select("g", "id", "bp", "length")


@query("lineitem", sql=f"WITH RECURSIVE {MEMBERS}, {_climbing(0.5, "SELECT r.g, coalesce(max(CASE WHEN p.id = f THEN p END), max(p)) AS p FROM r LEFT JOIN (SELECT g, min(id) AS f FROM m GROUP BY 1 HAVING g % 3 = 0) USING (g) GROUP BY 1")}")
def representative_parent_increase(lineitem):
    """Every third group has one parent, represented by the smallest id; others have none or two."""
    members = _members(lineitem)
    one = members.groupBy("g").agg(F.min("id").alias("id"), F.max("id").alias("other"))
    parents = one.where("g % 3 = 0").select("g", "id").unionByName(one.where("g % 3 = 1").select("g", F.explode(F.array("id", "other")).alias("id")))
    return resolve.by_parent_increase(members, "g", parents).select("g", "id", "bp", "length")


@query("lineitem", sql="""
WITH m AS (SELECT l_orderkey AS id, l_orderkey % 100 AS g, count(*) AS length, count(*) FILTER (l_returnflag = 'A') AS bp, max(l_quantity) / 10 AS resolution, CASE WHEN max(l_linestatus) = 'F' THEN 'X-RAY DIFFRACTION' ELSE 'SOLUTION NMR' END AS method, max(l_suppkey) AS rsrz, CASE WHEN count(*) > 2 THEN max(l_linenumber) END AS clashscore, min(l_partkey) % 9 AS backbone FROM lineitem GROUP BY 1),
q AS (SELECT *, coalesce(method = 'X-RAY DIFFRACTION' AND resolution <= 4.0 AND rsrz <> 0 AND clashscore <> 0 AND backbone <> 0, false) AS good FROM m), a AS (SELECT * FROM (SELECT *, max(good) OVER (PARTITION BY g) AS b FROM q) WHERE good = b),
n AS (SELECT * FROM (SELECT *, max(length) OVER (PARTITION BY g) AS l FROM a) WHERE length >= 0.75 * l), r AS (SELECT * FROM (SELECT *, min(resolution) OVER (PARTITION BY g) AS w FROM n) WHERE abs(resolution - w) <= 0.2),
s AS (SELECT g, id, CASE WHEN rsrz <> 0 THEN rsrz ELSE 100.0::DOUBLE END * CASE WHEN clashscore <> 0 THEN clashscore ELSE 500.0::DOUBLE END * CASE WHEN backbone <> 0 THEN backbone ELSE 100.0::DOUBLE END * (resolution * resolution * resolution * resolution) / (length + bp) AS k FROM r)
SELECT g, id FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k, id) AS n FROM s) WHERE n = 1""")
def representative_metrics(lineitem):
    metrics = [F.max("l_suppkey").alias("rsrz"), F.when(F.count("*") > 2, F.max("l_linenumber")).alias("clashscore"), (F.min("l_partkey") % 9).alias("backbone")]
    method = F.when(F.max("l_linestatus") == "F", "X-RAY DIFFRACTION").otherwise("SOLUTION NMR").alias("method")
    rows = lineitem.groupBy(F.col("l_orderkey").alias("id"), (F.col("l_orderkey") % 100).alias("g")).agg(F.count("*").alias("length"), F.count_if(F.col("l_returnflag") == "A").alias("bp"), (F.max("l_quantity") / 10).alias("resolution"), method, *metrics)
    return resolve.REPRESENTATIVES["quality-metrics"](rows, "g").select("g", "id")


@query("documents", "labels", sql=r"""
SELECT doc_id, CASE WHEN n_chars < 200 THEN 2 WHEN lang IS NULL THEN 4 WHEN source = 'src7' THEN 7 WHEN contains(text, '$$$') THEN 5 WHEN contains(text, ' | ') THEN 6 WHEN toxic = 1 THEN 8 WHEN quality = 0 THEN 8 WHEN contains(text, 'Licensed') THEN 3 ELSE 1 END AS status
FROM documents LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)""")
def qa_cascade(documents, labels):
    flags = labels.groupBy("doc_id").agg((F.max("toxic") == 1).alias("all_high_rsrz"), (F.min("quality") == 0).alias("all_low_q_score"))
    has = lambda s: F.col("text").contains(s)
    rows = documents.join(flags, "doc_id", "left").withColumns(
        {"has_breaks": F.col("n_chars") < 200, "bad_chain_number": F.col("lang").isNull(), "too_many_sym_ops": F.col("source") == "src7", "has_incomplete": has("$$$"), "is_complementary": has(" | "), "has_modified": has("Licensed")}
    )
    return rows.select("doc_id", quality.status().alias("status"))


@query("part", sql="""
WITH p AS (SELECT p_partkey, upper(replace(p_name, ' ', '')) AS sequence FROM part)
SELECT p_partkey, sequence, md5(sequence) AS md5, CASE WHEN regexp_matches(sequence[:-2], '[^ACGUNTI]') OR NOT regexp_matches(sequence, '[ACGUNTI]$') THEN NULL ELSE translate(sequence, 'TI', 'UG') END AS normalized FROM p WHERE regexp_matches(sequence, '[ACGUNTI]$')""")
def seq_normalise_md5(part):
    rows = part.select("p_partkey", F.upper(F.replace("p_name", F.lit(" "), F.lit(""))).alias("sequence")).where(F.col("sequence").rlike("[ACGUNTI]$"))
    return sequences.sequence_row(rows, {"T": "U", "I": "G"}).select("p_partkey", "sequence", "md5", "normalized")


@query("lineitem", sql="""
SELECT l_orderkey || '|1|' || l_returnflag || '|' || l_linestatus || '|' || l_linenumber AS unit_id, CAST(l_orderkey AS VARCHAR) AS pdb, l_returnflag AS chain, CAST(l_linenumber AS VARCHAR) AS number, '1_555' AS sym_op,
l_orderkey || '|1|' || l_returnflag AS triple, l_returnflag || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS sort_key FROM lineitem""")
def id_parse(lineitem):
    rows = lineitem.withColumn("unit_id", F.concat_ws("|", "l_orderkey", F.lit("1"), "l_returnflag", "l_linestatus", "l_linenumber"))
    rows = rows.withColumn("f", ids.unit_fields(F.col("unit_id")))
    key = ids.sort_key((F.col("l_returnflag"), 1), (F.col("l_orderkey"), 10), (F.col("l_linenumber"), 3))
    return rows.select("unit_id", "f.pdb", "f.chain", "f.number", "f.sym_op", ids.chain_triple(F.col("unit_id")).alias("triple"), key.alias("sort_key"))


@query("part", sql="""
WITH b AS (SELECT p_brand, CASE p_size % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'U' END AS b FROM part), s AS (SELECT p_brand, string_agg(DISTINCT b, '' ORDER BY b) AS s FROM b GROUP BY 1)
SELECT p_brand, CASE s WHEN 'A' THEN 'A' WHEN 'C' THEN 'C' WHEN 'G' THEN 'G' WHEN 'U' THEN 'U' WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AU' THEN 'W' WHEN 'CG' THEN 'S' WHEN 'CU' THEN 'Y' WHEN 'GU' THEN 'K' WHEN 'ACG' THEN 'V' WHEN 'ACU' THEN 'H' WHEN 'AGU' THEN 'D' WHEN 'CGU' THEN 'B' ELSE 'N' END AS code FROM s""")
def iupac_consensus(part):
    base = F.element_at(F.array(*map(F.lit, "ACGU")), F.col("p_size") % 4 + 1)
    return part.select("p_brand", base.alias("b")).groupBy("p_brand").agg(agg.iupac("b").alias("code"))


@query("lineitem", sql="""
SELECT l_partkey, count(*) FILTER (l_returnflag = 'A') AS true_votes, count(*) FILTER (l_returnflag = 'R') AS near_votes FROM lineitem GROUP BY 1
HAVING 6 * count(*) FILTER (l_returnflag = 'A') + 4 * count(*) FILTER (l_returnflag = 'R') > 3 * (SELECT count(DISTINCT l_linenumber) FROM lineitem)""")
def consensus_vote(lineitem):
    instances = lineitem.agg(F.count_distinct("l_linenumber").alias("n"))
    return agg.consensus_vote(lineitem, "l_partkey", F.col("l_returnflag") == "A", F.col("l_returnflag") == "R", instances)


@query("lineitem", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, 'flag' AS category, l_returnflag AS label FROM lineitem WHERE l_returnflag <> 'N' UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'status', l_linestatus FROM lineitem WHERE l_linestatus IS NOT NULL""")
def unpivot_interactions(lineitem):
    rows = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.col("l_linestatus").alias("status"))
    return agg.melt_labels(rows, ["l_orderkey", "l_linenumber", "l_partkey"], ["flag", "status"])


def _releases(orders):
    member = lambda d: orders.where(d).select(F.col("o_custkey").alias("member"), (F.col("o_orderkey") % 997).alias("group")).distinct()
    return member("o_orderkey % 11 != 0"), member("o_orderkey % 13 != 0")


@query("orders", sql="""
WITH o AS (SELECT DISTINCT o_custkey AS member FROM orders WHERE o_orderkey % 11 <> 0), n AS (SELECT DISTINCT o_custkey AS member FROM orders WHERE o_orderkey % 13 <> 0)
SELECT count(*) FILTER (o.member IS NULL) AS added, count(*) FILTER (n.member IS NULL) AS removed, count(*) FILTER (o.member = n.member) AS unchanged FROM o FULL JOIN n ON o.member = n.member""")
def release_diff(orders):
    old, new = _releases(orders)
    return lineage.set_changes(new, old, "member")


NAMES = """
WITH o AS (SELECT DISTINCT o_orderkey % 997 AS g, o_custkey AS m FROM orders WHERE o_orderkey % 11 <> 0), n AS (SELECT DISTINCT o_orderkey % 997 AS g, o_custkey AS m FROM orders WHERE o_orderkey % 13 <> 0),
os AS (SELECT g, count(*) AS s FROM o GROUP BY 1), ns AS (SELECT g, count(*) AS s, md5(string_agg(CAST(m AS VARCHAR), ',' ORDER BY m)) AS h FROM n GROUP BY 1),
c AS (SELECT n.g, o.g AS p, count(*) AS c FROM n JOIN o ON n.m = o.m GROUP BY 1, 2), sh AS (SELECT c.g, p, c / greatest(os.s, ns.s) AS share FROM c JOIN os ON p = os.g JOIN ns ON c.g = ns.g),
b AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY share DESC, 'H' || p) AS k, count(*) OVER (PARTITION BY g) AS n FROM sh)
SELECT ns.g AS "group", CASE WHEN share >= 2.0 / 3 THEN 'H' || p ELSE substr(h, 1, 8) END AS handle, CASE WHEN share = 1 AND n = 1 THEN 3 WHEN share >= 2.0 / 3 THEN 4 ELSE 1 END AS version, CASE WHEN share = 1 AND n = 1 THEN 'exact' WHEN share >= 2.0 / 3 THEN 'updated' ELSE 'new' END AS kind, coalesce(n, 0) AS n_parents
FROM ns LEFT JOIN b ON ns.g = b.g AND k = 1"""


@query("orders", sql=NAMES)
def name_lineage(orders):
    old, new = _releases(orders)
    parents = old.select("member", F.concat(F.lit("H"), "group").alias("name_handle"), F.lit(3).alias("name_version"))
    return lineage.named(new, parents)


@query("lineitem", sql="""
SELECT l_orderkey, count(*) AS length, count(*) FILTER (l_returnflag <> 'R') AS aligned_count, count(*) FILTER (l_returnflag = 'A') AS match_count, count(*) FILTER (l_returnflag <> 'A') AS mismatch_count, count(*) FILTER (l_returnflag = 'R') AS first_gap_count, CAST(0 AS BIGINT) AS second_gap_count FROM lineitem GROUP BY 1""")
def alignment_summary(lineitem):
    rows = lineitem.select("l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("x"), F.lit("A").alias("y"))
    return agg.alignment_summary(rows, "l_orderkey", "x", "y")


@query("lineitem", sql="""
WITH s AS (SELECT l_suppkey, 5 * count(*) AS max_size, 4 * count(*) AS min_size, 4 * count(*) AS aligned_count, 4 * count(*) - count(*) FILTER (l_returnflag = 'A') AS match_count, count(*) FILTER (l_returnflag = 'A') AS mismatch_count FROM lineitem GROUP BY 1)
SELECT l_suppkey, CASE WHEN min_size < 19 THEN 0 WHEN min_size < 80 THEN (mismatch_count <= 4)::INT WHEN mismatch_count = 0 OR match_count / min_size >= 0.95 THEN 1 ELSE 0 END AS good FROM s""")
def good_alignment(lineitem):
    bad = F.count_if(F.col("l_returnflag") == "A")
    rows = lineitem.groupBy("l_suppkey").agg((5 * F.count("*")).alias("max_size"), (4 * F.count("*")).alias("min_size"), (4 * F.count("*")).alias("aligned_count"), (4 * F.count("*") - bad).alias("match_count"), bad.alias("mismatch_count"))
    return rows.select("l_suppkey", resolve.good_alignment().alias("good"))


EDGES = "e AS (SELECT DISTINCT a.l_partkey AS u, b.l_partkey AS v FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey AND a.l_suppkey % 40 = b.l_suppkey % 40 AND a.l_quantity = b.l_quantity)"


def _edges(lineitem):
    side = lambda k: lineitem.select("l_orderkey", "l_quantity", (F.col("l_suppkey") % 40).alias("s"), F.col("l_partkey").alias(k))
    return side("u").join(side("v"), ["l_orderkey", "l_quantity", "s"]).where("u < v").select("u", "v").distinct()


@query("lineitem", sql=f"WITH RECURSIVE {EDGES}, b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), r(x, y) AS (SELECT u, u FROM b UNION SELECT r.x, b.v FROM r JOIN b ON r.y = b.u) SELECT x AS node, min(y) AS component FROM r GROUP BY 1")
def components(lineitem):
    return connected_components(_edges(lineitem), lambda df: saved(df, "components"))


@query("customer", "nation", sql="""
WITH m AS (SELECT c_custkey, c_custkey % 200 AS g, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS s, CAST(round(c_acctbal / 100) AS INT) AS l FROM customer),
k AS (SELECT g, s, count(*) AS n FROM m WHERE s IS NOT NULL GROUP BY 1, 2), t AS (SELECT g, s AS main FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, s) AS r FROM k) WHERE r = 1), z AS (SELECT g, max(l) AS longest, count(*) AS size FROM m GROUP BY 1)
SELECT c_custkey, m.g, CASE WHEN longest >= 70 AND size > 1 THEN coalesce(s, main) END AS part FROM m JOIN z USING (g) LEFT JOIN t USING (g)""")
def species_split(customer, nation):
    species = F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey").cast("string"))
    rows = customer.select("c_custkey", (F.col("c_custkey") % 200).alias("g"), species.alias("s"), F.round(F.col("c_acctbal") / 100).cast("int").alias("l"))
    return resolve.split_species(rows, "g", "c_custkey", "l", "s").select("c_custkey", "g", "part")


def _near(orders):
    """Distances of the orders of a customer: differences of their prices in cents, whose sums are exact."""
    rows = orders.select(F.col("o_custkey").alias("g"), "o_orderkey", cents("o_totalprice").alias("p")).repartition(parts_of(orders, 200_000), "g")
    pairs = relational.pairs_within(rows, "g", "o_orderkey", ("p",))
    return pairs.select("g", F.col("o_orderkey_1").alias("a"), F.col("o_orderkey_2").alias("b"), F.abs(F.col("p_1") - F.col("p_2")).alias("distance"))


DISTANCES = "v AS (SELECT o_custkey AS g, o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS p FROM orders), d AS (SELECT x.g, x.k AS a, y.k AS b, abs(x.p - y.p) AS d FROM v x JOIN v y ON x.g = y.g AND x.k <> y.k)"


@query("orders", sql=f"WITH {DISTANCES}, s AS (SELECT g, a, round(sum(d), 6) AS s FROM d GROUP BY 1, 2) SELECT g, a AS item FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY s, a) AS k FROM s) WHERE k = 1")
def centroid(orders):
    near = _near(orders)
    both = near.select("g", F.explode(F.array("a", "b")).alias("item"), "distance")
    return agg.centroids(both, "g", "item", "distance")


@query("orders", sql=f"WITH {DISTANCES} SELECT a AS item, g, round(max(d), 6) AS max_distance, round(avg(d), 6) AS mean_distance FROM d GROUP BY 1, 2")
def item_to_group_distance(orders):
    near = _near(orders)
    both = near.select("g", F.explode(F.array("a", "b")).alias("item"), "distance")
    out = agg.distance_to_groups(both, "item", "g", "distance")
    return out.select("item", "g", F.round("max_distance", 6).alias("max_distance"), F.round("mean_distance", 6).alias("mean_distance"))


@query("orders")
def hierarchical(orders):
    return clustering.cluster_groups(_near(orders), "g", 100_000)


@query("orders")
def seriation(orders):
    return clustering.order_groups(_near(orders), "g")


@query("orders")
def cliques(orders):
    return clustering.clique_groups(_near(orders), "g", 100_000)


@query("embeddings")
def kabsch(embeddings):
    """Discrepancy of neighbouring vectors, padded with zeros to whole centres of three numbers, frames all equal."""
    lacking = F.pmod(-F.size("embedding"), F.lit(3))
    rows = embeddings.select("vec_id", F.concat(F.transform("embedding", lambda x: x.cast("double")), F.array_repeat(F.lit(0.0), lacking)).alias("c"))
    both = rows.join(rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("c").alias("c2")), "vec_id")
    frames = F.flatten(F.array_repeat(F.array(*map(F.lit, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0])), (F.size("c") / 3).cast("int")))
    return both.select("vec_id", superposition.discrepancy_within(flips=False)("c", frames, "c2", frames)["discrepancy"].alias("discrepancy"))


@query("events", sql="""
WITH m AS (SELECT user_id, max(ts) AS t FROM events WHERE event_id % 2 = 0 GROUP BY 1)
SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'click') AS clicks FROM events LEFT JOIN m USING (user_id) WHERE t IS NULL OR ts > t GROUP BY 1""")
def events_incremental(events):
    marks = events.where("event_id % 2 = 0").groupBy("user_id").agg(F.max("ts").alias("t"))
    new = events.join(marks, "user_id", "left").where("t is null or ts > t")
    return new.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "click").alias("clicks"))


@query("events", sql="SELECT user_id, CAST(get_k AS BIGINT) AS k, count(*) AS n FROM (SELECT user_id, json_extract_string(props, '$.k') AS get_k FROM events) GROUP BY 1, 2")
def json_fields(events):
    return events.select("user_id", F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("user_id", "k").agg(F.count("*").alias("n"))


@query("orders", sql="""
WITH n AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT o_orderkey, 'new' AS o_orderstatus, o_custkey FROM n UNION ALL SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)""")
def upsert(orders):
    cols = ["o_orderkey", "o_orderstatus", "o_custkey"]
    stored, new = orders.select(*cols), orders.where("o_orderpriority = '1-URGENT'").select(*cols).withColumn("o_orderstatus", F.lit("new"))
    return relational.upsert(stored, new, ["o_orderkey"])


@query("lineitem", sql="""
WITH p AS (SELECT 'u' || l_partkey AS unit_1, 'u' || l_suppkey AS unit_2, CASE l_returnflag WHEN 'A' THEN 'tHS' WHEN 'N' THEN 'ncWH' ELSE 'cWW' END AS label FROM lineitem)
SELECT unit_1, unit_2, label FROM p UNION ALL SELECT unit_2, unit_1, CASE label WHEN 'tHS' THEN 'tSH' WHEN 'ncWH' THEN 'ncHW' ELSE 'cWW' END FROM p""")
def symmetric_labels(lineitem):
    label = F.when(F.col("l_returnflag") == "A", "tHS").when(F.col("l_returnflag") == "N", "ncWH").otherwise("cWW")
    return relational.symmetric_labels(lineitem.select(F.concat(F.lit("u"), "l_partkey").alias("unit_1"), F.concat(F.lit("u"), "l_suppkey").alias("unit_2"), label.alias("label")))



@query("orders", "lineitem", sql="""
WITH r AS (SELECT o_custkey % 50 AS handle, year(o_orderdate) % 3 AS release, min(o_orderkey) AS rep FROM orders GROUP BY 1, 2)
SELECT handle, max(CASE WHEN release = 0 THEN rep END) AS r0, max(CASE WHEN release = 1 THEN rep END) AS r1, max(CASE WHEN release = 2 THEN rep END) AS r2, count(DISTINCT rep) AS representatives FROM r GROUP BY 1""")
def rep_changes(orders, lineitem):
    reps = orders.groupBy((F.col("o_custkey") % 50).alias("handle"), (F.year("o_orderdate") % 3).alias("release")).agg(F.min("o_orderkey").alias("rep"))
    wide = reps.groupBy("handle").pivot("release", [0, 1, 2]).agg(F.max("rep")).withColumnsRenamed({"0": "r0", "1": "r1", "2": "r2"})
    return wide.join(reps.groupBy("handle").agg(F.count_distinct("rep").alias("representatives")), "handle")


@query("orders", "customer", sql="""
SELECT c_mktsegment, string_agg(DISTINCT CAST(c_nationkey AS VARCHAR), '; ' ORDER BY CAST(c_nationkey AS VARCHAR)) AS nations, count(DISTINCT c_nationkey) AS n FROM customer WHERE c_nationkey <> 0 GROUP BY 1 HAVING count(DISTINCT c_nationkey) > 1""")
def species_conflict(orders, customer):
    rows = customer.where("c_nationkey != 0").groupBy("c_mktsegment").agg(F.array_sort(F.collect_set(F.col("c_nationkey").cast("string"))).alias("s"))
    return rows.where(F.size("s") > 1).select("c_mktsegment", F.array_join("s", "; ").alias("nations"), F.size("s").cast("long").alias("n"))


@query("lineitem", "part", sql="""
SELECT l_orderkey, p_brand, count(*) FILTER (l_returnflag = 'A') AS internal, count(*) FILTER (l_returnflag <> 'A') AS external, min(p_size) AS min_size FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def external_internal(lineitem, part):
    inside = F.col("l_returnflag") == "A"
    return lineitem.join(part, lineitem.l_partkey == part.p_partkey).groupBy("l_orderkey", "p_brand").agg(F.count_if(inside).alias("internal"), F.count_if(~inside).alias("external"), F.min("p_size").alias("min_size"))


@query("conversations", sql="SELECT conv_id, count(*) AS turns, string_agg(role, '' ORDER BY turn) AS roles, CAST(max(length(text)) AS INTEGER) AS longest FROM (SELECT DISTINCT conv_id, turn, substr(role, 1, 1) AS role, text FROM conversations) GROUP BY 1")
def ordered_positions(conversations):
    rows = conversations.select("conv_id", "turn", F.substring("role", 1, 1).alias("role"), "text").distinct()
    items = agg.bucket_lists(rows, ["conv_id"], ["turn", "role", "text"])
    return items.select("conv_id", F.size("items").cast("long").alias("turns"), F.array_join(F.transform("items", lambda x: x["role"]), "").alias("roles"), F.array_max(F.transform("items", lambda x: F.length(x["text"]))).alias("longest"))
