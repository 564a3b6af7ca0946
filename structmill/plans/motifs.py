"""Loop matching, composite elements and further reports bound to the test tables; registered with those of ``reports``."""

from __future__ import annotations

from pyspark.sql import functions as F

from structmill.operators import motifs, relational
from structmill.plans.queries import cents
from structmill.plans.reports import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]

LOOPS = """
loops AS (SELECT o_custkey AS g, o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'IL' WHEN 'O' THEN 'HL' ELSE 'J3' END AS kind, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n, CAST(sum(CASE WHEN l_linenumber <> 7 AND l_tax > 0.02 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS core
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)"""


@query("orders", "lineitem", sql=f"""WITH {LOOPS}
SELECT q.g, q.kind, q.k AS query, t.k AS target FROM loops q JOIN loops t ON q.g = t.g AND q.kind = t.kind AND q.k <> t.k
WHERE NOT (q.core < t.core OR q.core > t.n OR q.kind = 'J3' AND t.n - q.n > 15 OR q.kind = 'IL' AND t.n > 35 AND q.n < 20 OR q.kind = 'HL' AND (2 * q.core < t.core OR 3 * q.core < t.n))""")
def searchable_pairs(orders, lineitem):
    """Ordered pairs of one kind within a customer that sizes do not rule out."""
    kind = F.when(F.col("o_orderstatus") == "F", "IL").when(F.col("o_orderstatus") == "O", "HL").otherwise("J3")
    quantity = F.col("l_quantity").cast("long")
    core = F.when((F.col("l_linenumber") != 7) & (F.col("l_tax") > 0.02), quantity).otherwise(0)
    loops = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey).groupBy(F.col("o_custkey").alias("g"), kind.alias("kind"), F.col("o_orderkey").alias("k")).agg(F.sum(quantity).alias("n"), F.sum(core).alias("core"))
    q, t = (loops.select("g", "kind", *[F.col(c).alias(f"{side}_{c}") for c in ("k", "n", "core")]) for side in "qt")
    pairs = q.join(t, ["g", "kind"]).where("q_k != t_k")
    rows = pairs.where(~motifs.hopeless(F.col("kind"), F.col("q_n"), F.col("q_core"), F.col("t_n"), F.col("t_core")))
    return rows.select("g", "kind", F.col("q_k").alias("query"), F.col("t_k").alias("target"))


@query("lineitem", sql="""
WITH x AS (SELECT DISTINCT l_partkey, l_linenumber, l_orderkey, list_filter([CASE WHEN l_returnflag = 'A' THEN 'cWW' WHEN l_returnflag = 'N' THEN 'tHS' END, CASE WHEN l_linestatus = 'F' AND l_tax < 0.035 THEN 's35' WHEN l_tax > 0.055 THEN 's53' END], lambda v: v IS NOT NULL) AS s FROM lineitem),
p AS (SELECT a.l_orderkey AS query, b.l_orderkey AS target, a.l_partkey AS part, a.l_linenumber AS line, a.s AS q, b.s AS t, list_has_any(a.s, ['s35', 's53']) AS qs, list_has_any(b.s, ['s35', 's53']) AS ts FROM x a JOIN x b ON a.l_partkey = b.l_partkey AND a.l_linenumber = b.l_linenumber AND a.l_orderkey <> b.l_orderkey)
SELECT query, target, part, line, CASE WHEN list_sort(q) = list_sort(t) OR len(q) = 0 OR len(t) = 0 OR qs AND ts THEN NULL WHEN qs OR ts THEN 8 ELSE 7 END AS code FROM p""")
def interaction_conflicts(lineitem):
    pair = F.when(F.col("l_returnflag") == "A", "cWW").when(F.col("l_returnflag") == "N", "tHS")
    stack = F.when((F.col("l_linestatus") == "F") & (F.col("l_tax") < 0.035), "s35").when(F.col("l_tax") > 0.055, "s53")
    rows = lineitem.select(F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("line"), "l_orderkey", F.array_compact(F.array(pair, stack)).alias("s")).distinct()
    q, t = rows.withColumnsRenamed({"l_orderkey": "query", "s": "q"}), rows.withColumnsRenamed({"l_orderkey": "target", "s": "t"})
    code = motifs.conflict(F.col("q"), F.col("t"), F.array(F.lit("s35"), F.lit("s53")))
    return q.join(t, ["part", "line"]).where("query != target").select("query", "target", "part", "line", code.alias("code"))


@query("lineitem", sql="""
WITH c AS (SELECT l_suppkey, l_linenumber, l_orderkey, l_partkey, l_returnflag = 'R' OR l_quantity > 1 AS bad, (CAST(round(l_extendedprice * 100) AS BIGINT) % 12000) / 100 AS d FROM lineitem)
SELECT l_suppkey, l_linenumber, l_orderkey, l_partkey, NOT bad AS valid, d AS discrepancy FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY bad, d, l_orderkey, l_partkey) AS k FROM c WHERE d < 100) WHERE k = 1""")
def best_candidates(lineitem):
    bad = (F.col("l_returnflag") == "R") | (F.col("l_quantity") > 1)
    rows = lineitem.select("l_suppkey", "l_linenumber", "l_orderkey", "l_partkey", F.when(bad, F.array(F.lit(7))).otherwise(F.array().cast("array<int>")).alias("dq"), (cents("l_extendedprice") % 12_000 / 100).alias("discrepancy"))
    best = motifs.best_candidates(rows, ["l_suppkey", "l_linenumber"], ["l_orderkey", "l_partkey"])
    return best.select("l_suppkey", "l_linenumber", "l_orderkey", "l_partkey", (F.size("dq") == 0).alias("valid"), "discrepancy")


@query("orders", "customer", "lineitem", "supplier", sql="""
WITH r AS (SELECT c_nationkey AS a, s_nationkey AS b, CASE count(*) FILTER (l_returnflag = 'R') % 3 WHEN 0 THEN NULL WHEN 1 THEN 7 ELSE 8 END AS dq, min(CAST(round(l_extendedprice * 100) AS BIGINT)) / 100 AS d
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT x.a, x.b, x.dq IS NULL OR y.dq IS NULL AS matched, CASE WHEN x.dq IS NULL OR y.dq IS NULL THEN least(x.d, y.d) ELSE 99999999999.0 END AS distance, CASE WHEN y.dq IS NOT NULL THEN x.dq END AS dq_ab, CASE WHEN x.dq IS NOT NULL THEN y.dq END AS dq_ba
FROM r x JOIN r y ON x.a = y.b AND x.b = y.a AND x.a < x.b""")
def matching_matrix(orders, customer, lineitem, supplier):
    rows = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).join(customer, orders.o_custkey == customer.c_custkey).join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
    code = F.count_if(F.col("l_returnflag") == "R") % 3
    results = rows.groupBy(F.col("c_nationkey").alias("a"), F.col("s_nationkey").alias("b")).agg(F.when(code == 1, 7).when(code == 2, 8).alias("dq"), (F.min(cents("l_extendedprice")) / 100).alias("discrepancy"))
    return motifs.matching(results)


ELEMENTS = """
c AS (SELECT l_orderkey, l_linenumber || '|1|' || repeat('A', CAST(l_quantity AS INT)) || l_partkey AS chain, l_returnflag = 'N' AS s, l_linenumber AS o, l_partkey, l_quantity FROM lineitem),
i AS (SELECT *, row_number() OVER w - 1 AS i, sum(length(chain) + 1) OVER (w ROWS UNBOUNDED PRECEDING) - 1 AS ends FROM c WINDOW w AS (PARTITION BY l_orderkey ORDER BY o, chain, s)),
e AS (SELECT l_orderkey, coalesce(string_agg(chain, '+' ORDER BY i) FILTER (ends <= 100), '') AS element, count(*) FILTER (s) AS structured, count(*) AS chains, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS length FROM i GROUP BY 1)"""


def _elements(lineitem):
    name = F.concat("l_linenumber", F.lit("|1|"), F.expr("repeat('A', cast(l_quantity as int))"), "l_partkey")
    chains = lineitem.select("l_orderkey", name.alias("chain"), (F.col("l_returnflag") == "N").alias("s"), "l_linenumber", F.col("l_quantity").cast("long").alias("length"))
    return motifs.element_rows(chains, "l_orderkey", "chain", [F.col("l_linenumber"), F.col("chain"), F.col("s")], "s")


@query("lineitem", sql=f"WITH {ELEMENTS} SELECT l_orderkey, element, chain, i AS index, s AS is_structured, i = 0 OR s AS is_integral, NOT (i = 0 OR s) AS is_accompanying FROM i JOIN e USING (l_orderkey)")
def element_chain_rows(lineitem):
    return _elements(lineitem).withColumn("index", F.col("index").cast("long"))


@query("lineitem", sql=f"WITH {ELEMENTS} SELECT l_orderkey, element, len(string_split(element, '+')) AS chain_count, structured, chains > 1 AS has_accompanying, length FROM e WHERE length >= 2")
def element_table(lineitem):
    """One row per element of two units or more; chain_count counts the chains in the id only."""
    length = lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("length")).where("length >= 2")
    rows = _elements(lineitem).groupBy("l_orderkey", "element").agg(F.count_if("is_structured").alias("structured"), (F.count("*") > 1).alias("has_accompanying"))
    return rows.join(length, "l_orderkey").select("l_orderkey", "element", F.size(F.split("element", r"\+")).cast("long").alias("chain_count"), "structured", "has_accompanying", "length")


@query("orders", "lineitem", sql="""
WITH l AS (SELECT o_custkey AS entry, CASE o_orderstatus WHEN 'F' THEN 'IL' ELSE 'HL' END AS kind, o_orderkey AS k, o_orderpriority AS pr, l_partkey AS u, l_quantity AS q, l_linenumber AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
o AS (SELECT entry, kind, 'L' || k AS old, list_sort(list(DISTINCT u)) AS units FROM l GROUP BY 1, 2, 3),
w AS (SELECT entry, kind, CASE WHEN pr IN ('1-URGENT', '2-HIGH') THEN 'L' ELSE 'N' END || k AS new, list_sort(list(DISTINCT u)) AS units, pr = '5-LOW' AS merged FROM l WHERE q <= 45 OR n = 1 GROUP BY 1, 2, 3, 5),
s AS (SELECT DISTINCT w.entry, new, old FROM w JOIN o ON w.entry = o.entry AND w.kind = o.kind AND (w.units = o.units OR new = old)),
c AS (SELECT o.entry, old, min(new) AS within FROM w JOIN o ON w.entry = o.entry AND w.kind = o.kind AND NOT merged AND list_has_all(o.units, w.units) GROUP BY 1, 2),
a AS (SELECT entry, new, min(old) AS partner FROM s GROUP BY 1, 2), b AS (SELECT entry, old, min(new) AS partner FROM s GROUP BY 1, 2)
SELECT w.entry, 'new' AS side, w.new AS id, CASE WHEN partner IS NULL THEN 'add' ELSE 'update' END AS action, partner FROM w LEFT JOIN a ON w.entry = a.entry AND w.new = a.new
UNION ALL SELECT o.entry, 'old', o.old, CASE WHEN partner IS NOT NULL THEN 'keep' WHEN within IS NOT NULL THEN 'deprecate' ELSE 'stay' END, coalesce(partner, within) FROM o LEFT JOIN b ON o.entry = b.entry AND o.old = b.old LEFT JOIN c ON o.entry = c.entry AND o.old = c.old""")
def loop_identity(orders, lineitem):
    """The orders of a customer as the loops of an entry, before and after their large lines are left out."""
    kind = F.when(F.col("o_orderstatus") == "F", "IL").otherwise("HL").alias("kind")
    lines = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey).select(F.col("o_custkey").alias("entry"), kind, "o_orderkey", "o_orderpriority", "l_partkey", "l_quantity", "l_linenumber")
    units = F.collect_set("l_partkey").alias("units")
    old = lines.groupBy("entry", "kind", F.concat(F.lit("L"), "o_orderkey").alias("name")).agg(units)
    name = F.concat(F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "L").otherwise("N"), F.col("o_orderkey"))
    new = lines.where("l_quantity <= 45 or l_linenumber = 1").groupBy("entry", "kind", name.alias("name"), (F.col("o_orderpriority") == "5-LOW").alias("merged")).agg(units)
    return motifs.loop_identity(new, old)


@query("orders", sql="""
WITH v AS (SELECT o_custkey AS g, o_orderkey AS k, o_orderstatus AS s, CAST(round(o_totalprice * 100) AS BIGINT) AS p FROM orders)
SELECT a.g, a.k AS item_1, b.k AS item_2, abs(a.p - b.p) / 1e7 AS distance FROM v a JOIN v b ON a.g = b.g AND a.k < b.k AND a.s <> b.s WHERE abs(a.p - b.p) / 1e7 < 0.4""")
def similar_across_groups(orders):
    """Pairs nearer than 0.4 whose items are in different groups."""
    rows = orders.select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("item"), F.col("o_orderstatus").alias("s"), cents("o_totalprice").alias("p"))
    distance = (F.abs(F.col("p_1") - F.col("p_2")) / 1e7).alias("distance")
    return relational.pairs_within(rows, "g", "item", ("s", "p")).where("s_1 != s_2").select("g", "item_1", "item_2", distance).where("distance < 0.4")


@query("events", sql="SELECT user_id, CAST(sum(n) AS BIGINT) AS size, max(n) AS most, max(n) / sum(n) AS share FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def group_evaluation(events):
    """Size of each group and the frequency of its most frequent label."""
    counts = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return counts.groupBy("user_id").agg(F.sum("n").alias("size"), F.max("n").alias("most"), (F.max("n") / F.sum("n")).alias("share"))


@query("orders", "lineitem", sql="""
WITH e AS (SELECT o_custkey AS g, o_orderkey AS item, count(*) FILTER (l_returnflag = 'N') AS bp, count(*) AS nt FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY bp / nt DESC, item) AS k1, row_number() OVER (PARTITION BY g ORDER BY nt DESC, item) AS k2, row_number() OVER (PARTITION BY g ORDER BY item) AS k3 FROM e)
SELECT g, item, bp, nt, round(bp / nt, 4) AS ratio, CASE WHEN k1 = 1 THEN 'Representative' ELSE 'Member' END AS by_ratio, CASE WHEN k2 = 1 THEN 'Representative' ELSE 'Member' END AS by_length, CASE WHEN k3 = 1 THEN 'Representative' ELSE 'Member' END AS current FROM r""")
def pair_rate_report(orders, lineitem):
    """Pairs per unit of each member, and whether each method would make it the representative; one choice per method, joined back."""
    rows = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey).groupBy(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("item")).agg(F.count_if(F.col("l_returnflag") == "N").alias("bp"), F.count("*").alias("nt"))
    rate = F.col("bp") / F.col("nt")
    least = lambda *order: F.min(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], "item"))["item"]
    chosen = rows.groupBy("g").agg(least(-rate).alias("c1"), least(-F.col("nt")).alias("c2"), F.min("item").alias("c3"))
    status = lambda c: F.when(F.col("item") == F.col(c), "Representative").otherwise("Member")
    return rows.join(chosen, "g").select("g", "item", "bp", "nt", F.round(rate, 4).alias("ratio"), status("c1").alias("by_ratio"), status("c2").alias("by_length"), status("c3").alias("current"))


@query("orders", sql="""
WITH r AS (SELECT o_custkey, year(o_orderdate) AS release, max(o_orderdate) AS day, string_agg(DISTINCT o_orderstatus, '' ORDER BY o_orderstatus) AS s FROM orders GROUP BY 1, 2)
SELECT o_custkey, release, strftime(day, '%Y%m%d') AS description FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC) AS k FROM r WHERE s = 'FO') WHERE k = 1""")
def newest_exact_release(orders):
    """The newest release of each customer that covers exactly the required set, described by its date."""
    releases = orders.groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("release")).agg(F.max("o_orderdate").alias("day"), F.array_sort(F.collect_set("o_orderstatus")).alias("s"))
    exact = releases.where(F.col("s") == F.array(F.lit("F"), F.lit("O")))
    newest = exact.groupBy("o_custkey").agg(F.max(F.struct("day", "release")).alias("x"))
    return newest.select("o_custkey", F.col("x.release").alias("release"), F.date_format("x.day", "yyyyMMdd").alias("description"))


@query("orders", "customer", "nation", sql="""
SELECT n_name, c_mktsegment, string_agg(o_orderkey || ':' || c_name, '; ' ORDER BY o_orderkey) AS members, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' GROUP BY 1, 2""")
def class_listing(orders, customer, nation):
    """The members of each class (two keys) as one list, in order."""
    rows = orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'").join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)
    members = F.array_sort(F.collect_list(F.struct("o_orderkey", "c_name")))
    texts = F.transform(members, lambda m: F.concat(m["o_orderkey"], F.lit(":"), m["c_name"]))
    return rows.groupBy("n_name", "c_mktsegment").agg(F.array_join(texts, "; ").alias("members"), F.count("*").alias("n"))
