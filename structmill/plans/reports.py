"""More operators bound to the test tables: choices, groups, set operations, reports; registered with those of ``queries``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.operators import groups
from structmill.plans.queries import QUERIES, ORACLES, query
from structmill.shared import small

__all__ = ["ORACLES", "QUERIES"]

KINDS = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'X-RAY DIFFRACTION' WHEN 'BUILDING' THEN 'SOLUTION NMR' WHEN 'FURNITURE' THEN 'ELECTRON MICROSCOPY' WHEN 'HOUSEHOLD' THEN 'FIBER DIFFRACTION' ELSE c_mktsegment END"


@query("customer", sql=f"SELECT c_custkey, CASE {KINDS} WHEN 'X-RAY DIFFRACTION' THEN 'x-ray' WHEN 'SOLUTION NMR' THEN 'nmr' WHEN 'ELECTRON MICROSCOPY' THEN 'cryo-em' WHEN 'FIBER DIFFRACTION' THEN 'fib-dif' ELSE c_mktsegment END AS method FROM customer")
def method_names(customer):
    return customer.select("c_custkey", groups.method_name(F.expr(KINDS)).alias("method"))


@query("lineitem", sql="SELECT l_orderkey, CASE WHEN count(*) FILTER (l_linenumber = 1) > 0 THEN '1_555' ELSE min(l_linenumber || '_555') END AS sym_op FROM lineitem GROUP BY 1")
def default_symmetry(lineitem):
    ops = lineitem.groupBy("l_orderkey").agg(F.collect_set(F.concat("l_linenumber", F.lit("_555"))).alias("ops"))
    return ops.select("l_orderkey", groups.default_symmetry(F.col("ops")).alias("sym_op"))


@query("orders", "customer", sql="SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def left_turned_inner(orders, customer):
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").where("c_acctbal > 0").select("o_orderkey", "c_mktsegment")


@query("nation", "region", sql="SELECT n_nationkey, r_regionkey FROM nation, region WHERE n_regionkey <> r_regionkey AND length(n_name) >= length(r_name)")
def product_with_predicate(nation, region):
    """A product of two dimension tables; the smaller is counted before it is sent to all."""
    return nation.join(small(region, 10_000), (F.col("n_regionkey") != F.col("r_regionkey")) & (F.length("n_name") >= F.length("r_name"))).select("n_nationkey", "r_regionkey")


@query("lineitem", "orders", sql="SELECT o_custkey, max(n) AS most FROM (SELECT o_custkey, o_orderkey, sum(CAST(l_quantity AS BIGINT)) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2) GROUP BY 1")
def max_of_sums(lineitem, orders):
    sums = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey).groupBy("o_custkey", "o_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("n"))
    return sums.groupBy("o_custkey").agg(F.max("n").alias("most"))


@query("orders", sql="SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) WHERE k = 1")
def group_first(orders):
    first = F.min_by(F.struct("o_orderkey", "o_orderstatus"), "o_orderkey").alias("x")
    return orders.groupBy("o_custkey").agg(first).select("o_custkey", "x.*")


@query("lineitem", sql="SELECT l_suppkey, count(*) AS n FROM (SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem) GROUP BY 1")
def distinct_tuples(lineitem):
    return lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_returnflag", "l_linestatus", "l_linenumber").alias("n"))


@query("part", sql="SELECT p_brand, CAST(sum(len(list_filter(string_split(p_type, ' '), lambda x: x IN ('STEEL', 'BRASS', 'TIN')))) AS BIGINT) AS atoms, sum(length(p_name)) AS letters FROM part GROUP BY 1")
def parsed_items(part):
    items = F.size(F.filter(F.split("p_type", " "), lambda x: x.isin("STEEL", "BRASS", "TIN")))
    return part.groupBy("p_brand").agg(F.sum(items).alias("atoms"), F.sum(F.length("p_name")).alias("letters"))


@query("lineitem", sql="SELECT l_orderkey, round(100.0::DOUBLE * count(*) FILTER (l_returnflag = 'R') / count(*), 4) AS clash_rate FROM lineitem GROUP BY 1")
def ratio_of_counts(lineitem):
    return lineitem.groupBy("l_orderkey").agg(F.round(100.0 * F.count_if(F.col("l_returnflag") == "R") / F.count("*"), 4).alias("clash_rate"))


@query("orders", sql="SELECT o_custkey, max(year(o_orderdate)) - min(year(o_orderdate)) AS span, max(o_orderkey) AS current FROM orders GROUP BY 1")
def version_range(orders):
    year = F.year("o_orderdate").cast("long")
    return orders.groupBy("o_custkey").agg((F.max(year) - F.min(year)).alias("span"), F.max("o_orderkey").alias("current"))


@query("orders", sql="SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def current_release(orders):
    """Rows of the newest release; the maximum is one row."""
    last = orders.agg(F.max(F.year("o_orderdate")).alias("y"))
    return orders.join(F.broadcast(last), F.year("o_orderdate") == F.col("y")).select("o_orderkey", "o_custkey")


@query("part", sql="SELECT p_brand, p_name FROM (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name), p_name) AS k FROM part) WHERE k = 1")
def shortest_per_key(part):
    return part.groupBy("p_brand").agg(F.min(F.struct(F.length("p_name").alias("n"), "p_name")).alias("x")).select("p_brand", "x.p_name")


@query("documents", "labels", sql="SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY quality IS NULL DESC, quality, doc_id) AS place FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)")
def nulls_first_then_value(documents, labels):
    rows = documents.join(labels.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left")
    return rows.select("doc_id", F.row_number().over(Window.partitionBy("source").orderBy(F.col("quality").isNull().desc(), "quality", "doc_id")).cast("long").alias("place"))


@query("part", sql="SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name), p_name, p_partkey) AS place FROM part")
def length_then_value(part):
    return part.select("p_partkey", F.row_number().over(Window.partitionBy("p_brand").orderBy(F.length("p_name"), "p_name", "p_partkey")).cast("long").alias("place"))


@query("customer", sql="SELECT c_mktsegment, c_nationkey, n, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, c_nationkey) AS place FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2)")
def groups_by_size(customer):
    sizes = customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    return sizes.withColumn("place", F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.desc("n"), "c_nationkey")).cast("long"))


@query("orders", "lineitem", sql="""
WITH n AS (SELECT o_custkey, o_orderkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2), r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderkey) AS k FROM n) WHERE k = 1)
SELECT c_nationkey, o_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, o_custkey) AS class_order FROM r JOIN (SELECT o_custkey AS x, o_custkey % 25 AS c_nationkey FROM orders GROUP BY 1, 2) ON x = o_custkey""")
def classes_by_representative(orders, lineitem):
    sizes = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey).groupBy("o_custkey", "o_orderkey").agg(F.count("*").alias("n"))
    reps = sizes.groupBy("o_custkey").agg(F.max("n").alias("n")).withColumn("c_nationkey", F.col("o_custkey") % 25)
    return reps.select("c_nationkey", "o_custkey", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("n"), "o_custkey")).cast("long").alias("class_order"))


CHAINS = "c AS (SELECT l_orderkey AS pdb, l_suppkey AS chain, count(*) FILTER (l_returnflag = 'A') * 4 AS internal, count(*) * 6 AS length, max(l_linenumber) AS bps, sum(CAST(l_quantity AS BIGINT)) AS full_length FROM lineitem GROUP BY 1, 2)"


def _chains(lineitem):
    return lineitem.groupBy(F.col("l_orderkey").alias("pdb"), F.col("l_suppkey").alias("chain")).agg((F.count_if(F.col("l_returnflag") == "A") * 4).alias("internal"), (F.count("*") * 6).alias("length"), F.max("l_linenumber").alias("bps"), F.sum(F.col("l_quantity").cast("long")).alias("full_length"))


@query("lineitem", sql=f"WITH {CHAINS} SELECT pdb, chain, row_number() OVER (PARTITION BY pdb ORDER BY bps DESC, internal DESC, length DESC, full_length DESC, chain) - 1 AS place FROM c")
def element_chain_order(lineitem):
    return groups.element_order(_chains(lineitem), "pdb").select("pdb", "chain", F.col("place").cast("long").alias("place"))


@query("lineitem", sql=f"""
WITH {CHAINS} SELECT pdb, chain_1, chain_2, CASE WHEN count < 2 THEN false WHEN l1 < 10 AND l2 < 10 THEN true WHEN count >= 3 AND (i1 < 5 OR i2 < 5) THEN true WHEN count >= 6 THEN true WHEN count < 3 AND i1 < 5 AND i2 < 5 THEN false ELSE greatest(count / (i1 + 0.001::DOUBLE), count / (i2 + 0.001::DOUBLE)) >= 0.6 END AS joins
FROM (SELECT a.pdb, a.chain AS chain_1, b.chain AS chain_2, abs(a.bps - b.bps) AS count, a.internal AS i1, a.length AS l1, b.internal AS i2, b.length AS l2 FROM c a JOIN c b ON a.pdb = b.pdb AND a.chain < b.chain)""")
def element_joins(lineitem):
    side = lambda k: _chains(lineitem).select("pdb", *[F.col(c).alias(f"{c}_{k}") for c in ("chain", "internal", "length", "bps")])
    both = side(1).join(side(2), "pdb").where("chain_1 < chain_2").withColumn("count", F.abs(F.col("bps_1") - F.col("bps_2")))
    return both.select("pdb", "chain_1", "chain_2", groups.should_join(*(F.col(c) for c in ("count", "internal_1", "length_1", "internal_2", "length_2"))).alias("joins"))


@query("orders", "lineitem", sql="SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def symmetric_difference(orders, lineitem):
    a, b = orders.select("o_orderkey").distinct(), lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return a.join(b, "o_orderkey", "left_anti").unionByName(b.join(a, "o_orderkey", "left_anti"))


@query("events", sql="SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(2 * value) AS BIGINT) AS twice FROM (SELECT event_type, floor(value) AS value FROM events) GROUP BY 1")
def nested_lists_flattened(events):
    nested = events.select("event_type", F.array(F.array(F.floor("value")), F.array(F.floor("value"))).alias("x"))
    flat = nested.select("event_type", F.explode(F.flatten("x")).alias("v"))
    return flat.groupBy("event_type").agg((F.count("*") / 2).cast("long").alias("n"), F.sum("v").cast("long").alias("twice"))


@query("documents", sql=r"SELECT doc_id, CAST(len(l) AS BIGINT) AS lines, md5(list_aggregate(l, 'string_agg', chr(10))) AS squeezed FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'))), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL) WHERE len(l) > 0")
def squeezed_lines(documents):
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " "))), lambda x: x != "")
    rows = documents.where("text is not null").select("doc_id", lines.alias("l")).where(F.size("l") > 0)
    return rows.select("doc_id", F.size("l").cast("long").alias("lines"), F.md5(F.array_join("l", "\n")).alias("squeezed"))


@query("documents", "labels", sql="SELECT doc_id, CAST(coalesce(n, m) AS DOUBLE) AS n_chars FROM (SELECT doc_id, n, median(n) OVER (PARTITION BY source) AS m FROM (SELECT d.doc_id, source, CASE WHEN t = 1 THEN NULL ELSE n_chars END AS n FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS t FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id))")
def median_imputation(documents, labels):
    toxic = labels.groupBy("doc_id").agg(F.max("toxic").alias("t"))
    rows = documents.join(toxic, "doc_id", "left").select("doc_id", "source", F.when(F.coalesce(F.col("t") != 1, F.lit(True)), F.col("n_chars")).alias("n"))
    return rows.select("doc_id", groups.median_filled(rows, "source", "n").cast("double").alias("n_chars"))


@query("orders", sql="SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")
def on_date(orders):
    last = orders.agg(F.to_date(F.max("o_orderdate")).alias("d"))
    return orders.join(F.broadcast(last), F.to_date("o_orderdate") == F.col("d")).select("o_orderkey")


@query("customer", sql="SELECT c_nationkey, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM (SELECT c_nationkey, c_mktsegment, count(*) AS v FROM customer GROUP BY 1, 2) GROUP BY 1")
def nested_dictionary(customer):
    """nation -> segment -> count as a map, then read back."""
    counts = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("v"))
    nested = counts.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "v"))).alias("m"))
    return nested.select("c_nationkey", F.size("m").cast("long").alias("n"), F.aggregate(F.map_values("m"), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("embeddings", sql="SELECT vec_id, CAST(i AS INTEGER) AS pair, e[2 * i + 1] AS a, e[2 * i + 2] AS b FROM (SELECT vec_id, embedding AS e, unnest(range(len(embedding) // 2)) AS i FROM embeddings)")
def pairs_of_list(embeddings):
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("embedding") / 2).cast("int") - 1), lambda i: F.struct(i.alias("pair"), F.col("embedding")[2 * i].alias("a"), F.col("embedding")[2 * i + 1].alias("b")))
    return embeddings.where(F.size("embedding") >= 2).select("vec_id", F.inline(pairs))


@query("documents", sql="WITH k AS (SELECT doc_id AS x, doc_id AS y FROM documents WHERE lang = 'en') SELECT a.doc_id AS doc_id_1, b.doc_id AS doc_id_2 FROM documents a JOIN documents b ON a.n_chars = b.n_chars AND a.doc_id <= b.doc_id WHERE NOT EXISTS (SELECT 1 FROM k WHERE x = a.doc_id AND y = b.doc_id)")
def dna_length_pairs(documents):
    known = documents.where("lang = 'en'").select(F.col("doc_id").alias("doc_id_1"), F.col("doc_id").alias("doc_id_2"))
    return groups.dna_pairs(documents, "doc_id", "n_chars", known)


@query("orders", "customer", sql="SELECT o_orderkey, c_custkey FROM orders JOIN customer ON CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_custkey + 1 END = c_custkey")
def case_in_join(orders, customer):
    return orders.join(customer, F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(F.col("o_custkey") + 1) == F.col("c_custkey")).select("o_orderkey", "c_custkey")



@query("lineitem", "orders", sql="SELECT l_orderkey AS k, 'zero' AS why FROM lineitem WHERE l_tax = 0 UNION SELECT o_orderkey, 'missing' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_or_zero(lineitem, orders):
    zero = lineitem.where("l_tax = 0").select(F.col("l_orderkey").alias("k"), F.lit("zero").alias("why")).distinct()
    missing = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey, "left_anti").select(F.col("o_orderkey").alias("k"), F.lit("missing").alias("why")).distinct()
    return zero.unionByName(missing)



@query("lineitem", sql="SELECT l_partkey, l_orderkey, l_extendedprice FROM (SELECT l_partkey, l_orderkey, l_extendedprice, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS k FROM lineitem WHERE l_extendedprice < 40000) WHERE k = 1")
def best_below_cutoff(lineitem):
    best = F.min(F.struct("l_extendedprice", "l_orderkey")).alias("x")
    return lineitem.where("l_extendedprice < 40000").groupBy("l_partkey").agg(best).select("l_partkey", "x.l_orderkey", "x.l_extendedprice")


@query("lineitem", "supplier", sql="WITH f AS (SELECT l_orderkey AS g, l_linenumber AS strand, l_suppkey % 20 AS family FROM lineitem) SELECT g, bool_or(a IS NOT NULL) AS shares FROM (SELECT DISTINCT g FROM f) LEFT JOIN (SELECT DISTINCT x.g AS a FROM f x JOIN f y ON x.g = y.g AND x.strand < y.strand AND x.family = y.family) ON a = g GROUP BY 1")
def family_pool_overlap(lineitem, supplier):
    strands = lineitem.groupBy(F.col("l_orderkey").alias("g"), "l_linenumber").agg(F.collect_set(F.col("l_suppkey") % 20).alias("pool"))
    pools = strands.select("g", F.explode("pool").alias("family")).groupBy("g", "family").agg(F.count("*").alias("strands"))
    return pools.groupBy("g").agg((F.max("strands") > 1).alias("shares"))


@query("lineitem", sql="SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber > 1 GROUP BY 1, 2 HAVING count(*) FILTER (l_returnflag IN ('A', 'R')) = 0")
def bulges(lineitem):
    """Interior units with no pair and no stack."""
    interior = lineitem.where("l_linenumber > 1").select("l_orderkey", "l_linenumber").distinct()
    return interior.join(lineitem.where("l_returnflag in ('A', 'R')"), ["l_orderkey", "l_linenumber"], "left_anti")


@query("documents", "labels", sql="SELECT d.doc_id, coalesce(own, parent) AS label FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS own FROM labels GROUP BY 1) a ON a.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, max(quality) AS parent FROM labels GROUP BY 1) b ON b.doc_id = d.doc_id // 2")
def annotation_carry_forward(documents, labels):
    found = labels.groupBy("doc_id").agg(F.max("quality").alias("label"))
    own, parent = found.withColumnRenamed("label", "own"), found.select(F.col("doc_id").alias("p"), F.col("label").alias("parent"))
    return documents.select("doc_id").join(own, "doc_id", "left").join(parent, F.floor(F.col("doc_id") / 2) == F.col("p"), "left").select("doc_id", F.coalesce("own", "parent").alias("label"))


@query("documents", "labels", sql="SELECT source, CASE WHEN avg(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0.0 END) >= 0.51 THEN 'named' ELSE 'mixed' END AS verdict FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id) GROUP BY 1")
def majority_of_descriptions(documents, labels):
    rows = documents.join(labels.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left")
    return rows.groupBy("source").agg(F.when(F.avg(F.when(F.col("quality") == 1, 1.0).otherwise(0.0)) >= 0.51, "named").otherwise("mixed").alias("verdict"))


@query("lineitem", sql="""
WITH f AS (SELECT l_suppkey AS f, min(l_quantity) AS s, min(l_quantity / (l_linenumber * 20)) AS r FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT l_suppkey, count(*) FILTER (CASE WHEN s IS NOT NULL THEN l_quantity >= s AND l_quantity / (l_linenumber * 20) >= least(0.5::DOUBLE, r) ELSE l_quantity > 30 AND l_quantity / (l_linenumber * 20) > 0.3 AND l_linenumber * 20 >= 30 END) AS kept, count(*) AS hits FROM lineitem LEFT JOIN f ON l_suppkey = f GROUP BY 1""")
def family_minima(lineitem):
    rows = lineitem.select("l_suppkey", "l_returnflag", F.col("l_quantity").alias("score"), (F.col("l_linenumber") * 20).alias("length"))
    least = rows.where("l_returnflag = 'A'").groupBy("l_suppkey").agg(F.min("score").alias("s"), F.min(F.col("score") / F.col("length")).alias("r"))
    kept = groups.above_family(*(F.col(c) for c in ("score", "length", "s", "r")))
    return rows.join(least, "l_suppkey", "left").groupBy("l_suppkey").agg(F.count_if(kept).alias("kept"), F.count("*").alias("hits"))


@query("lineitem", sql="SELECT l_partkey, l_suppkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS labels FROM lineitem GROUP BY 1, 2")
def labels_of_pair(lineitem):
    return lineitem.groupBy("l_partkey", "l_suppkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("labels"))


@query("customer", sql="""
WITH a AS (SELECT c_custkey AS i, c_nationkey AS g FROM customer), b AS (SELECT c_custkey AS i, CASE WHEN c_nationkey < 12 THEN c_nationkey ELSE c_custkey % 3 + 100 END AS g FROM customer),
x AS (SELECT a.g AS ga, b.g AS gb, count(*) AS n FROM a JOIN b USING (i) GROUP BY 1, 2), p AS (SELECT g, count(*) AS n FROM a GROUP BY 1), q AS (SELECT g, count(*) AS n FROM b GROUP BY 1)
SELECT ga, max(p.n) AS size, count(*) AS meets, max(x.n) AS largest, bool_or(x.n = p.n AND x.n = q.n) AS identical FROM x JOIN p ON p.g = ga JOIN q ON q.g = gb GROUP BY 1""")
def two_partitions(customer):
    a = customer.select("c_custkey", F.col("c_nationkey").cast("long").alias("g"))
    b = customer.select("c_custkey", F.when(F.col("c_nationkey") < 12, F.col("c_nationkey").cast("long")).otherwise(F.col("c_custkey") % 3 + 100).alias("g"))
    return groups.compared_partitions(a, b, "c_custkey", "g").withColumn("ga", F.col("ga").cast("int"))


@query("events", sql="SELECT event_type, CAST(sum(n) AS BIGINT) AS total, count(*) AS groups, max(n) AS most FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def annotation_spread(events):
    return groups.annotation_spread(events, "event_type", "user_id")


@query("lineitem", sql="WITH x AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'F') SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM x) GROUP BY 1")
def groups_with_xray(lineitem):
    good = lineitem.where("l_linestatus = 'F'").select("l_orderkey").distinct()
    return lineitem.join(good, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("lineitem", "orders", sql="SELECT o_custkey, l_suppkey, o_orderkey FROM (SELECT o_custkey, l_suppkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey, l_suppkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE k = 1")
def best_ranked_per_class(lineitem, orders):
    rows = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey)
    best = F.min(F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey")).alias("x")
    return rows.groupBy("o_custkey", "l_suppkey").agg(best).select("o_custkey", "l_suppkey", "x.o_orderkey")


@query("orders", sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1) // 5 AS INTEGER) AS page FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'")
def open_range_pages(orders):
    """From a date on, in pages of five a customer."""
    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return orders.where(F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp")).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.floor((at - 1) / 5).cast("int").alias("page"))



@query("orders", "lineitem", sql="""
WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT o_custkey, o_orderkey, n, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderkey) AS k FROM orders JOIN n ON o_orderkey = l_orderkey)
SELECT o_custkey AS class, max(CASE WHEN k = 1 THEN o_orderkey END) AS representative, count(*) AS members, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY k) AS listed FROM r GROUP BY 1""")
def class_report(orders, lineitem):
    sizes = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    ranked = orders.join(sizes, "o_orderkey").withColumn("k", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("n"), "o_orderkey")))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "o_orderkey"))), lambda x: x["o_orderkey"].cast("string")), ",")
    return ranked.groupBy(F.col("o_custkey").alias("class")).agg(F.max(F.when(F.col("k") == 1, F.col("o_orderkey"))).alias("representative"), F.count("*").alias("members"), listed.alias("listed"))


@query("orders", "lineitem", sql="""
WITH r AS (SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1) SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN r ON l_orderkey = o_orderkey""")
def loops_of_representatives(orders, lineitem):
    reps = orders.groupBy("o_custkey").agg(F.min(F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey")).alias("x")).select(F.col("x.o_orderkey").alias("l_orderkey"))
    return lineitem.join(reps, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey")
