"""Joins over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.operators import joins as J
from storyloom.plans.registry import query
from storyloom.tables import table

B = "bigint"


def _orders(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey", "o_orderstatus", "o_orderdate")


def _lines(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").cast(B).alias("line"), "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")


@query("hierarchy_inner_join", """
SELECT c_name, o_orderkey, l_linenumber::BIGINT AS line, l_partkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE n_name LIKE '%A%'""")
def hierarchy_inner_join(spark, d):
    n = table(spark, d, "nation").where("n_name like '%A%'")
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    o = _orders(spark, d).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return _lines(spark, d).join(o, "orderkey").select("c_name", F.col("orderkey").alias("o_orderkey"), "line", "l_partkey", "l_suppkey")


@query("group_join_left_outer", """
SELECT o_orderkey AS orderkey, count(l_linenumber) AS n, coalesce(string_agg(l_linenumber::VARCHAR || ':' || l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey), '') AS items
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def group_join_left_outer(spark, d):
    g = J.group_join(_orders(spark, d).select("orderkey"), _lines(spark, d), "orderkey", F.struct("line", "l_partkey"))
    return g.select("orderkey", F.size("items").cast(B).alias("n"), F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["line"], x["l_partkey"])), ",").alias("items"))


@query("group_join_filtered", """
SELECT o_orderkey AS orderkey, count(l_linenumber) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F' GROUP BY 1""")
def group_join_filtered(spark, d):
    o = _orders(spark, d).where("o_orderstatus <> 'F'").select("orderkey")
    return J.group_count(o, _lines(spark, d).select("orderkey"), "orderkey")


@query("semi_join_tagged", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def semi_join_tagged(spark, d):
    return J.semi(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels").where("toxic = 1"), "doc_id")


@query("anti_join_except", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_except(spark, d):
    return J.anti(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query("lookup_broadcast", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def lookup_broadcast(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query("three_way_routing", """
SELECT c_custkey, CASE r_name WHEN 'ASIA' THEN 'maker' WHEN 'EUROPE' THEN 'job' ELSE 'unknown' END AS route
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def three_way_routing(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select("c_custkey", J.route(F.col("r_name"), {"ASIA": "maker", "EUROPE": "job"}).alias("route"))


@query("missing_dim_rows", """
WITH dim AS (SELECT DISTINCT 'brand' || (n_nationkey % 5) AS name, (n_nationkey % 5)::BIGINT AS id FROM nation),
fresh AS (SELECT DISTINCT p_brand AS name FROM part WHERE p_brand NOT IN (SELECT name FROM dim))
SELECT id, name FROM dim UNION ALL SELECT (SELECT max(id) FROM dim) + row_number() OVER (ORDER BY name) AS id, name FROM fresh""")
def missing_dim_rows(spark, d):
    dim = table(spark, d, "nation").select((F.col("n_nationkey") % 5).cast(B).alias("id")).distinct().select("id", F.concat(F.lit("brand"), F.col("id")).alias("name"))
    return J.complete_dimension(table(spark, d, "part").select(F.col("p_brand").alias("name")), dim, "name", "id")


@query("reconcile_full_outer", """
WITH up AS (SELECT lower(c_name) AS file, (c_nationkey % 3)::BIGINT AS place, row_number() OVER (PARTITION BY lower(c_name) ORDER BY c_nationkey % 3) AS nth FROM customer WHERE c_custkey % 5 <> 0),
dn AS (SELECT lower(c_name) AS file, (c_nationkey % 2)::BIGINT AS place, row_number() OVER (PARTITION BY lower(c_name) ORDER BY c_nationkey % 2) AS nth FROM customer WHERE c_custkey % 7 <> 0)
SELECT coalesce(up.file, dn.file) AS file, CASE WHEN dn.place IS NULL THEN 'missing' WHEN up.place IS NULL THEN 'unreferenced' WHEN up.place = dn.place THEN 'matched' ELSE 'elsewhere' END AS bucket
FROM up FULL JOIN dn ON up.file = dn.file AND up.nth = dn.nth""")
def reconcile_full_outer(spark, d):
    c = table(spark, d, "customer").withColumn("file", F.lower("c_name"))
    up = c.where("c_custkey % 5 <> 0").select("file", (F.col("c_nationkey") % 3).cast(B).alias("place"))
    return J.reconcile(up, c.where("c_custkey % 7 <> 0").select("file", (F.col("c_nationkey") % 2).cast(B).alias("place")), "file", "place")


@query("orphan_scan", """
WITH l AS (SELECT 'biography' AS scope, (o_custkey + 40)::VARCHAR AS id FROM orders UNION ALL SELECT 'story', (doc_id * 2)::VARCHAR FROM documents UNION ALL SELECT 'other', '1')
SELECT l.scope, l.id, (l.scope = 'biography' AND l.id IN (SELECT c_custkey::VARCHAR FROM customer)) OR (l.scope = 'story' AND l.id IN (SELECT doc_id::VARCHAR FROM documents)) AS is_valid FROM l""")
def orphan_scan(spark, d):
    docs, custs = table(spark, d, "documents").select("doc_id"), table(spark, d, "customer").select("c_custkey")
    paths = table(spark, d, "orders").select(F.concat(F.lit("data/biography/details/"), (F.col("o_custkey") + 40).cast("string")).alias("path"))
    paths = paths.union(docs.select(F.concat(F.lit("data/story/details/"), (F.col("doc_id") * 2).cast("string")))).union(spark.range(1).select(F.lit("data/other/x/1")))
    from storyloom.functions.scalar import blob_parts

    p = paths.select(blob_parts(F.col("path")).alias("p")).select("p.scope", "p.id")
    return J.orphans(p, {"biography": custs, "story": docs}).select("scope", "id", "is_valid")


@query("garbage_counts", """
WITH l AS (SELECT (o_custkey + 40)::VARCHAR AS id FROM orders), v AS (SELECT id IN (SELECT c_custkey::VARCHAR FROM customer) AS ok FROM l)
SELECT count(*) FILTER (ok) AS good, count(*) FILTER (NOT ok) AS bad, count(*) AS total FROM v""")
def garbage_counts(spark, d):
    from storyloom.operators.aggregates import good_bad_total

    p = table(spark, d, "orders").select(F.lit("biography").alias("scope"), (F.col("o_custkey") + 40).cast("string").alias("id"))
    return good_bad_total(J.orphans(p, {"biography": table(spark, d, "customer").select("c_custkey")}), F.col("is_valid"))


@query("range_containment_join", """
SELECT a.user_id, a.event_id, b.event_id AS paragraph FROM events a JOIN events b ON a.user_id = b.user_id
WHERE b.event_type = 'signup' AND a.event_type = 'purchase' AND a.value >= b.value AND a.value + 1 <= b.value + 30""")
def range_containment_join(spark, d):
    e = table(spark, d, "events")
    words = e.where("event_type = 'purchase'").select("user_id", "event_id", F.col("value").alias("s"), (F.col("value") + 1).alias("e"))
    spans = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("paragraph"), F.col("value").alias("lo"), (F.col("value") + 30).alias("hi"))
    return J.contained_in(words, spans, "user_id", "s", "e", "lo", "hi", cell=30).select("user_id", "event_id", "paragraph")


@query("interval_overlap_join", """
SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id FROM events a JOIN events b ON a.user_id = b.user_id
WHERE a.event_type = 'view' AND b.event_type = 'click' AND a.value < b.value + 5 AND b.value < a.value + 3""")
def interval_overlap_join(spark, d):
    e = table(spark, d, "events")
    a = e.where("event_type = 'view'").select("user_id", F.col("event_id").alias("first_id"), F.col("value").alias("s1"), (F.col("value") + 3).alias("e1"))
    b = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("second_id"), F.col("value").alias("s2"), (F.col("value") + 5).alias("e2"))
    return J.overlapping(a, b, "user_id", "s1", "e1", "s2", "e2", cell=5).select("user_id", "first_id", "second_id")


@query("ordinal_zip", """
WITH a AS (SELECT o_custkey AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
b AS (SELECT user_id AS k, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, b.n) AS ordinal, o_orderkey, event_id FROM a FULL JOIN b ON a.k = b.k AND a.n = b.n""")
def ordinal_zip(spark, d):
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey")
    b = table(spark, d, "events").select(F.col("user_id").alias("k"), "event_id", "ts")
    return J.ordinal_zip(a, b, "k", ["o_orderkey"], ["ts", "event_id"]).select("k", F.col("ordinal").cast(B).alias("ordinal"), "o_orderkey", "event_id")


@query("tree_match", """
WITH p AS (SELECT DISTINCT o_custkey AS root, o_orderkey AS a, l_linenumber AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity > 2),
s AS (SELECT DISTINCT o_custkey AS root, o_orderkey AS a, l_linenumber AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT coalesce(p.root, s.root) AS root, bool_and(p.root IS NOT NULL AND s.root IS NOT NULL) AS matches FROM p FULL JOIN s ON p.root = s.root AND p.a = s.a AND p.b = s.b GROUP BY 1""")
def tree_match(spark, d):
    t = _orders(spark, d).join(_lines(spark, d), "orderkey").select(F.col("o_custkey").alias("root"), F.col("orderkey").alias("a"), F.col("line").alias("b"), "l_quantity")
    return J.tree_match(t.where("l_quantity > 2"), t, "root", ["a", "b"])


@query("densify_states", """
WITH u AS (SELECT DISTINCT user_id FROM events), n(name) AS (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('caption'), ('align')),
s AS (SELECT user_id, event_type AS name, arg_max(CASE WHEN value > 50 THEN 'C' ELSE 'F' END, (ts, event_id)) AS state FROM events GROUP BY 1, 2)
SELECT u.user_id, n.name, coalesce(s.state, 'P') AS state FROM u CROSS JOIN n LEFT JOIN s ON s.user_id = u.user_id AND s.name = n.name""")
def densify_states(spark, d):
    e = table(spark, d, "events")
    s = e.groupBy("user_id", F.col("event_type").alias("name")).agg(F.max_by(F.when(F.col("value") > 50, "C").otherwise("F"), F.struct("ts", "event_id")).alias("state"))
    return J.densify(e, s, "user_id", "name", "state", ["click", "error", "purchase", "signup", "view", "caption", "align"], "P")


@query("explode_nested", "SELECT o_custkey, o_orderkey AS orderkey, l_linenumber::BIGINT AS line, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def explode_nested(spark, d):
    stories = _lines(spark, d).groupBy("orderkey").agg(F.collect_list(F.struct("line", "l_partkey")).alias("stories"))
    docs = _orders(spark, d).join(stories, "orderkey").groupBy("o_custkey").agg(F.collect_list(F.struct("orderkey", "stories")).alias("sessions"))
    return J.flatten(docs, "sessions", "stories").select("o_custkey", "orderkey", "line", "l_partkey")


@query("ranked_lookup", """
WITH a AS (SELECT p_partkey, 1 AS rank, p_name AS cand FROM part UNION ALL SELECT p_partkey, 2, split_part(p_name, ' ', 1) FROM part UNION ALL SELECT p_partkey, 3, p_type FROM part),
g AS (SELECT p_type AS cand, min(p_partkey) AS id FROM part GROUP BY 1 UNION ALL SELECT split_part(p_name, ' ', 1), min(p_partkey) FROM part WHERE p_size < 5 GROUP BY 1),
g1 AS (SELECT cand, min(id) AS id FROM g GROUP BY 1)
SELECT p_partkey, arg_min(id, (rank, a.cand)) AS id, arg_min(a.cand, (rank, a.cand)) AS cand FROM a JOIN g1 ON a.cand = g1.cand GROUP BY 1""")
def ranked_lookup(spark, d):
    p = table(spark, d, "part")
    word = F.split_part("p_name", F.lit(" "), F.lit(1))
    attempts = p.select("p_partkey", F.explode(F.array(*(F.struct(F.lit(i).alias("rank"), c.alias("cand")) for i, c in ((1, F.col("p_name")), (2, word), (3, F.col("p_type")))))).alias("a")).select("p_partkey", "a.*")
    g = p.select(F.col("p_type").alias("cand"), F.col("p_partkey").alias("id")).union(p.where("p_size < 5").select(word, "p_partkey"))
    return J.ranked_lookup(attempts, J.first_wins(g, "cand", "id"), ["p_partkey"], "cand", "rank", "id")


@query("adjacency_lookahead", """
SELECT user_id, event_id, CASE WHEN lead(value) OVER w - (value + 1) <= 4 THEN lead(event_type) OVER w END AS following FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value, event_id)""")
def adjacency_lookahead(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "value", (F.col("value") + 1).alias("e"), "event_type")
    return e.select("user_id", "event_id", J.next_within("user_id", "value", "e", "event_type", 4, "event_id").alias("following"))


@query("twin_propagation", """
SELECT event_id, coalesce(v, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS v
FROM (SELECT *, CASE WHEN value > 60 THEN event_id END AS v FROM events)""")
def twin_propagation(spark, d):
    e = table(spark, d, "events").withColumn("v", F.when(F.col("value") > 60, F.col("event_id")))
    return J.propagate(e, ["user_id", "event_type"], "event_id", "v").select("event_id", "v")


@query("hierarchy_report", """
SELECT o_custkey, o_orderkey, l_linenumber::BIGINT AS line, l_partkey, repeat('  ', 2) || CASE WHEN length(p_name) > 12 AND strpos(substr(p_name, 10), ' ') > 0 THEN substr(p_name, 1, 9 + strpos(substr(p_name, 10), ' ') - 1) || '...' ELSE p_name END AS line_text
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""")
def hierarchy_report(spark, d):
    from storyloom.functions.scalar import shortened

    t = _orders(spark, d).join(_lines(spark, d), "orderkey").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return t.select("o_custkey", F.col("orderkey").alias("o_orderkey"), "line", "l_partkey", F.concat(F.lit("    "), shortened(F.col("p_name"), 12)).alias("line_text"))
