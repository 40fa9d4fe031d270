"""Metrics and folds over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.operators import aggregates as A
from storyloom.plans.registry import query
from storyloom.tables import table

B = "bigint"


@query("corpus_metrics", """
WITH live AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus IN ('P', 'O')),
tags AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'),
r AS (SELECT c_custkey, c_mktsegment = 'BUILDING' AS sub, l.l_linenumber AS story, t.l_linenumber AS tag FROM live JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l ON l.l_orderkey = o_orderkey LEFT JOIN tags t ON t.l_orderkey = o_orderkey AND t.l_linenumber = l.l_linenumber),
p AS (SELECT c_custkey, sub, count(story) AS stories, count(tag) AS tagged FROM r GROUP BY 1, 2)
SELECT count(*) AS all_biographies, count(*) FILTER (tagged > 0) AS all_tagged_biographies, coalesce(sum(stories), 0)::BIGINT AS all_stories, coalesce(sum(tagged), 0)::BIGINT AS all_tagged_stories,
 count(*) FILTER (sub) AS subset_biographies, count(*) FILTER (sub AND tagged > 0) AS subset_tagged_biographies, coalesce(sum(stories) FILTER (sub), 0)::BIGINT AS subset_stories, coalesce(sum(tagged) FILTER (sub), 0)::BIGINT AS subset_tagged_stories FROM p""")
def corpus_metrics(spark, d):
    """The headline report: biographies and stories, all and tagged, of the corpus and of a subset."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("collection_id"), "c_mktsegment")
    s = table(spark, d, "orders").select(F.col("o_orderkey").alias("session_id"), F.col("o_custkey").alias("collection_id"), F.col("o_orderstatus").alias("phase"))
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("session_id"), F.col("l_linenumber").alias("story_no"), "l_returnflag")
    tagged = l.where("l_returnflag = 'R'").select("session_id", "story_no")
    return A.corpus_metrics(c, s, l.select("session_id", "story_no").distinct(), tagged, ["P", "O"], F.col("c_mktsegment") == "BUILDING")


@query("table_counts", "SELECT (SELECT count(*) FROM customer) AS collections, (SELECT count(*) FROM orders) AS sessions, (SELECT count(*) FROM lineitem) AS segments")
def table_counts(spark, d):
    return A.table_counts({"collections": table(spark, d, "customer"), "sessions": table(spark, d, "orders"), "segments": table(spark, d, "lineitem")})


@query("media_metrics", """
SELECT coalesce(sum(q), 0)::BIGINT AS total, coalesce(min(q), 0)::BIGINT AS shortest, coalesce(max(q), 0)::BIGINT AS longest, coalesce(floor(avg(q)), 0)::BIGINT AS average
FROM (SELECT l_quantity::BIGINT * 1000 AS q FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O')""")
def media_metrics(spark, d):
    t = table(spark, d, "lineitem").where("l_returnflag = 'N' and l_linestatus = 'O'")
    return A.media_metrics(t, F.col("l_quantity").cast(B) * 1000)


_STATE = "CASE WHEN value > 20 THEN 'C' WHEN value > 10 THEN 'F' ELSE 'R' END"


@query("processing_metrics", f"""
WITH s AS (SELECT user_id, max(st) FILTER (event_type = 'click') AS a, max(st) FILTER (event_type = 'purchase') AS b, max(st) FILTER (event_type = 'view') AS c FROM (SELECT *, {_STATE} AS st FROM events) GROUP BY 1),
w AS (SELECT coalesce(a, 'P') AS a, coalesce(b, 'P') AS b, coalesce(c, 'P') AS c FROM s),
m AS (SELECT count(*) FILTER (a = 'C' AND b = 'C' AND c = 'C') AS complete, count(*) FILTER ('F' IN (a, b, c)) AS failed, count(*) FILTER ('P' IN (a, b, c)) AS pending, count(*) FILTER ('R' IN (a, b, c)) AS running FROM w)
SELECT *, complete + failed + pending + running AS total FROM m""")
def processing_metrics(spark, d):
    e = table(spark, d, "events").withColumn("state", F.expr(_STATE))
    return A.processing_metrics(e, "user_id", "event_type", "state", ["click", "purchase", "view"])


@query("count_max_fold", """
SELECT user_id, event_type, count(*) AS n, max(floor(value / 25))::BIGINT AS confidence, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2""")
def count_max_fold(spark, d):
    e = table(spark, d, "events").withColumn("c", F.floor(F.col("value") / 25).cast(B)).withColumn("o", F.struct("ts", "event_id"))
    return A.fold(e, ["user_id", "event_type"], "o", "c", ["event_id"])


@query("confidence_boost", """
SELECT user_id, event_type, n, least(CASE WHEN n > 1 THEN confidence + 1 ELSE confidence END, 6) AS boosted FROM (SELECT user_id, event_type, count(*) AS n, max(floor(value / 25))::BIGINT AS confidence FROM events GROUP BY 1, 2)""")
def confidence_boost(spark, d):
    return count_max_fold(spark, d).select("user_id", "event_type", "n", A.boosted(F.col("confidence"), F.col("n"), 1, 6).cast(B).alias("boosted"))


@query("longest_run", """
WITH f AS (SELECT user_id, ts, event_id, event_type IN ('click', 'view') AS f FROM events), i AS (SELECT *, sum((NOT f)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS isl FROM f),
g AS (SELECT user_id, isl, count(*) FILTER (f) AS n FROM i GROUP BY 1, 2), h AS (SELECT *, max(isl) OVER (PARTITION BY user_id) AS last FROM g)
SELECT user_id, sum(n)::BIGINT AS flagged, coalesce(max(n) FILTER (isl < last), 0) AS longest FROM h GROUP BY 1""")
def longest_run(spark, d):
    return A.runs(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type").isin("click", "view"))


@query("alternating_char_count", "SELECT conv_id, coalesce(sum(length(text)) FILTER (turn % 2 = 0), 0)::BIGINT AS speaker1, coalesce(sum(length(text)) FILTER (turn % 2 = 1), 0)::BIGINT AS speaker2 FROM conversations GROUP BY 1")
def alternating_char_count(spark, d):
    return A.alternating_lengths(table(spark, d, "conversations"), "conv_id", "turn", "text")


@query("qa_counters", """
SELECT count(*) FILTER (length(text) > 74) AS too_long, count(*) FILTER (length(text) = 0) AS empty, count(*) FILTER (contains(text, '[') OR contains(text, ']')) AS brackets,
 count(*) FILTER (length(text) * 15 < 1000) AS too_short, count(*) FILTER (length(text) * 15 > 6000) AS too_slow, count(*) FILTER (regexp_matches(text, '  ')) AS double_spaces FROM conversations""")
def qa_counters(spark, d):
    n, t = F.length("text"), F.col("text")
    checks = {"too_long": n > 74, "empty": n == 0, "brackets": t.contains("[") | t.contains("]"), "too_short": n * 15 < 1000, "too_slow": n * 15 > 6000, "double_spaces": t.contains("  ")}
    return table(spark, d, "conversations").agg(*(F.count_if(c).alias(a) for a, c in checks.items()))


@query("facet_arrays", "SELECT l_orderkey, string_agg(p_type, '|' ORDER BY l_linenumber, l_partkey, l_suppkey, p_type) AS types FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def facet_arrays(spark, d):
    t = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return A.facet(t, "l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey"), F.col("p_type"), "types").select("l_orderkey", F.array_join("types", "|").alias("types"))


@query("facet_counts", "SELECT p_type AS type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def facet_counts(spark, d):
    t = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.collect_list("p_type").alias("types"))
    return A.facet_counts(t, "types", "type")


@query("eav_pivot", """
SELECT user_id, arg_max(value, (ts, event_id)) FILTER (event_type = 'click') AS favorite_click, arg_max(value, (ts, event_id)) FILTER (event_type = 'view') AS favorite_view FROM events GROUP BY 1""")
def eav_pivot(spark, d):
    e = table(spark, d, "events").withColumn("o", F.struct("ts", "event_id"))
    return A.eav_pivot(e, "user_id", "event_type", "value", "o", {"click": "favorite_click", "view": "favorite_view"})


@query("good_bad_total", "SELECT source, count(*) FILTER (n_chars > 200) AS good, count(*) FILTER (n_chars <= 200) AS bad, count(*) AS total FROM documents GROUP BY 1")
def good_bad_total(spark, d):
    return A.good_bad_total(table(spark, d, "documents"), F.col("n_chars") > 200, ["source"])


@query("cue_extents", """
SELECT conv_id, arg_min(turn * 1000, turn)::BIGINT AS start_time, arg_max(turn * 1000 + length(text), turn)::BIGINT AS end_time, string_agg(role, ' ' ORDER BY turn) AS role, length(string_agg(role, ' ' ORDER BY turn)) AS length FROM conversations GROUP BY 1""")
def cue_extents(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", (F.col("turn") * 1000).cast(B).alias("start_time"), (F.col("turn") * 1000 + F.length("text")).cast(B).alias("end_time"))
    return A.extents(c, ["conv_id"], "turn", "start_time", "end_time", "role")


@query("pk_violations", "SELECT l_orderkey, l_linenumber::BIGINT AS line, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_violations(spark, d):
    from storyloom.operators.mutations import pk_violations as violations

    return violations(table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast(B).alias("line")), ["l_orderkey", "line"])


@query("distinct_ids", "SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def distinct_ids(spark, d):
    return table(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_suppkey").distinct()
