"""State, synchronisation and mutations over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.functions import scalar as X
from storyloom.operators import mutations as M
from storyloom.operators import state as C
from storyloom.plans.registry import query
from storyloom.tables import table

B = "bigint"


@query("next_candidate", """
SELECT min(o_orderkey) AS segment_id FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_orderkey % 10 <> 1""")
def next_candidate(spark, d):
    seg = table(spark, d, "orders").select(F.col("o_orderkey").alias("segment_id"), F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("ready"))
    states = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("segment_id"), F.when(F.col("l_returnflag") == "R", "F").otherwise("C").alias("state"))
    locks = seg.where("segment_id % 10 = 1").select("segment_id")
    return C.next_candidate(seg, states, locks).select("segment_id")


@query("ready_flag", "SELECT user_id, CASE WHEN bool_or(value > 200) THEN 'F' WHEN bool_and(value > 1) THEN 'Y' ELSE 'N' END AS ready FROM events GROUP BY 1")
def ready_flag(spark, d):
    e = table(spark, d, "events").withColumn("state", F.when(F.col("value") > 200, "F").when(F.col("value") > 1, "C").otherwise("P"))
    return C.ready_flag(e, "user_id")


@query("task_transition", """
SELECT event_id, CASE WHEN event_type = 'click' AND value <= 90 THEN 'C' WHEN value < 10 THEN 'P' WHEN value < 50 THEN 'C' ELSE 'F' END AS state FROM events""")
def task_transition(spark, d):
    v = F.col("value")
    current = F.when(F.col("event_type") == "click", "C").otherwise("P")
    return table(spark, d, "events").select("event_id", C.next_state(current, v >= 10, v < 50, v > 90).alias("state"))


@query("latest_state", "SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def latest_state(spark, d):
    return M.latest(table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("session_complete", """
SELECT l_orderkey, CASE WHEN bool_or(l_linestatus = 'O') THEN 'wait' WHEN bool_or(l_returnflag = 'R') THEN 'report' ELSE 'publish' END AS outcome FROM lineitem GROUP BY 1""")
def session_complete(spark, d):
    return C.session_outcome(table(spark, d, "lineitem"), "l_orderkey", F.col("l_linestatus") == "O", F.col("l_returnflag") != "R")


@query("phase_promote", "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'P' ELSE 'R' END AS phase, CASE o_orderstatus WHEN 'P' THEN 'R' WHEN 'O' THEN 'R' ELSE 'D' END AS recalled FROM orders")
def phase_promote(spark, d):
    p = F.when(F.col("o_orderstatus") == "F", "D").when(F.col("o_orderstatus") == "O", "R").otherwise("P")
    return table(spark, d, "orders").select("o_orderkey", C.moved_phase(p, F.lit("R")).alias("phase"), C.moved_phase(p, F.lit("R"), up=False).alias("recalled"))


@query("publish_gate", """
SELECT o_custkey, bool_and(o_orderstatus <> 'F' AND o_totalprice > 1000) AS may_publish, count(*) FILTER (NOT (o_orderstatus <> 'F' AND o_totalprice > 1000)) AS failing FROM orders GROUP BY 1""")
def publish_gate(spark, d):
    phase = F.when(F.col("o_orderstatus") == "F", "D").otherwise("R")
    return C.may_publish(table(spark, d, "orders"), "o_custkey", [F.col("o_totalprice") > 1000], phase, to_production=True)


@query("tag_sync", """
SELECT d.doc_id AS segment_id, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN l.quality <> d.n_chars % 2 THEN 'changed' ELSE 'unchanged' END AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def tag_sync(spark, d):
    remote = table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), (F.col("n_chars") % 2).alias("last_modified"))
    local = table(spark, d, "labels").select(F.col("doc_id").alias("segment_id"), F.col("quality").cast(B).alias("last_modified"))
    return C.tag_sync(remote, local).select("segment_id", "status")


@query("best_aligner_pass", """
SELECT user_id, arg_min(p, (unaligned, max_run, p)) AS pass FROM (SELECT user_id, event_type AS p, count(*) FILTER (value > 50) AS unaligned, max(floor(value))::BIGINT AS max_run FROM events GROUP BY 1, 2) GROUP BY 1""")
def best_aligner_pass(spark, d):
    r = table(spark, d, "events").groupBy("user_id", F.col("event_type").alias("pass")).agg(F.count_if(F.col("value") > 50).alias("unaligned"), F.max(F.floor("value")).alias("max_run"))
    return C.best_pass(r, "user_id").select("user_id", "pass")


def _old_new(spark, d):
    c = table(spark, d, "customer")
    old = c.where("c_acctbal >= 0").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return old, c.where("c_acctbal < 5000").select(F.col("c_custkey").alias("k"), (F.col("c_acctbal") + 1).alias("v"))


@query("insert_if_absent", "SELECT c_custkey AS k, CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE c_acctbal + 1 END AS v FROM customer")
def insert_if_absent(spark, d):
    return M.insert_if_absent(*_old_new(spark, d), ["k"])


@query("upsert", "SELECT c_custkey AS k, CASE WHEN c_acctbal < 5000 THEN c_acctbal + 1 ELSE c_acctbal END AS v FROM customer")
def upsert(spark, d):
    return M.upsert(*_old_new(spark, d), ["k"], "v")


@query("insert_set", "SELECT o_custkey AS a, o_orderstatus AS b FROM orders WHERE o_orderstatus <> 'F' UNION SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'")
def insert_set(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("a"), F.col("o_orderstatus").alias("b"), "o_orderkey")
    return M.insert_set(o.where("o_orderstatus <> 'F'").drop("o_orderkey"), o.where("o_orderstatus <> 'O'").drop("o_orderkey"))


@query("replace_children", """
SELECT l_orderkey AS p, l_partkey AS c FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def replace_children(spark, d):
    old = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("p"), F.col("l_partkey").alias("c"))
    return M.replace_children(old, table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("p"), F.col("o_custkey").alias("c")), "p")


@query("update_if_unchanged", "SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 4 <> 0 THEN 0.0 ELSE c_acctbal END AS v FROM customer")
def update_if_unchanged(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    half = c.where("k % 2 = 0")
    seen = half.withColumn("v", F.when(F.col("k") % 4 == 0, F.col("v") - 1).otherwise(F.col("v")))
    return M.update_if_unchanged(c, half.withColumn("v", F.lit(0.0)), seen, ["k"], ["v"])[0]


@query("cascade_delete", """
SELECT 'customer' AS t, count(*) AS n FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey % 5 <> 0
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 5 = 0)""")
def cascade_delete(spark, d):
    tables = {t: table(spark, d, t) for t in ("customer", "orders", "lineitem")}
    out = M.cascade_delete(tables, [("orders", "customer", "o_custkey"), ("lineitem", "orders", "l_orderkey")], "customer", "c_custkey", tables["customer"].where("c_custkey % 5 = 0"))
    counts = [df.agg(F.lit(t).alias("t"), F.count("*").alias("n")) for t, df in out.items()]
    return counts[0].union(counts[1]).union(counts[2])


@query("queue_drain", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def queue_drain(spark, d):
    return M.dequeue(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("hash_diff", "SELECT doc_id::VARCHAR AS path, base64(unhex(md5(text))) AS content_md5 FROM documents WHERE lang <> 'en' OR n_chars < 1000")
def hash_diff(spark, d):
    t = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"), "lang", "n_chars")
    manifest = t.where("lang = 'en'").select("path", X.md5_base64(F.when(F.col("n_chars") < 1000, F.lit("old")).otherwise(F.col("content"))).alias("content_md5"))
    return M.changed(t, manifest).select("path", "content_md5")


@query("guarded_update", """
SELECT l_orderkey AS k, l_partkey AS c, l_suppkey AS s, CASE WHEN l_linestatus = 'O' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') THEN 'new' ELSE l_returnflag END AS v
FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_returnflag FROM lineitem) QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey) = 1""")
def guarded_update(spark, d):
    from pyspark.sql import Window

    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("c"), F.col("l_suppkey").alias("s"), F.col("l_returnflag").alias("v"), "l_linestatus").distinct()
    l = l.withColumn("n", F.count("*").over(Window.partitionBy("k", "c", "s"))).where("n = 1").drop("n")
    new = l.where("l_linestatus = 'O'").select("k", "c", "s", F.lit("new").alias("v"))
    locked = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("k"))
    return M.guarded_update(l.drop("l_linestatus"), new, ["k", "c", "s"], ["v"], "k", locked)[0]


@query("modified_propagation", """
SELECT o_orderkey, greatest(o_orderdate, coalesce(m, o_orderdate))::DATE::VARCHAR AS modified FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def modified_propagation(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("modified"))
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("modified"))
    return M.propagated_modified(o, l, "o_orderkey").select("o_orderkey", F.date_format("modified", "yyyy-MM-dd").alias("modified"))


@query("fk_violations", "SELECT l_orderkey AS k, (l_suppkey + 5) AS s FROM lineitem WHERE l_suppkey + 5 NOT IN (SELECT s_suppkey FROM supplier)")
def fk_violations(spark, d):
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") + 5).alias("s"))
    return M.fk_violations(l, table(spark, d, "supplier").select(F.col("s_suppkey").alias("s")), "s").select("k", "s")
