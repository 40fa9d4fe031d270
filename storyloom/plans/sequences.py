"""Ordered sequences and set operations over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.operators import sequences as S
from storyloom.plans.registry import query
from storyloom.tables import table

B = "bigint"
_SEG = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_SEGS = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _stories(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    return table(spark, d, "lineitem").join(o, "l_orderkey")


def _events(spark, d):
    """Events as words: start and end in ms, unknown for errors."""
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts", F.floor(F.col("value") * 1000).cast(B).alias("v"))
    return e


@query("link_segments", f"""
SELECT o_custkey, l_orderkey, l_linenumber::BIGINT AS line, l_partkey, coalesce(lag(l_partkey) OVER w, 0) AS prev_id, coalesce(lead(l_partkey) OVER w, 0) AS next_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, l_orderkey, {_SEGS})""")
def link_segments(spark, d):
    t = S.linked(_stories(spark, d), "o_custkey", ["o_orderdate", "l_orderkey", *_SEG], "l_partkey")
    return t.select("o_custkey", "l_orderkey", F.col("l_linenumber").cast(B).alias("line"), "l_partkey", "prev_id", "next_id")


@query("ordinal_names", f"""
SELECT l_orderkey, l_partkey, n AS ordinal, format('{{}}_{{:03d}}', l_orderkey, n) AS ordinal_name FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_SEGS}) AS n FROM lineitem)""")
def ordinal_names(spark, d):
    t = table(spark, d, "lineitem").withColumn("movie", F.col("l_orderkey").cast("string"))
    return S.ordinal_names(t, "l_orderkey", _SEG, "movie").select("l_orderkey", "l_partkey", "ordinal", "ordinal_name")


@query("lead_minus_frame", """
SELECT conv_id, turn, lead(s) OVER w - 1 AS default_end, lead(s) OVER w IS NULL AS runs_to_end FROM (SELECT *, turn * 300 + length(text) AS s FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def lead_minus_frame(spark, d):
    c = table(spark, d, "conversations").withColumn("s", (F.col("turn") * 300 + F.length("text")).cast(B))
    return S.default_ends(c, "conv_id", ["turn"], "s", 1).select("conv_id", "turn", "default_end", "runs_to_end")


@query("gap_validation", """
SELECT user_id, event_id, CASE WHEN g IS NULL THEN 'first' WHEN g < 5 THEN 'short' WHEN g > 900 THEN 'long' ELSE 'ok' END AS gap
FROM (SELECT *, s - lag(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (SELECT *, event_id * 3 AS s FROM events))""")
def gap_validation(spark, d):
    e = table(spark, d, "events").withColumn("s", F.col("event_id") * 3)
    return S.gap_status(e, "user_id", ["ts", "event_id"], "s", 5, 900).select("user_id", "event_id", "gap")


@query("positional_repair", """
WITH n AS (SELECT conv_id, turn, length(text) AS v, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY length(text), turn) AS j FROM conversations)
SELECT a.conv_id, a.turn, b.v FROM n a JOIN n b ON a.conv_id = b.conv_id AND a.i = b.j""")
def positional_repair(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").cast(B).alias("v"))
    return S.reassigned(c, "conv_id", "turn", "v").select("conv_id", "turn", "v")


@query("respread_tail", """
WITH c AS (SELECT conv_id, turn, turn * 400 AS s, turn * 400 + length(text) AS e, 1500 AS dur FROM conversations),
g AS (SELECT *, coalesce(max(turn) FILTER (e <= dur) OVER (PARTITION BY conv_id), -1) AS good FROM c),
f AS (SELECT *, coalesce(max(e) FILTER (turn = good) OVER (PARTITION BY conv_id), 0) AS fr, count(*) FILTER (turn > good) OVER (PARTITION BY conv_id) AS n, sum((turn > good)::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS nth FROM g)
SELECT conv_id, turn, (CASE WHEN turn > good THEN fr + (nth - 1) * ((dur - fr) // greatest(n, 1)) ELSE s END)::BIGINT AS s, (CASE WHEN turn > good THEN fr + nth * ((dur - fr) // greatest(n, 1)) ELSE e END)::BIGINT AS e FROM f""")
def respread_tail(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", (F.col("turn") * 400).alias("s"), (F.col("turn") * 400 + F.length("text")).cast(B).alias("e"), F.lit(1500).cast(B).alias("dur"))
    return S.respread_tail(c, "conv_id", "turn", "s", "e", "dur").select("conv_id", "turn", F.col("s").cast(B).alias("s"), F.col("e").cast(B).alias("e"))


@query("interpolate_runs", """
WITH b AS (SELECT user_id, event_id, event_type NOT IN ('error', 'view') AS k, event_id * 100 AS s, event_id * 100 + 50 AS e FROM events),
x AS (SELECT *, sum(k::INT) OVER w AS blk, coalesce(last_value(CASE WHEN k THEN e END IGNORE NULLS) OVER w, 0) AS bef,
  first_value(CASE WHEN k THEN s END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS aft FROM b WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
y AS (SELECT *, count(*) OVER (PARTITION BY user_id, blk, k) AS n, row_number() OVER (PARTITION BY user_id, blk, k ORDER BY event_id) - 1 AS i FROM x)
SELECT user_id, event_id, (CASE WHEN k THEN s ELSE bef + i * ((coalesce(aft, bef) - bef) // n) END)::BIGINT AS s, (CASE WHEN k THEN e ELSE bef + (i + 1) * ((coalesce(aft, bef) - bef) // n) END)::BIGINT AS e
FROM y WHERE k OR aft IS NOT NULL OR n <= 3""")
def interpolate_runs(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", (F.col("event_id") * 100).alias("s"), (F.col("event_id") * 100 + 50).alias("e"))
    return S.interpolated(e, "user_id", ["event_id"], "s", "e", ~F.col("event_type").isin("error", "view")).select("user_id", "event_id", "s", "e")


@query("speaker_parity", """
WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations),
r AS (SELECT conv_id, coalesce(sum(length(text)) FILTER (i % 2 = 0), 0) // greatest(coalesce(sum(length(text)) FILTER (i % 2 = 1), 0), 1) >= 4 AS swapped FROM t GROUP BY 1)
SELECT t.conv_id, t.turn, ((CASE WHEN swapped THEN (i + 1) % 2 ELSE i % 2 END) + 1)::BIGINT AS speaker FROM t JOIN r ON t.conv_id = r.conv_id""")
def speaker_parity(spark, d):
    return S.speaker_labels(table(spark, d, "conversations"), "conv_id", ["turn"]).select("conv_id", "turn", "speaker")


@query("prefix_header", """
SELECT c_custkey, lag(substr(c_name, 1, 16)) OVER w IS DISTINCT FROM substr(c_name, 1, 16) AS is_header FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_name, c_custkey)""")
def prefix_header(spark, d):
    return S.header_changes(table(spark, d, "customer"), ["c_name", "c_custkey"], F.substring("c_name", 1, 16), "c_mktsegment").select("c_custkey", "is_header")


@query("take_while_valid", """
WITH b AS (SELECT *, min(turn) FILTER (length(text) > 400) OVER (PARTITION BY conv_id) AS bad FROM conversations) SELECT conv_id, turn FROM b WHERE bad IS NULL OR turn < bad""")
def take_while_valid(spark, d):
    return S.take_while_valid(table(spark, d, "conversations"), "conv_id", "turn", F.length("text") <= 400).select("conv_id", "turn")


@query("all_or_nothing", "SELECT conv_id, turn FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE length(text) > 900)")
def all_or_nothing(spark, d):
    return S.all_or_nothing(table(spark, d, "conversations"), "conv_id", F.length("text") <= 900).select("conv_id", "turn")


@query("expand_to_next", "SELECT conv_id, turn, coalesce(lead(b) OVER (PARTITION BY conv_id ORDER BY turn), e) AS e FROM (SELECT *, turn * 100 AS b, turn * 100 + 50 AS e FROM conversations)")
def expand_to_next(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", (F.col("turn") * 100).alias("b"), (F.col("turn") * 100 + 50).alias("e"))
    return S.expanded_to_next(c, "conv_id", "turn", "b", "e").select("conv_id", "turn", "e")


@query("multi_key_sort", "SELECT o_orderkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey ORDER BY o_custkey, o_orderdate, o_orderkey, l_linenumber, l_partkey, l_suppkey")
def multi_key_sort(spark, d):
    t = _stories(spark, d).orderBy("o_custkey", "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return t.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")


@query("nested_ordering", "SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY 1")
def nested_ordering(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("a"))
    return g.select("l_orderkey", F.array_join(F.transform("a", lambda x: x["l_partkey"].cast("string")), ",").alias("parts"))


@query("union_distinct", "SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'P' UNION SELECT o_custkey FROM orders WHERE o_totalprice > 100000")
def union_distinct(spark, d):
    o = table(spark, d, "orders")
    return o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id")).union(o.where("o_totalprice > 100000").select("o_custkey")).distinct()


@query("except_ids", "SELECT o_orderkey AS id FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def except_ids(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id")).subtract(table(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey"))


@query("array_distinct_tokens", "SELECT p_partkey, list_aggregate(list_sort(list_distinct(string_split(p_name, ' '))), 'string_agg', '|') AS tokens FROM part")
def array_distinct_tokens(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(F.sort_array(F.array_distinct(F.split("p_name", " "))), "|").alias("tokens"))
