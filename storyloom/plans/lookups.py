"""Scans, lookups and predicates over the test tables in the archive's roles: customers are collections, orders sessions, line
items segments, events task states, labels tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.operators import lookups as L
from storyloom.plans.registry import query
from storyloom.tables import table


@query("full_scan", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def full_scan(spark, d):
    return table(spark, d, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))


@query("projected_scan", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate::DATE::VARCHAR AS ship_date FROM lineitem")
def projected_scan(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"))


@query("point_lookup", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000042' ORDER BY c_custkey LIMIT 1")
def point_lookup(spark, d):
    return L.point_lookup(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey", c_name="Customer#000000042")


@query("ci_lookup", "SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'building'")
def ci_lookup(spark, d):
    return L.ci_lookup(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "Building")


@query("compound_filter", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity = 10")
def compound_filter(spark, d):
    t = table(spark, d, "lineitem")
    return t.where("l_returnflag = 'R' and l_linestatus = 'F' and l_quantity = 10").select("l_orderkey", "l_partkey", "l_suppkey")


@query("not_equal_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def not_equal_filter(spark, d):
    return table(spark, d, "orders").where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus")


@query("in_list", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'O')")
def in_list(spark, d):
    return L.one_of(table(spark, d, "orders"), "o_orderstatus", ["P", "O"]).select("o_orderkey", "o_orderstatus")


@query("column_compare_range", "SELECT o_orderkey, l_partkey, l_suppkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderdate <= l_shipdate")
def column_compare_range(spark, d):
    o, l = table(spark, d, "orders"), table(spark, d, "lineitem")
    return o.join(l, o.o_orderkey == l.l_orderkey).where("o_orderdate <= l_shipdate").select("o_orderkey", "l_partkey", "l_suppkey")


@query("range_filter", "SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1995-06-30 00:00:00'")
def range_filter(spark, d):
    return table(spark, d, "orders").where("o_orderdate <= timestamp_ntz'1995-06-30 00:00:00'").select("o_orderkey")


@query("date_range_half_open", "SELECT year(o_orderdate)::BIGINT AS y, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1994-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1")
def date_range_half_open(spark, d):
    o = table(spark, d, "orders").where("o_orderdate >= timestamp_ntz'1994-01-01' and o_orderdate < timestamp_ntz'1997-01-01'")
    return o.groupBy(F.year("o_orderdate").cast("bigint").alias("y")).agg(F.count("*").alias("n"))


@query("exists_any", "SELECT count(*) > 0 AS found FROM (SELECT 1 FROM events WHERE event_type = 'error' LIMIT 1)")
def exists_any(spark, d):
    return L.exists(table(spark, d, "events"), F.col("event_type") == "error")


@query("bool_all_any", "SELECT user_id, bool_and(event_type <> 'error') AS all_true, bool_or(event_type <> 'error') AS any_true FROM events GROUP BY user_id")
def bool_all_any(spark, d):
    return L.all_any(table(spark, d, "events"), "user_id", F.col("event_type") != "error")


@query("coalesce_projection", "SELECT o_orderkey, coalesce(l_linenumber, -1)::BIGINT AS line, coalesce(l_quantity, 0)::DOUBLE AS quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def coalesce_projection(spark, d):
    o, l = table(spark, d, "orders"), table(spark, d, "lineitem")
    return o.join(l, o.o_orderkey == l.l_orderkey, "left").select("o_orderkey", F.coalesce("l_linenumber", F.lit(-1)).cast("bigint").alias("line"), F.coalesce("l_quantity", F.lit(0.0)).cast("double").alias("quantity"))


@query("try_parse_int", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL")
def try_parse_int(spark, d):
    e = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("raw"))
    return L.keep_integers(e, "raw", "k").select("event_id", "k")


@query("dto_projection", "SELECT c_custkey AS id, upper(substr(c_name, 1, 1)) AS initial, substr(c_name, 1, 8) AS code, c_mktsegment AS facet FROM customer")
def dto_projection(spark, d):
    from storyloom.functions import scalar as X

    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), X.initial(F.col("c_name")).alias("initial"), X.tag_code(F.col("c_name")).alias("code"), F.col("c_mktsegment").alias("facet"))


@query("duration_tolerance", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE abs(l_extendedprice - l_quantity * 1000) <= 150")
def duration_tolerance(spark, d):
    t = table(spark, d, "lineitem")
    return t.where(L.within_tolerance(F.col("l_extendedprice"), F.lit(0), F.col("l_quantity") * 1000)).select("l_orderkey", "l_partkey", "l_suppkey")


@query("segment_bounds", """
SELECT l_orderkey, l_partkey, l_suppkey, bounded AS end_time, (s <= 30000 AND bounded > s) AS valid FROM (
  SELECT *, CASE WHEN l_linestatus = 'O' THEN 30000 ELSE least(e, 30000) END AS bounded FROM (
    SELECT *, (l_linenumber * 5000)::BIGINT AS s, (l_linenumber * 5000 + l_quantity::BIGINT * 200)::BIGINT AS e FROM lineitem))""")
def segment_bounds(spark, d):
    t = table(spark, d, "lineitem").withColumn("s", (F.col("l_linenumber") * 5000).cast("bigint"))
    t = t.withColumn("e", F.col("s") + F.col("l_quantity").cast("bigint") * 200)
    end, valid = L.bounded_segment(F.col("s"), F.col("e"), F.lit(30000).cast("bigint"), F.col("l_linestatus") == "O")
    return t.select("l_orderkey", "l_partkey", "l_suppkey", end.alias("end_time"), valid.alias("valid"))


@query("paged", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey, o_orderkey LIMIT 200 OFFSET 400")
def paged(spark, d):
    return L.page(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"], 400, 200)


@query("null_ids", "SELECT l_orderkey, l_partkey, nullif(l_suppkey % 3, 0) AS owner FROM lineitem")
def null_ids(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", L.null_id(F.col("l_suppkey") % 3).alias("owner"))


@query("length_truncation", "SELECT doc_id, substr(text, 1, 1024) AS text, length(text) > 1024 AS text_cut FROM documents")
def length_truncation(spark, d):
    return L.truncated(table(spark, d, "documents").select("doc_id", "text"), "text", 1024)
