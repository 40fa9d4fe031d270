"""Archive documents and captions over the test tables in their roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.operators import documents as D
from storyloom.plans.registry import query
from storyloom.tables import table

B = "bigint"


@query("biography_documents", """
SELECT o.o_custkey AS collection_id, string_agg(o.o_orderkey || '(' || o.parts || ')', ' ' ORDER BY o.o_orderkey) AS outline FROM
 (SELECT o_custkey, o_orderkey, coalesce(string_agg(l_linenumber || '-' || l_partkey, ',' ORDER BY l_linenumber, l_partkey), '') AS parts FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2) o GROUP BY 1""")
def biography_documents(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("collection_id"), F.col("o_orderkey").alias("session_id"))
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("session_id"), "l_linenumber", "l_partkey")
    sessions = D.nested(o, l, "session_id", ["l_linenumber", "l_partkey"], "stories")
    c = o.select("collection_id").distinct()
    docs = D.nested(c, sessions, "collection_id", ["session_id"], "sessions")
    story = lambda x: F.concat_ws("-", x["l_linenumber"], x["l_partkey"])
    line = lambda s: F.concat(s["session_id"].cast("string"), F.lit("("), F.array_join(F.transform(s["stories"], story), ","), F.lit(")"))
    return docs.select("collection_id", F.array_join(F.transform("sessions", line), " ").alias("outline"))


@query("chosen_sessions", "SELECT o_orderkey AS session_id FROM orders WHERE o_orderstatus = 'P' OR o_orderkey IN (SELECT doc_id FROM labels)")
def chosen_sessions(spark, d):
    s = table(spark, d, "orders").select(F.col("o_orderkey").alias("session_id"), F.col("o_orderstatus").alias("phase"))
    return D.chosen_sessions(s, table(spark, d, "labels").select(F.col("doc_id").alias("session_id")), ["P"]).select("session_id")


@query("search_facets", """
SELECT l_orderkey AS story_id, coalesce(string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) FILTER (l_linestatus = 'F'), '') AS years FROM lineitem GROUP BY 1""")
def search_facets(spark, d):
    l = table(spark, d, "lineitem")
    e = l.select(F.col("l_orderkey").alias("segment_id"), F.when(F.col("l_linestatus") == "F", "Year").otherwise("Country").alias("type"), F.col("l_returnflag").alias("value"))
    s = D.story_search(l.select(F.col("l_orderkey").alias("story_id")).distinct(), e)
    return s.select("story_id", F.array_join("entity_years", ",").alias("years"))


@query("json_documents", "SELECT c_custkey::VARCHAR AS c_custkey, '{\"cCustkey\":' || c_custkey || ',\"cName\":\"' || c_name || '\"}' AS content FROM customer")
def json_documents(spark, d):
    from storyloom.sources.sinks import json_documents as documents

    return documents(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("vtt_files", """
SELECT conv_id, 'WEBVTT' || chr(10) || chr(10) || string_agg(format('{:02d}:{:02d}.000 --> {:02d}:{:02d}.000', turn * 4 // 60, turn * 4 % 60, (turn * 4 + 4) // 60, (turn * 4 + 4) % 60) || chr(10) || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || chr(10), chr(10) ORDER BY turn) AS content FROM conversations GROUP BY 1""")
def vtt_files(spark, d):
    from storyloom.sources.sinks import vtt

    c = table(spark, d, "conversations").select("conv_id", "turn", (F.col("turn") * 4000).alias("start"), (F.col("turn") * 4000 + 4000).alias("end"), F.array("text").alias("lines"))
    return vtt(c, "conv_id", seq="turn")


@query("caption_cues")
def caption_cues(spark, d):
    """Captions of each conversation as if its words were spoken one every 300 ms; a rule-bound walk, so without SQL twin."""
    from storyloom.operators.captions import captions

    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.regexp_replace("text", "\\s+", " ").alias("text")))).alias("t"))
    c = c.select(F.col("conv_id").alias("segment_id"), F.array_join(F.transform("t", lambda x: x["text"]), "\n\n").alias("transcript"))
    word = F.regexp_extract_all("transcript", F.lit("[^\\s]+"), F.lit(0))
    gaps = c.withColumns({"w": word, "g": F.split("transcript", "[^\\s]+", -1)})
    rows = gaps.select("segment_id", F.posexplode(F.arrays_zip("w", "g")).alias("seq", "z")).where("z.w is not null")
    from pyspark.sql import Window

    at = F.sum(F.length("z.g") + F.length("z.w")).over(Window.partitionBy("segment_id").orderBy("seq"))
    words = rows.select("segment_id", "seq", F.lit("success").alias("case"), F.col("z.w").alias("word"), (F.col("seq") * 300).alias("start"), (F.col("seq") * 300 + 280).alias("end"), (at - F.length("z.w")).alias("offset_start"), at.alias("offset_end"))
    segments = c.join(words.groupBy("segment_id").agg((F.max("end") + 10).alias("duration")), "segment_id")
    return captions(words, segments)
