"""Scalar functions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.functions import scalar as X
from storyloom.functions import timecode as T
from storyloom.plans.registry import query
from storyloom.tables import table

B = "bigint"


@query("scalar_time", """
SELECT event_id, (floor(epoch(ts))::BIGINT % 86400) * 1000 AS ms, format('{:03d}:{:02d}:{:02d}', v // 3600000, v // 60000 % 60, v // 1000 % 60) AS hms, format('{:02d}:{:02d}.{:03d}', v // 60000, v // 1000 % 60, v % 1000) AS vtt
FROM (SELECT *, event_id * 1000 AS v FROM events)""")
def scalar_time(spark, d):
    v = F.col("event_id") * 1000
    return table(spark, d, "events").select("event_id", X.ms_of_day(F.col("ts")).alias("ms"), X.ms_to_hms(v).alias("hms"), X.vtt_time(v).alias("vtt"))


@query("timecode_format", """
SELECT l_orderkey, l_partkey, format('{:02d}:{:02d}:{:02d}.{:02d}', c // 360000, c // 6000 % 60, c // 100 % 60, c % 100) AS code FROM (SELECT *, (l_orderkey * 25)::BIGINT AS c FROM lineitem)""")
def timecode_format(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", T.format_seconds(F.col("l_orderkey") * 0.25).alias("code"))


@query("timecode_parse", """
SELECT l_orderkey, l_partkey, ((l_linenumber * 60 + l_quantity::INT) * 30 + l_partkey % 30)::BIGINT AS frames FROM lineitem""")
def timecode_parse(spark, d):
    code = F.format_string("00:%02d:%02d:%02d", F.col("l_linenumber"), F.col("l_quantity").cast("int"), F.col("l_partkey") % 30)
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.round(T.parse(code) * 30).cast(B).alias("frames"))


@query("scalar_string", """
SELECT p_partkey, CASE WHEN length(p_name) > 12 AND strpos(substr(p_name, 10), ' ') > 0 THEN substr(p_name, 1, 9 + strpos(substr(p_name, 10), ' ') - 1) || '...' ELSE p_name END AS short,
 regexp_replace(p_name, '[^a-zA-Z0-9_]', '_', 'g') AS safe, upper(p_name) AS up, upper(substr(p_name, 1, 1)) AS initial, substr(p_type, 1, 8) AS code FROM part""")
def scalar_string(spark, d):
    n = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", X.shortened(n, 12).alias("short"), X.safe_file_name(n).alias("safe"), F.upper(n).alias("up"), X.initial(n).alias("initial"), X.tag_code(F.col("p_type")).alias("code"))


@query("scalar_names", """
SELECT c_custkey, 'Anna ' || substr(c_name, 1, 8) AS flipped, concat_ws(', ', nullif(c_mktsegment, 'BUILDING'), nullif('', '')) AS place FROM customer""")
def scalar_names(spark, d):
    seg = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", X.first_last(F.concat(F.substring("c_name", 1, 8), F.lit(", Anna"))).alias("flipped"), X.joined_nonempty(", ", seg, F.lit(" ")).alias("place"))


@query("scalar_date", """
SELECT o_orderkey, year(o_orderdate)::BIGINT AS y, month(o_orderdate)::BIGINT AS m, day(o_orderdate)::BIGINT AS dd, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed, o_orderkey % 4 = 1 AS bad FROM orders WHERE o_orderkey % 4 <> 1
UNION ALL SELECT o_orderkey, year(o_orderdate)::BIGINT, month(o_orderdate)::BIGINT, day(o_orderdate)::BIGINT, NULL, true FROM orders WHERE o_orderkey % 4 = 1""")
def scalar_date(spark, d):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, "").when(k == 1, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    o = F.col("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", F.year(o).cast(B).alias("y"), F.month(o).cast(B).alias("m"), F.dayofmonth(o).cast(B).alias("dd"), X.lenient_date(text).cast("string").alias("parsed"), X.bad_date(text).alias("bad"))


@query("aspect_ratio", """
SELECT l_orderkey, l_partkey, CASE WHEN h = 0 THEN NULL WHEN w * 100 // h = 133 THEN '4:3' WHEN w * 100 // h = 177 THEN '16:9' WHEN w = 20 AND h = 10 THEN '2:1' END AS ratio FROM (SELECT *, l_quantity::BIGINT AS w, (l_partkey % 30)::BIGINT AS h FROM lineitem)""")
def aspect_ratio(spark, d):
    t = table(spark, d, "lineitem").withColumns({"w": F.col("l_quantity").cast(B), "h": F.col("l_partkey") % 30})
    return t.select("l_orderkey", "l_partkey", X.aspect_ratio(F.col("w"), F.col("h"), {(20, 10): "2:1"}).alias("ratio"))


@query("strip_brackets", "SELECT doc_id, regexp_replace(replace(text, ' ', ' ['), '\\[[^\\]]*\\]?|\\([^)]*\\)?', '', 'g') AS plain FROM documents")
def strip_brackets(spark, d):
    t = F.replace("text", F.lit(" "), F.lit(" ["))
    return table(spark, d, "documents").select("doc_id", X.without_brackets(t).alias("plain"))


@query("vtt_escape", "SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages")
def vtt_escape(spark, d):
    return table(spark, d, "pages").select("page_id", X.vtt_escaped(F.col("html")).alias("escaped"))


@query("md5_b64", "SELECT doc_id, base64(unhex(md5(text))) AS digest FROM documents")
def md5_b64(spark, d):
    return table(spark, d, "documents").select("doc_id", X.md5_base64(F.col("text")).alias("digest"))


@query("path_split", "SELECT page_id, string_split(url, '/')[3] AS host, coalesce(string_split(url, '/')[4], '') AS first FROM pages")
def path_split(spark, d):
    p = X.blob_parts(F.col("url"))
    return table(spark, d, "pages").select("page_id", p["type"].alias("host"), F.coalesce(p["id"], F.lit("")).alias("first"))


@query("phase_rank", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END::BIGINT AS rank FROM orders")
def phase_rank(spark, d):
    phase = F.when(F.col("o_orderstatus") == "F", " ").when(F.col("o_orderstatus") == "O", "R").otherwise("P")
    return table(spark, d, "orders").select("o_orderkey", X.phase_rank(phase).cast(B).alias("rank"))


@query("category_tokens", "SELECT p_partkey, list_aggregate(list_distinct([rtrim(trim(x), 's') FOR x IN string_split(p_type || ' | ' || p_brand || 's|' || p_brand, '|')]), 'count')::BIGINT AS n FROM part")
def category_tokens(spark, d):
    return table(spark, d, "part").select("p_partkey", F.size(X.category_tokens(F.concat_ws("|", F.concat("p_type", F.lit(" ")), F.concat(F.lit(" "), "p_brand", F.lit("s")), "p_brand"))).cast(B).alias("n"))


@query("year_decade", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y') END AS year, CASE WHEN o_orderkey % 3 < 2 THEN substr(strftime(o_orderdate, '%Y'), 1, 3) || '0' END AS decade FROM orders""")
def year_decade(spark, d):
    y = F.date_format("o_orderdate", "yyyy")
    t = F.when(F.col("o_orderkey") % 3 == 0, y).when(F.col("o_orderkey") % 3 == 1, F.concat(y, F.lit("s"))).otherwise(F.concat(F.lit("x"), y))
    return table(spark, d, "orders").select("o_orderkey", X.year_and_decade(t).alias("v")).select("o_orderkey", "v.year", "v.decade")


@query("caption_paths", "SELECT page_id, replace(url, 'html', 'vtt') || '.vtt' AS path FROM pages")
def caption_paths(spark, d):
    return table(spark, d, "pages").select("page_id", X.caption_path(F.concat(F.replace("url", F.lit("html"), F.lit("mp4")), F.lit(".mp4"))).alias("path"))


@query("transcript_join", "SELECT conv_id, string_agg(replace(text, '’', ''''), chr(10) || chr(10) ORDER BY turn) AS transcript FROM conversations GROUP BY 1")
def transcript_join(spark, d):
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("a"))
    return g.select("conv_id", X.transcript(F.transform("a", lambda x: x["text"])).alias("transcript"))
