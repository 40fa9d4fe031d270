"""Tagged text, names and entities: sources' rules over texts that are built from the test tables, whose columns tell what has to come out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storyloom.functions import scalar as X
from storyloom.operators import entities as E
from storyloom.operators import state as C
from storyloom.plans.registry import query
from storyloom.sources import tagged_text as T
from storyloom.tables import table

B = "bigint"


def _pick(number: Column, items: tuple[str, ...]) -> Column:
    """One of the items by number."""
    return F.element_at(F.array(*map(F.lit, items)), (F.pmod(number, F.lit(len(items))) + 1).cast("int"))


def _sql_pick(number: str, items: tuple[str, ...]) -> str:
    return "[" + ", ".join("NULL" if x is None else "'" + x.replace("'", "''") + "'" for x in items) + f"][{number} % {len(items)} + 1]"


def _collections(spark, d):
    """Tagged texts of collections, one a customer; the segment has two lines, a blank one between."""
    c = table(spark, d, "customer")
    value = F.concat_ws("\n", F.lit("***CollectionInfo"), F.lit("***Name"), "c_name", F.lit("***Segment"), "c_mktsegment", F.lit(""), F.col("c_nationkey").cast("string"), F.lit("***Balance"), F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")).otherwise(""))
    return T.explode_lines(c.select(F.col("c_custkey").cast("string").alias("path"), value.alias("value")))


@query("tagged_fields", """
SELECT c_custkey::VARCHAR AS path, 'collection' AS kind, t.tag, t.value FROM customer, LATERAL (VALUES ('***COLLECTIONINFO', ''), ('***NAME', c_name), ('***SEGMENT', c_mktsegment || ' ' || c_nationkey), ('***BALANCE', CASE WHEN c_acctbal >= 0 THEN c_custkey::VARCHAR ELSE '' END)) t(tag, value)""")
def tagged_fields(spark, d):
    return T.fields(_collections(spark, d)).select("path", "kind", "tag", "value")


@query("tagged_missing", "SELECT c_custkey::VARCHAR AS path, 'collection' AS kind, '***BALANCE' AS tag FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey::VARCHAR, 'collection', '***REGION' FROM customer")
def tagged_missing(spark, d):
    return T.missing_tags(T.fields(_collections(spark, d)), {"collection": ["***Name", "***Balance", "***Region"], "movie": ["***Path"]}).select("path", "kind", "tag")


@query("tagged_values", """
SELECT c_custkey::VARCHAR AS path, t.tag, t.value FROM customer, LATERAL (VALUES ('***NAME', c_name), ('***SEGMENT', c_mktsegment), ('***SEGMENT', c_nationkey::VARCHAR), ('***BALANCE', CASE WHEN c_acctbal >= 0 THEN c_custkey::VARCHAR END)) t(tag, value) WHERE t.value IS NOT NULL""")
def tagged_values(spark, d):
    return T.values(_collections(spark, d)).select("path", "tag", "value")


def _movies(spark, d):
    """Tagged texts of movies, one an order: a story without an end time and one with, of two paragraphs."""
    o = table(spark, d, "orders")
    minute = F.format_string("00:%02d:", F.pmod("o_orderkey", F.lit(60)))
    first = F.concat_ws("\n", F.lit("***Movie"), F.lit("***Story"), F.concat(minute, F.lit("01:00")), "o_orderstatus", F.lit("***Transcript"), "o_orderpriority", F.lit("more"), F.lit(""), F.col("o_custkey").cast("string"))
    second = F.concat_ws("\n", F.lit("***Story"), F.concat(minute, F.lit("20:00")), F.concat(minute, F.lit("45:00")), F.lit("two"), F.lit("***Transcript"), F.lit("x"), F.lit("***End"))
    return T.explode_lines(o.select(F.col("o_orderkey").cast("string").alias("path"), F.concat_ws("\n", first, second).alias("value")))


@query("tagged_stories", """
SELECT o_orderkey::VARCHAR AS path, 1::BIGINT AS story, format('00:{:02d}:01:00', o_orderkey % 60) AS start, NULL AS "end", o_orderstatus AS title, o_orderpriority || ' more|' || o_custkey AS paragraphs FROM orders
UNION ALL SELECT o_orderkey::VARCHAR, 2, format('00:{:02d}:20:00', o_orderkey % 60), format('00:{:02d}:45:00', o_orderkey % 60), 'two', 'x' FROM orders""")
def tagged_stories(spark, d):
    return T.stories(_movies(spark, d)).select("path", F.col("story").cast(B).alias("story"), "start", "end", "title", F.array_join("paragraphs", "|").alias("paragraphs"))


@query("tagged_default_ends", """
SELECT o_orderkey::VARCHAR AS path, s.story, (o_orderkey % 60 * 60 + s.a) * 30 AS start_frame, (o_orderkey % 60 * 60 + s.b) * 30 + s.c AS end_frame FROM orders, (VALUES (1::BIGINT, 1, 20, -1), (2, 20, 45, 0)) s(story, a, b, c)""")
def tagged_default_ends(spark, d):
    return T.with_default_ends(T.stories(_movies(spark, d))).select("path", F.col("story").cast(B).alias("story"), "start_frame", "end_frame")


@query("unbalanced_brackets", """
WITH l AS (SELECT user_id, event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN -1 ELSE 0 END AS x FROM events),
s AS (SELECT user_id::VARCHAR AS path, event_id AS seq, sum(x) OVER (PARTITION BY user_id ORDER BY event_id) AS depth, event_id = max(event_id) OVER (PARTITION BY user_id) AS at_end FROM l)
SELECT path, seq, depth::BIGINT AS depth FROM s WHERE depth < 0 OR at_end AND depth <> 0""")
def unbalanced_brackets(spark, d):
    e = table(spark, d, "events")
    lines = e.select(F.col("user_id").cast("string").alias("path"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "view", "a [b").when(F.col("event_type") == "click", "a] b").otherwise("[a] b").alias("line"))
    return T.unbalanced_brackets(lines).select("path", "seq", F.col("depth").cast(B).alias("depth"))


@query("assembled_sessions", """
SELECT coalesce(c.k, o.k) AS accession, c.c_name, o.n AS sessions FROM (SELECT c_custkey AS k, c_name FROM customer WHERE c_acctbal >= 0) c FULL JOIN (SELECT o_custkey AS k, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS n FROM orders GROUP BY 1) o ON c.k = o.k""")
def assembled_sessions(spark, d):
    c = table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("accession"), "c_name")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("accession"), "o_orderkey")
    return T.assemble(c, o).select("accession", "c_name", F.when(F.col("sessions").isNotNull(), F.array_join(F.transform("sessions", lambda s: s["o_orderkey"].cast("string")), ",")).alias("sessions"))


@query("movie_paths", "SELECT p_partkey, p_partkey || '/' || p_size || '/' || replace(p_name, ' ', '_') || '.flv' AS path FROM part")
def movie_paths(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", T.movie_path(F.concat_ws(".", "p_partkey", "p_size"), F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".mp4"))).alias("path"))


LAST_WORDS = ("Street", "St.", "Bay", "Blvd.", "Creek", "[Lake", "Hill", "Avenue", "River", "Ocean", "Rd.", "Lane")
GENERAL = (True, True, False, True, False, True, False, True, True, False, False, True)


@query("general_locations", f"SELECT p_partkey, p_name || ' ' || {_sql_pick('p_partkey', LAST_WORDS)} AS name, {list(GENERAL)}[p_partkey % 12 + 1] AS general FROM part")
def general_locations(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", _pick(F.col("p_partkey"), LAST_WORDS)).alias("name"))
    return p.withColumn("general", E.is_general(F.col("name")))


@query("lake_locations", "SELECT p_partkey, p_size >= 25 AS general FROM part")
def lake_locations(spark, d):
    name = F.concat(F.lit("Lake "), "p_name")
    return table(spark, d, "part").select("p_partkey", E.is_general(name, F.when(F.col("p_size") >= 25, F.concat(name, F.lit("[]"))).otherwise(F.concat(name, F.lit(" [shore]")))).alias("general"))


PLACES = ("Seattle", "D.C.", "Oregon", "Spokane, Metro Washington", "District of Columbia", "Washington State")
SIDES = ("WA", "DC", None, "WA", "DC", "WA")


@query("washington_sides", f"SELECT o_orderkey, {_sql_pick('o_orderkey', SIDES)} AS side FROM orders")
def washington_sides(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", E.washington(F.concat_ws(" ", "o_orderpriority", _pick(F.col("o_orderkey"), PLACES), "o_orderstatus")).alias("side"))


STATES = [("PA", "Pennsylvania", ("Penn",)), ("VA", "Virginia", ()), ("WV", "West Virginia", ("W. Va.",)), ("WA", "Washington", ("Wash.",))]
STATE_TEXTS = ("Pennsylvania", "Erie, Penn", "Richmond, Virginia", "West Virginia", "Washington", "near Washington", "PA", "Pennsylvania and West Virginia", "Penny")
STATE_CODES = ("PA", "PA", "VA", "WV", "WA", None, "PA", "WV", None)


@query("looked_up_states", f"SELECT o_orderkey, {_sql_pick('o_orderkey', STATE_CODES)} AS state FROM orders")
def looked_up_states(spark, d):
    return table(spark, d, "orders").select("o_orderkey", E.looked_up_state(_pick(F.col("o_orderkey"), STATE_TEXTS), STATES).alias("state"))


@query("label_kinds", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Person' WHEN 1 THEN 'Loc' WHEN 2 THEN 'Org' WHEN 3 THEN 'YearPerhaps' WHEN 4 THEN 'SomethingElse' END AS spacy, CASE event_id % 4 WHEN 0 THEN 'Person' WHEN 1 THEN 'Loc' WHEN 2 THEN 'Org' END AS stanford FROM events""")
def label_kinds(spark, d):
    n = F.col("event_id")
    spacy, stanford = _pick(n, ("PERSON", "GPE", "ORG", "DATE", "LAW", "ELSE")), _pick(n, ("PERSON", "LOCATION", "ORGANIZATION", "O"))
    return table(spark, d, "events").select("event_id", E.label_kind(spacy, "spacy").alias("spacy"), E.label_kind(stanford, "stanford").alias("stanford"))


@query("token_texts", "SELECT event_id, replace('[' || event_type || ']' || '(' || user_id || ')' || ' x', 'error', 'warning') AS text FROM events")
def token_texts(spark, d):
    raw = F.concat(F.lit("-LSB-"), F.replace("event_type", F.lit("error"), F.lit("warning")), F.lit("-RSB--LRB-"), F.col("user_id").cast("string"), F.lit("-RRB- x"))
    return table(spark, d, "events").select("event_id", E.token_text(raw).alias("text"))


@query("trimmed_names", "SELECT p_partkey, p_name AS name FROM part")
def trimmed_names(spark, d):
    p = table(spark, d, "part")
    raw = F.concat(_pick(F.col("p_partkey"), ("the City of ", "[", "", ", ")), "p_name", _pick(F.col("p_partkey"), ("", "]", "'s", ",")))
    return p.select("p_partkey", E.trimmed_name(raw).alias("name"))


ORGANIZATIONS = ("U.S. Steel", "The Forum", "UC Davis", "Duke University", "Boston hockey team", "Acme [Corp]", "Plain")
ATTEMPTS = ("U.S. Steel|U.S. Steel|United States Steel", "The Forum|The Forum|Forum", "UC Davis|UC Davis|University of California, Davis", "Duke University|Duke University|University of Duke", "Boston hockey team|Boston hockey team|Boston (Hockey team)", "Acme [Corp|Acme|Corp", "Plain|Plain")


@query("organization_attempts", f"SELECT o_orderkey, {_sql_pick('o_orderkey', ATTEMPTS)} AS attempts FROM orders")
def organization_attempts(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.array_join(E.organization_attempts(_pick(F.col("o_orderkey"), ORGANIZATIONS)), "|").alias("attempts"))


@query("resolved_organizations", """
SELECT o_custkey AS segment_id, CASE o_orderstatus WHEN 'F' THEN 10 WHEN 'O' THEN 20 END::BIGINT AS org_id, count(*) AS n, CASE WHEN count(*) >= 2 THEN 2 ELSE 1 END::BIGINT AS confidence FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
def resolved_organizations(spark, d):
    """Organization mentions of a segment, one an order; two names are known, one in full only, the third isn't."""
    name = F.when(F.col("o_orderstatus") == "F", "U.S. Steel").when(F.col("o_orderstatus") == "O", "The Forum").otherwise("Nobody Inc")
    e = table(spark, d, "orders").select(F.col("o_custkey").alias("segment_id"), F.col("o_orderkey").alias("start"), F.lit("Org").alias("kind"), name.alias("text"), F.lit(1).alias("confidence"))
    names = spark.createDataFrame([("United States Steel", 10), ("Forum", 20), ("Forum Romanum", 30)], "name string, org_id long")
    out = E.resolve_organizations(e, names.limit(0), names)
    return out.select("segment_id", F.col("org_id").cast(B).alias("org_id"), "n", F.col("confidence").cast(B).alias("confidence"))


@query("resolved_places", """
SELECT o_custkey AS segment_id, 'WI' AS state, 1::BIGINT AS place_id, count(*) AS n, CASE WHEN count(*) > 3 THEN 2 ELSE 1 END::BIGINT AS confidence FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
UNION ALL SELECT o_custkey, 'NY', 2, count(*), CASE WHEN count(*) > 3 THEN 2 ELSE 1 END FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""")
def resolved_places(spark, d):
    """Place mentions of a segment, one an order, far from each other; streets don't count."""
    name = F.when(F.col("o_orderstatus") == "F", "Green Bay, Wisconsin").when(F.col("o_orderstatus") == "O", "Mount Vernon, New York").otherwise("Forbes Avenue, Wisconsin")
    e = table(spark, d, "orders").select(F.col("o_custkey").alias("segment_id"), (F.col("o_orderkey") * 100).alias("start"), (F.col("o_orderkey") * 100 + 20).alias("end"), F.lit("Loc").alias("kind"), name.alias("text"), F.lit(1).alias("confidence"))
    places = spark.createDataFrame([("WI", "Green Bay", 1), ("NY", "Mount Vernon", 2)], "state string, name string, place_id long")
    hints = spark.createDataFrame([], "name string, state string, place_id long")
    out, _ = E.resolve_places(e, [("WI", "Wisconsin", ()), ("NY", "New York", ())], hints, places)
    return out.select("segment_id", "state", F.col("place_id").cast(B).alias("place_id"), "n", F.col("confidence").cast(B).alias("confidence"))


@query("resolved_dates", "SELECT o_orderkey AS segment_id, strftime(o_orderdate, '%Y') || CASE WHEN o_orderstatus = 'F' THEN 's' ELSE '' END AS value, 1::BIGINT AS n FROM orders")
def resolved_dates(spark, d):
    said = F.concat(F.lit("It was in "), F.year("o_orderdate").cast("string"), F.when(F.col("o_orderstatus") == "F", "s").otherwise(""), F.lit(" that order $1500 went 1,200 miles, to 1900 Forbes Avenue."))
    s = table(spark, d, "orders").select(F.col("o_orderkey").alias("segment_id"), said.alias("transcript"))
    return E.resolve_dates(s, 2020).select("segment_id", "value", F.col("n").cast(B).alias("n"))


@query("emitted_entities", """
SELECT DISTINCT o_custkey AS segment_id, 'Year' AS type, strftime(o_orderdate, '%Y') AS value FROM orders UNION SELECT o_custkey, 'Decade', substr(strftime(o_orderdate, '%Y'), 1, 3) || '0' FROM orders
UNION SELECT o_custkey, 'Organization', o_orderkey::VARCHAR FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey, 'USState', 'PA-' || o_orderkey FROM orders WHERE o_orderstatus = 'O' UNION SELECT o_custkey, 'Country', '7-' || o_orderkey FROM orders WHERE o_orderstatus = 'P'""")
def emitted_entities(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("segment_id"), "o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("string").alias("value"))
    one = lambda status, *c: o.where(F.col("o_orderstatus") == status).select("segment_id", *c)
    return E.emitted(o, one("F", F.col("o_orderkey").alias("org_id")), one("O", F.lit("PA").alias("state"), F.col("o_orderkey").alias("place_id")), one("P", F.lit(7).alias("country_id"), F.col("o_orderkey").alias("city_id")))


@query("first_prefixes", "SELECT p_partkey, CASE WHEN p_size >= 25 THEN '***STORYTIME' ELSE '***STORY' END AS tag FROM part")
def first_prefixes(spark, d):
    line = F.concat(F.when(F.col("p_size") >= 25, "***STORYTIME").otherwise("***STORY T"), F.lit(" "), "p_name")
    return table(spark, d, "part").select("p_partkey", X.first_prefix(line, ["***STORY", "***STORYTIME", "***END"]).alias("tag"))


@query("vocabulary_matches", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Building & Land' WHEN 'MACHINERY' THEN 'Machinery, Tools' END AS word FROM customer")
def vocabulary_matches(spark, d):
    said = F.when(F.col("c_mktsegment") == "BUILDING", "building and la").when(F.col("c_mktsegment") == "MACHINERY", " machinery tools").otherwise(F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", X.vocabulary_match(said, ["Arts", "Building & Land", "Machinery, Tools"]).alias("word"))


@query("locks_taken", """
WITH l AS (SELECT o_orderkey AS s, o_custkey AS p FROM orders WHERE o_orderstatus = 'P'), locks AS (SELECT min(s) AS s, p FROM l GROUP BY p),
w AS (SELECT DISTINCT doc_id AS s, doc_id % 40 AS p FROM documents WHERE doc_id NOT IN (SELECT s FROM locks) AND doc_id % 40 NOT IN (SELECT p FROM locks))
SELECT s AS segment_id, p AS pid, 'a' AS host FROM locks UNION ALL SELECT min(s), p, 'a' FROM w GROUP BY p""")
def locks_taken(spark, d):
    """Locks of sessions in process, and what further processes get of the segments that they ask for."""
    held = table(spark, d, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("pid")).agg(F.min("o_orderkey").alias("segment_id")).withColumn("host", F.lit("a"))
    wanted = table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), F.pmod("doc_id", F.lit(40)).alias("pid"), F.lit("a").alias("host"))
    return C.acquire(held.select("segment_id", "pid", "host"), wanted).select("segment_id", "pid", "host")


@query("locks_released", "SELECT c_custkey AS segment_id FROM customer WHERE c_acctbal < 0")
def locks_released(spark, d):
    locks = table(spark, d, "customer").select(F.col("c_custkey").alias("segment_id"), F.col("c_nationkey").alias("pid"), F.lit("a").alias("host"), "c_acctbal")
    return C.release(locks.drop("c_acctbal"), locks.where("c_acctbal >= 0").drop("c_acctbal")).select("segment_id")
