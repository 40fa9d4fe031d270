"""Named entities: recognizer output is merged, dates, organizations and places are resolved against gazetteers, and values
are given out. Everything but the year miner's text walk is joins and windows within a segment."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.config import EntityLimits
from storyloom.operators import joins as J
from storyloom.operators.aggregates import boosted

#: Recognizer labels to entity kinds; fixed values.
SPACY_KINDS = {
    "PERSON": "Person", "NORP": "SomethingElse", "FAC": "Loc", "ORG": "Org", "GPE": "Loc", "LOC": "Loc", "PRODUCT": "SomethingElse", "EVENT": "SomethingElse", "WORK_OF_ART": "SomethingElse",
    "LAW": "SomethingElse", "LANGUAGE": "SomethingElse", "DATE": "YearPerhaps", "TIME": "SomethingElse", "PERCENT": "SomethingElse", "MONEY": "SomethingElse", "QUANTITY": "SomethingElse",
    "ORDINAL": "SomethingElse", "CARDINAL": "YearPerhaps",
}
STANFORD_KINDS = {"PERSON": "Person", "LOCATION": "Loc", "ORGANIZATION": "Org"}
#: Last words that make a name a street or a water rather than a place to live; fixed values.
GENERAL_LAST = ("Avenue", "Ave", "Boulevard", "Blvd", "Street", "St", "Road", "Lane", "Lake", "River")


def _map(kinds: dict[str, str], label: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv)), label)


def label_kind(label: Column, recognizer: str) -> Column:
    """Kind of a label; NULL for one that isn't known."""
    return _map(SPACY_KINDS if recognizer == "spacy" else STANFORD_KINDS, label)


def token_text(token: Column) -> Column:
    """A tokenizer's stand-ins turned back: brackets, quotes; anything outside ASCII is a space."""
    pairs = (("-LRB-", "("), ("-RRB-", ")"), ("-LSB-", "["), ("-RSB-", "]"), ("-LCB-", "{"), ("-RCB-", "}"), ("``", '"'), ("''", '"'))
    return F.regexp_replace(reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, token), "[^\\x00-\\x7F]", " ")


def grouped_tokens(tokens: DataFrame) -> DataFrame:
    """tokens (segment_id, seq, token, label) -> (segment_id, first_seq, kind, text): neighbours of one kind are one entity. A
    bracketed stretch that touches an entity counts to it; an entity's last kind counts."""
    w = Window.partitionBy("segment_id").orderBy("seq")
    t = tokens.withColumns({"text": token_text(F.col("token")), "kind": label_kind(F.col("label"), "stanford")})
    depth = F.sum(F.when(F.col("text") == "[", 1).otherwise(0)).over(w) - F.sum(F.when(F.lag("text").over(w) == "]", 1).otherwise(0)).over(w)
    t = t.withColumn("_in", depth > 0)
    t = t.withColumn("_b", F.sum((F.col("text") == "[").cast("int")).over(w))
    inside = Window.partitionBy("segment_id", "_in", "_b")
    t = t.withColumn("kind", F.when(F.col("_in"), F.last("kind", ignorenulls=True).over(inside.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).otherwise(F.col("kind")))
    t = t.withColumn("_new", (~F.col("kind").eqNullSafe(F.lag("kind").over(w))).cast("int")).withColumn("_g", F.sum("_new").over(w)).where("kind is not null")
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ")
    out = t.groupBy("segment_id", "_g").agg(F.min("seq").alias("first_seq"), F.max("kind").alias("kind"), texts.alias("text"))
    return out.withColumn("text", F.regexp_replace(F.regexp_replace("text", "\\[ ", "["), " \\]", "]")).drop("_g")


def merged(second: DataFrame, spacy: DataFrame) -> DataFrame:
    """Third pass. second (segment_id, seq, start, end, kind, text) and spacy (segment_id, seq, start, end, kind, text, good) ->
    segment_id, start, end, kind, text, context, confidence.

    Each spaCy row meets the first entity of the second pass that ends behind its start. Alone, or with the other wholly
    behind it, it has confidence 1; overlapping one of another kind 2, with its text as context; of the same kind 3 where one
    holds the other, with the tighter name, else 2 with the longer. Entities that no row of their kind met are given with 1 if
    a later row starts at or behind their end. From a row whose text isn't at its offset on, a segment's rows don't count."""
    w = Window.partitionBy("segment_id").orderBy("seq")
    rows = spacy.withColumn("_bad", F.max((~F.col("good")).cast("int")).over(w)).where("_bad = 0").drop("_bad", "good")
    s2 = second.select("segment_id", *(F.col(c).alias(f"p_{c}") for c in ("seq", "start", "end", "kind", "text")))
    met = rows.join(s2, "segment_id", "left").where("p_end > start or p_end is null")
    rest = [c for c in rows.columns if c not in ("segment_id", "seq")]
    first = met.groupBy("segment_id", "seq").agg(F.min_by(F.struct(*rest, "p_seq", "p_start", "p_end", "p_kind", "p_text"), "p_seq").alias("m"))
    lone = rows.join(first.select("segment_id", "seq"), ["segment_id", "seq"], "left_anti").select("segment_id", "seq", *rest, *(F.lit(None).cast(met.schema[c].dataType).alias(c) for c in ("p_seq", "p_start", "p_end", "p_kind", "p_text")))
    m = first.select("segment_id", "seq", "m.*").unionByName(lone)
    overlap = F.col("p_seq").isNotNull() & (F.col("p_start") < F.col("end"))
    same = overlap & (F.col("kind") == F.col("p_kind"))
    in_p, in_row = (F.col("p_start") <= F.col("start")) & (F.col("end") <= F.col("p_end")), (F.col("start") <= F.col("p_start")) & (F.col("p_end") <= F.col("end"))
    held = in_p | in_row
    longer = F.length("p_text") > F.length("text")
    own = m.select(
        "segment_id", F.when(same & ~in_p & in_row, F.col("p_start")).otherwise(F.col("start")).alias("start"), F.when(same & ~in_p & in_row, F.col("p_end")).otherwise(F.col("end")).alias("end"), "kind",
        F.when(same & ~in_p & (in_row | longer), F.col("p_text")).otherwise(F.col("text")).alias("text"), F.when(overlap, F.col("p_text")).otherwise(F.col("text")).alias("context"),
        F.when(same & held, 3).when(overlap, 2).otherwise(1).alias("confidence"),
    )
    matched = m.where(same).select("segment_id", F.col("p_seq").alias("seq")).distinct()
    last = rows.groupBy("segment_id").agg(F.max("start").alias("_last"))
    left = second.join(matched, ["segment_id", "seq"], "left_anti").join(last, "segment_id").where(F.col("end") <= F.col("_last"))
    return own.where("kind <> 'SomethingElse'").unionByName(left.select("segment_id", "start", "end", "kind", "text", F.col("text").alias("context"), F.lit(1).alias("confidence")))

#: What in a context makes Washington the capital, and what the state; fixed values.
CAPITAL_HINTS = ("d.c.", "district of columbia", "metro washington", "metro [washington")
STATE_HINTS = (
    "king county", "seattle", "spokane", "yakima", "tacoma", "pasco", "fort lewis", "mcchord", "fairchild air force base", "kitsap", "state of washington", "washington state",
)


def washington(context: Column) -> Column:
    """DC or WA by what the context names, the state before the capital; NULL if it tells neither."""
    low = F.lower(context)
    names = lambda hints: reduce(Column.__or__, (F.contains(low, F.lit(h)) for h in hints))
    return F.when(names(STATE_HINTS), "WA").when(names(CAPITAL_HINTS), "DC")


def trimmed_name(name: Column) -> Column:
    """Without brackets and commas at the ends, a possessive, or 'the city of'."""
    n = F.btrim(F.regexp_replace(name, "^[\\[\\]\\s,]+|[\\[\\]\\s,]+$", ""))
    n = F.regexp_replace(n, "['’]s?$", "")
    return F.regexp_replace(n, "^(?i:the (city|town|state|village) of )", "")


def is_general(name: Column, context: Column | None = None) -> Column:
    """Streets and waters, which aren't places to resolve: by the last word, behind a space or bracket and without a dot at its
    end; a name that begins with Lake unless the context says more than the name."""
    last = F.regexp_extract(F.regexp_replace(F.trim(name), "\\.$", ""), "([^\\[ ]*)$", 1)
    said = F.trim(F.regexp_replace(name if context is None else context, "[\\[\\]]", ""))
    alone = F.startswith(name, F.lit("Lake ")) & F.startswith(said, F.lit("Lake ")) & (F.length(said) <= F.length(name))
    return last.isin(*GENERAL_LAST) | alone


def organization_attempts(name: Column) -> Column:
    """Ranked candidate names: as it is; what stands in brackets, and before them; with 'University' and 'College' forms; 'U.S.'
    in full, or without 'the'; a team's sport in parentheses. Of the rewrites only the first that applies is tried."""
    n = trimmed_name(name)
    outside, inside = F.trim(F.regexp_replace(n, "\\[[^\\]]*\\]?", "")), F.regexp_extract(n, "\\[([^\\]]*)", 1)
    rewrite = (
        F.when(F.startswith(n, F.lit("U.S.")), F.regexp_replace(n, "^U\\.S\\.", "United States"))
        .when(F.startswith(n, F.lit("UC ")), F.concat(F.lit("University of California, "), F.substring(n, 4, 200)))
        .when(F.startswith(F.lower(n), F.lit("the ")), F.substring(n, 5, 400))
        .when(n.rlike(" (football|basketball|baseball|hockey) team$"), F.regexp_replace(F.regexp_replace(n, " (football|basketball|baseball|hockey) team$", " ($1 team)"), "\\(f", "(F"))
        .when(n.rlike(" (University|College)$"), F.regexp_replace(n, "^(.*) (University|College)$", "$2 of $1"))
    )
    team = F.regexp_replace(F.regexp_replace(F.regexp_replace(rewrite, "\\(basketball", "(Basketball"), "\\(baseball", "(Baseball"), "\\(hockey", "(Hockey")
    return F.filter(F.array(n, outside, F.trim(inside), team), lambda x: x.isNotNull() & (x != ""))


def resolve_organizations(entities: DataFrame, synonyms: DataFrame, authority: DataFrame) -> DataFrame:
    """entities (segment_id, start, kind, text, confidence) -> (segment_id, org_id, n, confidence). synonyms (name, org_id) come
    before authority (name, org_id) at each attempt. A segment in which one text has two ids loses all its organizations. Unresolved mentions
    take the id of a resolved one of the same text."""
    orgs = entities.where("kind = 'Org'").withColumn("mention", F.struct("segment_id", "start"))
    tried = orgs.select("segment_id", "start", "text", "confidence", F.posexplode(organization_attempts(F.col("text"))).alias("rank", "name"))
    table = J.first_wins(synonyms.withColumn("o", F.lit(0)).unionByName(authority.withColumn("o", F.lit(1))), "name", "o").drop("o")
    hits = J.ranked_lookup(tried, table, ["segment_id", "start"], "name", "rank", "org_id").drop("name")
    named = orgs.drop("mention").join(hits, ["segment_id", "start"], "left")
    torn = named.groupBy("segment_id", "text").agg(F.countDistinct("org_id").alias("ids")).where("ids > 1").select("segment_id").distinct()
    named = J.propagate(named, ["segment_id", "text"], "start", "org_id").join(torn, "segment_id", "left_anti")
    out = named.where("org_id is not null").groupBy("segment_id", "org_id").agg(F.count("*").alias("n"), F.max("confidence").alias("confidence"))
    return out.withColumn("confidence", boosted(F.col("confidence"), F.col("n"), 1))


def looked_up_state(name: Column, states: list[tuple[str, str, tuple[str, ...]]]) -> Column:
    """Postal code of the state that a text names: (code, name, variants). A bare name must be equal; in longer texts the last
    listed state found counts; Virginia isn't found in West Virginia, and Washington only stands for itself."""
    n, out = F.trim(name), F.lit(None).cast("string")
    for code, full, variants in states:
        found = F.lit(False)
        for v in (full, *variants):
            whole = n == v
            within = n.rlike(rf"(^|\W){re.escape(v)}(\W|$)") if v != "Washington" else F.lit(False)
            if v == "Virginia":
                within = within & ~F.contains(n, F.lit("West Virginia"))
            found = found | whole | within
        out = F.when(found, code).otherwise(out)
    for code, full, _ in states:
        out = F.when((n == code) | (n == full), code).otherwise(out)
    return out


def resolve_places(entities: DataFrame, states: list[tuple[str, str, tuple[str, ...]]], hints: DataFrame, places: DataFrame, limits: EntityLimits = EntityLimits()) -> tuple[DataFrame, DataFrame]:
    """(resolved, unresolved). resolved: segment_id, state, place_id (NULL for a state alone), n, confidence. The state of a place
    is named in its own text (behind a comma or in brackets), by the next mention close behind, or by the hints (name, state,
    place_id) of well-known cities; places (state, name, place_id) then know it. Streets and waters aren't looked up."""
    w = Window.partitionBy("segment_id").orderBy("start")
    d = entities.where("kind = 'Loc'").withColumn("name", trimmed_name(F.col("text")))
    d = d.withColumns({"own": looked_up_state(F.col("name"), states), "head": F.trim(F.regexp_extract("name", "^([^,\\[]+)", 1)), "tail": F.trim(F.regexp_extract("name", "[,\\[](.*)$", 1))})
    near = F.lead("start").over(w) - F.col("end") <= limits.adjacency_chars
    d = d.withColumns({"behind": F.coalesce(F.when(F.col("tail") != "", looked_up_state(F.col("tail"), states)), F.when(near, F.lead("own").over(w))), "whole": F.col("own").isNotNull() & (F.col("tail") == "")})
    general = is_general(F.col("head"), F.col("name"))
    rows = d.where(~general).select("segment_id", "start", "text", "confidence", "head", "own", "whole", F.when(~F.col("whole"), F.col("behind")).alias("state"))
    p = places.select(F.col("state"), F.col("name").alias("head"), F.col("place_id").alias("by_state"))
    h = hints.select(F.col("name").alias("head"), F.col("state").alias("h_state"), F.col("place_id").alias("by_hint"))
    met = rows.join(J.first_wins(p.withColumn("o", F.col("by_state")), ["state", "head"], "o").drop("o"), ["state", "head"], "left").join(h, "head", "left")
    met = met.withColumns({
        "state": F.when(F.col("whole"), F.col("own")).when(F.col("by_state").isNotNull(), F.col("state")).when(F.col("state").isNull() | (F.col("state") == F.col("h_state")), F.col("h_state")),
        "place_id": F.when(F.col("by_state").isNotNull(), F.col("by_state")).when(~F.col("whole") & (F.col("state").isNull() | (F.col("state") == F.col("h_state"))), F.col("by_hint")),
    })
    met = J.propagate(met, ["segment_id", "text"], "start", "place_id")
    met = J.propagate(met, ["segment_id", "text"], "start", "state")
    out = met.where("state is not null").groupBy("segment_id", "state", "place_id").agg(F.count("*").alias("n"), F.max("confidence").alias("confidence"))
    return out.withColumn("confidence", boosted(F.col("confidence"), F.col("n"), 3)), met.where("state is null").select("segment_id", "start", "text", "head", "confidence").join(d.select("segment_id", "start", "end", "tail"), ["segment_id", "start"])


def resolve_world(unresolved: DataFrame, countries: DataFrame, hints: DataFrame, cities: DataFrame, all_matches: bool = True) -> DataFrame:
    """segment_id, country_id, city_id, n, confidence. A text is a country (country_id, name), a hinted city (name, city_id,
    country_id), or a city (name, country_id, city_id) whose country stands behind it, or that is the only one of its name.
    all_matches: countries without a city count each; else only a segment's first of them."""
    u = unresolved.withColumn("n_tail", F.trim(F.regexp_replace("tail", "\\]$", "")))
    c = countries.select(F.col("name").alias("head"), F.col("country_id").alias("as_country"))
    t = countries.select(F.col("name").alias("n_tail"), F.col("country_id").alias("tail_country"))
    h = J.first_wins(hints.withColumn("o", F.col("city_id")), "name", "o").select(F.col("name").alias("head"), F.col("city_id").alias("h_city"), F.col("country_id").alias("h_country"))
    several = cities.groupBy("name").agg(F.collect_list(F.struct("country_id", "city_id")).alias("c")).withColumnRenamed("name", "head")
    d = u.join(c, "head", "left").join(t, "n_tail", "left").join(h, "head", "left").join(several, "head", "left")
    there = F.get(F.filter("c", lambda x: x["country_id"] == F.col("tail_country")), F.lit(0))
    only = F.when((F.size("c") == 1) & (F.col("n_tail") == ""), F.get("c", F.lit(0)))
    d = d.withColumn("hit", F.coalesce(F.when(F.col("as_country").isNotNull() & (F.col("n_tail") == ""), F.struct(F.col("as_country").alias("country_id"), F.lit(None).cast(cities.schema["city_id"].dataType).alias("city_id"))), there, F.when(F.col("h_city").isNotNull() & (F.col("tail_country").isNull() | (F.col("tail_country") == F.col("h_country"))), F.struct(F.col("h_country").alias("country_id"), F.col("h_city").alias("city_id"))), only))
    d = d.where("hit is not null").select("segment_id", "start", "hit.*", "confidence")
    if not all_matches:
        w = Window.partitionBy("segment_id").orderBy("start")
        first = F.first(F.when(F.col("city_id").isNull(), F.col("country_id")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        d = d.withColumn("_f", first).where("city_id is not null or country_id = _f").drop("_f")
    out = d.groupBy("segment_id", "country_id", "city_id").agg(F.count("*").alias("n"), F.max("confidence").alias("confidence"))
    return out.withColumn("confidence", boosted(F.col("confidence"), F.col("n"), 3))


_FULL = re.compile(r"(?<![\d$#.,:/'’-])([12]\d{3})(s?)(?![\d:%/]|[.,]\d|['’]?\s*(?:dollars|miles|people|feet|percent))")
_SHORT = re.compile(r"(?<!\w)['’](\d\d)(s?)(?!\w|['’]|\")")
_STREET = re.compile(r"\s+(?:(?:North|South|East|West|N\.|S\.|E\.|W\.)\s+)?(?:[A-Z][\w.]*\s+){0,2}(?:Street|St\.|Avenue|Ave\.|Road|Rd\.|Boulevard|Blvd\.|Drive|Dr\.|Lane|Place)(?!\s*[A-Z])|\s+(?:North|South|East|West)\s+[A-Z]\w+")


def years_in(text: str, this_year: int, limits: EntityLimits = EntityLimits()) -> list[tuple[int, str, int]]:
    """(offset, value, confidence) of the years and decades that a text names. Four digits are believed from first_year to
    last_year, and more so from first_strong_year on up to this year; not before a street name, and not as a part of other
    numbers. Two digits behind an apostrophe count if the year in full stands close behind, in brackets or not; the two
    mentions confirm each other and are one."""
    found, taken = [], set()
    full = [m for m in _FULL.finditer(text) if limits.first_year <= int(m[1]) <= limits.last_year and not _STREET.match(text, m.end())]
    for m in _SHORT.finditer(text):
        for f in full:
            if 0 <= f.start() - m.end() <= 40 and f[1][2:] == m[1] and f.start() not in taken and text[m.end() : f.start()].strip(" ,.[(").replace("you know", "").strip(" ,") == "":
                found.append((m.start(), f[1] + f[2], 4))
                taken.add(f.start())
                break
    for f in full:
        if f.start() not in taken:
            strong = limits.first_strong_year <= int(f[1]) <= this_year
            lead = re.search(r"(?:\bin|\bsince|\buntil|\bof|\bby|\bfrom|\byear|\[)\s*(?:the\s+)?$", text[: f.start()])
            found.append((f.start(), f[1] + f[2], (2 if strong else 1) + bool(lead)))
    return sorted(found)


def resolve_dates(segments: DataFrame, this_year: int, limits: EntityLimits = EntityLimits()) -> DataFrame:
    """segments (segment_id, transcript) -> segment_id, value (1929 or 1920s), n, confidence. The rules look back and forth in
    the text, so they run in Python, in Arrow batches."""

    @F.pandas_udf("array<struct<value:string,confidence:int>>")
    def mined(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [{"value": v, "confidence": c} for _, v, c in years_in(t or "", this_year, limits)])

    d = segments.select("segment_id", F.explode(mined("transcript")).alias("y")).select("segment_id", "y.*")
    out = d.groupBy("segment_id", "value").agg(F.count("*").alias("n"), F.max("confidence").alias("confidence"))
    return out.withColumn("confidence", boosted(F.col("confidence"), F.col("n"), 1, limits.date_confidence_max))


def emitted(dates: DataFrame, organizations: DataFrame, places: DataFrame, world: DataFrame, limits: EntityLimits = EntityLimits()) -> DataFrame:
    """(segment_id, type, value), a set: years and decades, organizations, states and countries; values that are too long for
    their column don't go in."""
    from storyloom.functions.scalar import year_and_decade

    y = dates.select("segment_id", year_and_decade(F.col("value")).alias("y"))
    parts = [
        y.select("segment_id", F.lit("Year").alias("type"), F.col("y.year").alias("value")), y.select("segment_id", F.lit("Decade"), F.col("y.decade")),
        organizations.select("segment_id", F.lit("Organization"), F.col("org_id").cast("string")), places.select("segment_id", F.lit("USState"), F.concat_ws("-", "state", F.col("place_id").cast("string"))),
        world.select("segment_id", F.lit("Country"), F.concat_ws("-", F.col("country_id").cast("string"), F.col("city_id").cast("string"))),
    ]
    return reduce(DataFrame.union, parts).where(F.col("value").isNotNull() & (F.length("value") <= limits.value_chars)).distinct()
