"""Published documents: nested biographies and stories, and their flat search forms, each in one joined plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions import scalar as X


def nested(parents: DataFrame, children: DataFrame, key: str, order: list[str], alias: str) -> DataFrame:
    """Parents with their children in an array of structs, sorted by the order columns (which lead each struct)."""
    rest = [c for c in children.columns if c not in (key, *order)]
    grouped = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(alias))
    kind = grouped.schema[alias].dataType
    return parents.join(grouped, key, "left").withColumn(alias, F.coalesce(alias, F.array().cast(kind)))


def chosen_sessions(sessions: DataFrame, explicit: DataFrame, phases: list[str]) -> DataFrame:
    """Sessions named explicitly and those of an allowed phase, each once."""
    return sessions.join(explicit, "session_id", "left_semi").union(sessions.where(F.col("phase").isin(phases))).distinct()


def facet_ids(annotations: DataFrame, key: str, kind: str, alias: str) -> DataFrame:
    """Values of one annotation type that are integers, in an array."""
    ids = annotations.where(F.col("type") == kind).withColumn("v", F.col("value").try_cast("int")).where("v is not null")
    return ids.groupBy(key).agg(F.sort_array(F.collect_set("v")).alias(alias))


def tags(annotations: DataFrame, key: str) -> DataFrame:
    return annotations.where("type = 'Tag'").groupBy(key).agg(F.sort_array(F.collect_set(X.tag_code(F.col("value")))).alias("tags"))


def story_details(segments: DataFrame, movies: DataFrame, sessions: DataFrame, collections: DataFrame, annotations: DataFrame, timing: DataFrame | None = None) -> DataFrame:
    """One nested document a segment, with where it lies, its transcript, size and tags."""
    d = segments.join(movies, "movie_id").join(sessions, "session_id").join(collections, "collection_id").join(tags(annotations, "segment_id"), "segment_id", "left")
    if timing is not None:
        d = d.join(timing, "segment_id", "left")
    cols: list[Column | str] = [
        F.col("segment_id").alias("story_id"), "collection_id", "accession", "session_order", "interview_date", "tape", "segment_order", "title", "transcript", "start_time",
        F.coalesce("duration", F.lit(-1)).alias("duration"), X.aspect_ratio(F.col("width"), F.col("height")).alias("aspect_ratio"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
    ]
    return d.select(*cols, *(["sync"] if timing is not None else []))


def biography_details(collections: DataFrame, sessions: DataFrame, movies: DataFrame, segments: DataFrame, favorites: DataFrame | None = None) -> DataFrame:
    """One nested document a collection: sessions with tapes with stories, all in order; without sessions it has none."""
    tapes = nested(movies.select("session_id", "movie_id", "tape"), segments.select("movie_id", "segment_order", F.col("segment_id").alias("story_id"), "title", F.coalesce("duration", F.lit(0)).alias("duration")), "movie_id", ["segment_order"], "stories")
    whole = nested(sessions.select("collection_id", "session_id", "session_order", "interview_date", "interviewer", "location"), tapes.drop("movie_id"), "session_id", ["tape"], "tapes")
    d = nested(collections, whole, "collection_id", ["session_order"], "sessions")
    d = d.withColumns({"birth_year": F.year("birth_date"), "birth_month": F.month("birth_date"), "birth_day": F.dayofmonth("birth_date"), "last_initial": X.initial(F.col("last_name"))})
    return d.join(favorites, "collection_id", "left") if favorites is not None else d


def story_search(stories: DataFrame, entities: DataFrame) -> DataFrame:
    """Flat search documents with a facet array for each entity type."""
    types = {"Year": "entity_years", "Decade": "entity_decades", "Organization": "entity_organizations", "USState": "entity_states", "Country": "entity_countries"}
    wide = entities.groupBy(F.col("segment_id").alias("story_id")).agg(*(F.sort_array(F.collect_set(F.when(F.col("type") == t, F.col("value")))).alias(a) for t, a in types.items()))
    none = F.array().cast("array<string>")
    return stories.join(wide, "story_id", "left").withColumns({a: F.coalesce(a, none) for a in types.values()})


def story_ids(biographies: DataFrame) -> DataFrame:
    """Ids of all stories of nested documents."""
    return biographies.select("collection_id", F.explode("sessions").alias("s")).select("collection_id", F.explode("s.tapes").alias("t")).select("collection_id", F.explode("t.stories").alias("x")).select("collection_id", "x.story_id")
