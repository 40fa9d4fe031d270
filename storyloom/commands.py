"""The archive's tools, each as one function over its tables: what a command line or a scheduler calls.

Tables are a dict of name -> DataFrame; a command gives the tables that it changes, for the caller to write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import scalar as X
from storyloom.operators import aggregates, captions, documents, entities, joins, lookups, mutations, sequences, state
from storyloom.sources import sinks, xml

Tables = dict[str, DataFrame]


def import_movies(spark: SparkSession, path: str, tables: Tables) -> Tables:
    """Movies of XML files whose collection and session are known and whose name is new, with their segments up to the first
    that doesn't fit its movie, linked through the collection."""
    movies = xml.read(spark, path, "XmlMovie").withColumn("movie_name", F.regexp_replace(F.element_at(F.split("Path", "/"), -1), r"\.[^.]*$", ""))
    known = tables["collections"].select("collection_id", F.lower("accession").alias("_a"))
    sessions = tables["sessions"].select("session_id", "collection_id", "session_order")
    m = movies.join(known, F.lower("Collection") == F.col("_a")).join(sessions.withColumnRenamed("session_order", "SessionOrder"), ["collection_id", "SessionOrder"])
    m = m.join(tables["movies"].select("movie_name"), "movie_name", "left_anti").join(tables["probes"].select("movie_name", "duration"), "movie_name")
    rows = m.select("collection_id", "session_id", "movie_name", F.col("SessionOrder").alias("session_order"), F.col("Tape").alias("tape"), "duration", F.posexplode("Segments.Segment").alias("n", "s"))
    to_end = F.col("s.TimeFormat") == "HMS-END"
    end, valid = lookups.bounded_segment(F.col("s.StartTime"), F.col("s.EndTime"), F.col("duration"), F.coalesce(to_end, F.lit(False)))
    seg = rows.select("collection_id", "session_id", "session_order", "movie_name", "tape", "n", F.col("s.Title").alias("title"), F.col("s.StartTime").alias("start_time"), end.alias("end_time"), F.coalesce(valid, F.lit(False)).alias("valid"), X.transcript(F.col("s.Transcript.Paragraph")).alias("transcript"))
    seg = sequences.ordinal_names(sequences.take_while_valid(seg, "movie_name", "n", F.col("valid")), "movie_name", ["n"], "movie_name")
    seg = sequences.linked(seg, "collection_id", ["session_order", "tape", "movie_name", "ordinal"], "ordinal").drop("valid")
    return {"movies": m.select("collection_id", "session_id", "movie_name", F.col("Tape").alias("tape"), "duration"), "segments": seg.withColumnRenamed("ordinal_name", "segment_name")}


def export_collections(tables: Tables, path: str) -> None:
    """XML of every collection with its sessions."""
    s = tables["sessions"].groupBy("collection_id").agg(F.array_sort(F.collect_list(F.struct(F.col("session_order").alias("SessionOrder"), F.col("interview_date").cast("string").alias("InterviewDate")))).alias("Session"))
    c = tables["collections"].join(s, "collection_id", "left").select(F.col("accession").alias("Accession"), F.col("last_name").alias("LastName"), F.struct("Session").alias("Sessions"))
    xml.write(c, path, "XmlCollection")


def update_collections(tables: Tables, sheet: DataFrame) -> Tables:
    """Categories of a spreadsheet (Accession, Categories with bars) replace the members of the collections that it names;
    categories that aren't known become new ones, and the collections are queued for publishing."""
    rows = sheet.select(F.lower("Accession").alias("_a"), F.explode(X.category_tokens(F.col("Categories"))).alias("name"))
    rows = rows.join(tables["collections"].select("collection_id", "accession", F.lower("accession").alias("_a")), "_a")
    partitions = joins.complete_dimension(rows, tables["partitions"], "name", "partition_id")
    members = rows.join(partitions, "name").select("collection_id", "partition_id").distinct()
    return {"partitions": partitions, "partition_members": mutations.replace_children(tables["partition_members"], members, "collection_id"), "queued_updates": mutations.insert_set(tables["queued_updates"].select("accession"), rows.select("accession").distinct())}


def overview(tables: Tables, phases: list[str], subset=None) -> Tables:
    """The reports' numbers: table counts, media, processing and corpus metrics."""
    seg = tables["segments"]
    tagged = tables["annotations"].where("type = 'Tag'").select(F.col("segment_id").alias("story_no")).join(seg.select(F.col("segment_id").alias("story_no"), "session_id"), "story_no").select("session_id", "story_no")
    return {
        "counts": aggregates.table_counts({k: tables[k] for k in ("collections", "sessions", "segments")}),
        "media": aggregates.media_metrics(seg.where("ready = 'Y'"), F.col("duration")),
        "processing": aggregates.processing_metrics(joins.densify(seg, tables["task_states"], "segment_id", "name", "state", list(state.TASKS), "P"), "segment_id", "name", "state", list(state.TASKS)),
        "corpus": aggregates.corpus_metrics(tables["collections"], tables["sessions"], seg.select("session_id", F.col("segment_id").alias("story_no")), tagged, phases, F.lit(True) if subset is None else subset),
    }


def run_processing(tables: Tables, words: DataFrame, named: DataFrame, gazetteers: Tables, states: list, this_year: int) -> Tables:
    """Captions and entities of all segments at once: words from the aligner, named from the recognizers' merge."""
    seg = tables["segments"]
    cues = captions.captions(words, seg)
    dates = entities.resolve_dates(seg, this_year)
    orgs = entities.resolve_organizations(named, gazetteers["synonyms"], gazetteers["authority"])
    places, rest = entities.resolve_places(named, states, gazetteers["place_hints"], gazetteers["places"])
    world = entities.resolve_world(rest, gazetteers["countries"], gazetteers["city_hints"], gazetteers["cities"])
    return {"captions": sinks.vtt(cues, "segment_id"), "named_entities": mutations.replace_children(tables["named_entities"], entities.emitted(dates, orgs, places, world), "segment_id", seg)}


def publish(tables: Tables, explicit: DataFrame, phases: list[str], target: str, manifest: DataFrame) -> Tables:
    """Documents of the chosen sessions that pass the gate, as blobs that differ from the manifest, and the sessions with the
    phase that they move up to."""
    chosen = documents.chosen_sessions(tables["sessions"], explicit, phases)
    seg = tables["segments"].join(chosen.select("session_id", "phase"), "session_id")
    gate = state.may_publish(seg, "session_id", [F.col("ready") == "Y", F.col("media_path").isNotNull()], F.col("phase"), target == "P").where("may_publish").select("session_id")
    s = chosen.join(gate, "session_id", "left_semi")
    ids = s.select("collection_id").distinct()
    bio = documents.biography_details(tables["collections"].join(ids, "collection_id", "left_semi"), s, tables["movies"], tables["segments"])
    blobs = sinks.json_documents(bio, "collection_id").select(F.concat(F.lit("data/biography/details/"), "collection_id").alias("path"), "content")
    moved = tables["sessions"].join(gate, "session_id", "left_semi").withColumn("phase", state.moved_phase(F.col("phase"), F.lit(target)))
    return {"blobs": mutations.changed(blobs, manifest), "sessions": mutations.upsert(tables["sessions"], moved, ["session_id"], "session_id")}


def recall(tables: Tables, sessions: DataFrame, target: str) -> Tables:
    """Sessions move down to the target phase; the paths of their stories are given for deletion."""
    moved = tables["sessions"].join(sessions, "session_id", "left_semi").withColumn("phase", state.moved_phase(F.col("phase"), F.lit(target), up=False))
    paths = tables["segments"].join(sessions, "session_id", "left_semi").select(F.concat(F.lit("data/story/details/"), F.col("segment_id").cast("string")).alias("path"))
    return {"sessions": mutations.upsert(tables["sessions"], moved, ["session_id"], "session_id"), "blobs": paths}


def import_tags(tables: Tables, remote: DataFrame) -> Tables:
    """Tags of records that are new or changed replace those of their segments."""
    status = state.tag_sync(remote, tables["tag_import_status"])
    fresh = status.where("status <> 'unchanged'")
    tags = fresh.select("segment_id", F.lit("Tag").alias("type"), F.explode("tags").alias("value"))
    others = tables["annotations"].where("type <> 'Tag'")
    replaced = mutations.replace_children(tables["annotations"].where("type = 'Tag'"), tags, "segment_id", fresh)
    return {"annotations": others.unionByName(replaced.select(others.columns)), "tag_import_status": status.select("segment_id", "last_modified", F.col("status").alias("last_status"))}


def collect_garbage(tables: Tables, listing: DataFrame) -> Tables:
    """Blobs (path) that no row stands behind, and the counts by type."""
    d = listing.select("path", X.blob_parts(F.col("path")).alias("p")).select("path", F.col("p.scope").alias("scope"), "p.id")
    checked = joins.orphans(d, {"biography": tables["collections"].select("collection_id"), "story": tables["segments"].select("segment_id")})
    return {"garbage": checked.where("not is_valid").select("path"), "counts": aggregates.good_bad_total(checked, F.col("is_valid"), ["scope"])}


def delete_collections(tables: Tables, ids: DataFrame) -> Tables:
    links = [("sessions", "collections", "collection_id"), ("movies", "sessions", "session_id"), ("segments", "movies", "movie_id")]
    return mutations.cascade_delete({k: tables[k] for k in ("collections", "sessions", "movies", "segments")}, links, "collections", "collection_id", ids)
