"""The archive's tools over a miniature archive."""

import datetime

import pytest
from pyspark.sql import functions as F

from storyloom import commands
from storyloom.operators import state

DAY = datetime.date(2020, 1, 2)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "collections": make([(1, "A1", "Dawson", DAY), (2, "a2", "Solo", None)], "collection_id int, accession string, last_name string, birth_date date"),
        "sessions": make([(10, 1, 1, DAY, "x", "y", "R"), (11, 1, 2, DAY, "x", "y", "D")], "session_id int, collection_id int, session_order int, interview_date date, interviewer string, location string, phase string"),
        "movies": make([(100, 10, 1, "m1"), (101, 11, 1, "m2")], "movie_id int, session_id int, tape int, movie_name string"),
        "segments": make([(7, 100, 10, 1, "t", 0, 5, "in 1950 [Chicago]", "Y", "a.mp4"), (8, 101, 11, 1, "u", 0, None, "x", "N", None)], "segment_id int, movie_id int, session_id int, segment_order int, title string, start_time int, duration int, transcript string, ready string, media_path string"),
        "annotations": make([(7, "Tag", "ABCDEFGH-1"), (8, "Note", "n")], "segment_id int, type string, value string"),
        "task_states": make([(7, n, "C") for n in state.TASKS] + [(8, "Alignment", "F")], "segment_id int, name string, state string"),
        "partitions": make([(1, "Art")], "partition_id int, name string"), "partition_members": make([(1, 9), (2, 1)], "collection_id int, partition_id int"), "queued_updates": make([("a2",)], "accession string"),
        "tag_import_status": make([(7, 5)], "segment_id int, last_modified long"), "named_entities": make([(7, "Year", "1900")], "segment_id int, type string, value string"), "probes": make([("m9", 10_000)], "movie_name string, duration int"),
    }


def test_import_movies(spark, tables, tmp_path):
    seg = lambda t, a, b: f"<Segment><Title>{t}</Title><StartTime>{a}</StartTime><EndTime>{b}</EndTime><Transcript><Paragraph>p</Paragraph></Transcript></Segment>"
    (tmp_path / "m.xml").write_text(f"<XmlMovie><Collection>a1</Collection><SessionOrder>2</SessionOrder><Tape>3</Tape><Path>x/m9.mp4</Path><Segments>{seg('one', 0, 4000)}{seg('two', 4000, 90000)}{seg('bad', 9000, 1)}{seg('late', 1, 2)}</Segments></XmlMovie>")
    out = commands.import_movies(spark, str(tmp_path), tables)
    assert rows(out["movies"]) == [(1, 11, "m9", 3, 10_000)]
    assert rows(out["segments"], "segment_name", "title", "end_time", "prev_id", "next_id") == [("m9_001", "one", 4000, 0, 2), ("m9_002", "two", 10_000, 1, 0)]


def test_export_and_update(spark, tables, tmp_path):
    commands.export_collections(tables, str(tmp_path / "x"))
    assert "<Accession>A1</Accession>" in "".join(p.read_text() for p in (tmp_path / "x").glob("part*"))
    out = commands.update_collections(tables, spark.createDataFrame([("a1", "Arts | Laws")], "Accession string, Categories string"))
    assert rows(out["partitions"]) == [(1, "Art"), (2, "Law")] and rows(out["partition_members"]) == [(1, 1), (1, 2), (2, 1)] and rows(out["queued_updates"]) == [("A1",), ("a2",)]


def test_overview(tables):
    out = commands.overview(tables, ["R", "P"])
    assert rows(out["counts"]) == [(2, 2, 2)] and rows(out["media"]) == [(5, 5, 5, 5)]
    assert out["processing"].first().asDict() == {"complete": 1, "failed": 1, "pending": 1, "running": 0, "total": 3}
    c = out["corpus"].first()
    assert (c["all_biographies"], c["all_stories"], c["all_tagged_stories"]) == (1, 1, 1)


def test_processing(spark, tables):
    words = spark.createDataFrame([(7, 0, "success", "in", 0, 500, 0, 2), (7, 1, "success", "1950", 500, 1500, 3, 7)], "segment_id int, seq int, case string, word string, start int, end int, offset_start int, offset_end int")
    named = spark.createDataFrame([(7, 9, 16, "Loc", "Chicago", 1)], "segment_id int, start int, end int, kind string, text string, confidence int")
    none = {"synonyms": "name string, org_id string", "authority": "name string, org_id string", "countries": "country_id int, name string", "city_hints": "name string, city_id int, country_id int", "cities": "name string, country_id int, city_id int", "places": "state string, name string, place_id int"}
    gaz = {k: spark.createDataFrame([], v) for k, v in none.items()} | {"place_hints": spark.createDataFrame([("Chicago", "IL", 7)], "name string, state string, place_id int")}
    out = commands.run_processing(tables, words, named, gaz, [("IL", "Illinois", ())], 2020)
    assert rows(out["named_entities"]) == [(7, "Decade", "1950"), (7, "USState", "IL-7"), (7, "Year", "1950")]
    assert "in 1950" in out["captions"].first()["content"]


def test_publish_and_recall(spark, tables):
    empty = spark.createDataFrame([], "path string, content_md5 string")
    out = commands.publish(tables, spark.createDataFrame([(11,)], "session_id int"), ["R"], "P", empty)
    assert rows(out["blobs"], "path") == [("data/biography/details/1",)] and rows(out["sessions"], "session_id", "phase") == [(10, "P"), (11, "D")]
    again = commands.publish(tables, spark.createDataFrame([], "session_id int"), ["R"], "P", out["blobs"].select("path", "content_md5"))
    assert "tapes" in out["blobs"].first()["content"] and again["blobs"].count() in (0, 1)
    back = commands.recall(tables, spark.createDataFrame([(10,)], "session_id int"), "D")
    assert rows(back["sessions"], "session_id", "phase") == [(10, "D"), (11, "D")] and rows(back["blobs"]) == [("data/story/details/7",)]


def test_tags_garbage_and_delete(spark, tables):
    remote = spark.createDataFrame([(7, 6, ["NEW"]), (8, 1, ["X", "Y"])], "segment_id int, last_modified long, tags array<string>")
    out = commands.import_tags(tables, remote)
    assert rows(out["annotations"]) == [(7, "Tag", "NEW"), (8, "Note", "n"), (8, "Tag", "X"), (8, "Tag", "Y")] and rows(out["tag_import_status"]) == [(7, 6, "changed"), (8, 1, "new")]
    listing = spark.createDataFrame([("data/story/details/7",), ("data/story/details/99",), ("data/biography/details/2",)], "path string")
    found = commands.collect_garbage(tables, listing)
    assert rows(found["garbage"]) == [("data/story/details/99",)] and rows(found["counts"]) == [("biography", 1, 0, 1), ("story", 1, 1, 2)]
    left = commands.delete_collections(tables, tables["collections"].where(F.col("collection_id") == 1))
    assert {k: v.count() for k, v in left.items()} == {"collections": 1, "sessions": 0, "movies": 0, "segments": 0}
