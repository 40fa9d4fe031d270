"""Golden rows and properties of the archive's own rules."""

import datetime
import io
import json
import zipfile

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storyloom.config import CaptionLimits
from storyloom.functions import scalar as X
from storyloom.functions import timecode as T
from storyloom.operators import captions as C
from storyloom.operators import documents as D
from storyloom.operators import entities as E
from storyloom.operators import joins as J
from storyloom.operators import lookups as L
from storyloom.operators import mutations as M
from storyloom.operators import sequences as S
from storyloom.operators import state
from storyloom.sources import files, sinks, tagged_text, xml
from storyloom.streaming import feeds


def one(spark, column, **values):
    return spark.createDataFrame(pd.DataFrame([values])).select(column.alias("v")).first()["v"]


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


# scalars ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("make", "value", "want"),
    [
        (lambda c: X.shortened(c, 10), "one two three four", "one two..."), (lambda c: X.shortened(c, 10), "abcdefghijklmnop", "abcdefghijklmnop"), (X.first_last, "Dawson, William", "William Dawson"),
        (X.without_brackets, "a [b (c] d) (e) f [g", "a  d)  f "), (X.redacted, "a [b c] d", "a -- -- d"), (X.redacted, "a [b", None), (X.redacted, "[a [b] c]", "-- --- --"), (X.vtt_escaped, "a<b>&", "a&lt;b&gt;&amp;"),
        (X.file_extension, "x/y.mp4", "mp4"), (X.safe_file_name, "a b-c.d", "a_b_c_d"), (X.caption_path, "mp4/a.mp4", "vtt/a.vtt"), (X.md5_base64, "", "1B2M2Y8AsgTpgAmY7PhCfg=="), (X.mime_type, "VTT", "text/vtt"),
        (X.category_tokens, "Makers | makers |Artists|", ["Maker", "maker", "Artist"]), (X.gender_lenient, "male", "M"), (X.gender_lenient, "", "F"), (X.straight_quotes, "“it’s”", '"it\'s"'),
        (lambda c: X.vocabulary_match(c, ["Arts & Letters", "Law, Order"]), "arts and", "Arts & Letters"), (lambda c: X.vocabulary_match(c, ["Law, Order"]), "law order", "Law, Order"),
        (lambda c: X.first_prefix(c, ["***SPONSOR", "***SPONSOR URL"]), "***SPONSOR URL x", "***SPONSOR URL"), (T.padded, "1:02:03", "00:01:02:03"),
    ],
)
def test_scalar(spark, make, value, want):
    assert one(spark, make(F.col("x")), x=value) == want


def test_gender_strict_raises(spark):
    assert one(spark, X.gender_strict(F.col("x")), x=" female") == "F"
    with pytest.raises(Exception, match="not a gender"):
        one(spark, X.gender_strict(F.col("x")), x="unknown")


def test_time_codes(spark):
    assert one(spark, T.parse(F.col("x")), x="00:00:00:15") == 0.5
    assert one(spark, T.parse(F.col("x")), x="01:00:00.25") == 3600.25
    assert one(spark, T.parse(F.col("x")), x="00:61:00:45") == 59 * 60 + 29 / 30
    assert one(spark, T.parse(F.col("x")), x="soon") == -1
    assert round(one(spark, T.to_real_time(F.col("x")), x=3600.0), 1) == 3603.6
    assert one(spark, T.hundredths_before(F.col("x")), x=3.0) == 2.97
    codes = [(f"{h:02d}:{m:02d}:{s:02d}.{f:02d}",) for h, m, s, f in ((0, 0, 0, 0), (1, 2, 3, 4), (9, 59, 59, 99), (12, 0, 30, 50))]
    df = spark.createDataFrame(codes, "c string")
    assert all(r["c"] == r["again"] for r in df.select("c", T.format_seconds(T.parse(F.col("c"))).alias("again")).collect())
    assert one(spark, X.ms_to_hms(F.col("x")), x=3661500) == "001:01:02"


# tagged text, XML and files -----------------------------------------------------------------------

MOVIE = """***MOVIE
***ACCESSION
A2020.001
***SESSION
1
***TAPE
1
***ABSTRACT
text of
two lines
***STORY
00:00:10:00
First story
***TRANSCRIPT
Para one
goes on

Para two
***STORY
00:03:00:00
Second story
***TRANSCRIPT
Para [open
***END
"""


def test_tagged_text(spark, tmp_path):
    (tmp_path / "m.txt").write_text(MOVIE)
    (tmp_path / "c.txt").write_text("***COLLECTION\n***ACCESSION\nA2020.001\n***MAKERS\nArtMakers\nLawMakers\n")
    d = tagged_text.lines(spark, str(tmp_path))
    assert {r["kind"] for r in d.select("kind").distinct().collect()} == {"movie", "collection"}
    found = tagged_text.fields(d)
    assert {(r["tag"], r["value"]) for r in found.where("kind = 'movie' and tag like '%A%'").collect()} >= {("***ACCESSION", "A2020.001"), ("***ABSTRACT", "text of two lines"), ("***TAPE", "1")}
    assert rows(tagged_text.missing_tags(found, {"collection": ["***Accession", "***Name"], "movie": ["***TAPE"]}), "kind", "tag") == [("collection", "***NAME")]
    assert rows(tagged_text.values(d.where("kind = 'collection'")), "tag", "value") == [("***ACCESSION", "A2020.001"), ("***MAKERS", "ArtMakers"), ("***MAKERS", "LawMakers")]
    s = tagged_text.with_default_ends(tagged_text.stories(d.where("kind = 'movie'"))).orderBy("story").collect()
    assert [(r["title"], r["start_frame"], r["end_frame"], r["to_end"], r["paragraphs"]) for r in s] == [
        ("First story", 300, 3 * 60 * 30 - 1, False, ["Para one goes on", "Para two"]), ("Second story", 5400, None, True, ["Para [open"]),
    ]
    assert [r["depth"] for r in tagged_text.unbalanced_brackets(d).collect()] == [1]
    assert one(spark, tagged_text.movie_path(F.col("x"), F.lit("f.mov")), x="A2020.001") == "A2020/001/f.flv"


def test_xml(spark, tmp_path):
    (tmp_path / "a.movie.xml").write_text(
        '<?xml version="1.0"?>\n<XmlMovie><Collection>A1</Collection><SessionOrder>1</SessionOrder><Tape>2</Tape><Segments>'
        "<Segment><Title>One</Title><StartTime>0</StartTime><EndTime>5</EndTime><Transcript><Paragraph>p &amp; q</Paragraph><Paragraph>r</Paragraph></Transcript></Segment>"
        "<Segment><Title>Two</Title><TimeFormat>HMS-END</TimeFormat></Segment></Segments></XmlMovie>"
    )
    (tmp_path / "b.world.xml").write_text("<XmlWorld><Name>Makers</Name><Partitions><Partition><Name>Art</Name></Partition></Partitions></XmlWorld>")
    assert {r["root"] for r in xml.root_elements(spark, str(tmp_path)).collect()} == {"XmlMovie", "XmlWorld"}
    found = xml.read_all(spark, str(tmp_path))
    assert [found[k].count() for k in ("XmlMovie", "XmlWorld", "XmlCollection")] == [1, 1, 0]
    seg = xml.segments(found["XmlMovie"]).orderBy("segment_order").collect()
    assert [(r["segment_order"], r["Title"], r["paragraphs"]) for r in seg] == [(1, "One", ["p & q", "r"]), (2, "Two", None)]
    xml.write(found["XmlWorld"], str(tmp_path / "out"), "XmlWorld")
    assert xml.read(spark, str(tmp_path / "out"), "XmlWorld").collect() == found["XmlWorld"].collect()


def test_files(spark, tmp_path):
    (tmp_path / "g.txt").write_text("name\tid\nAkron\t1\nAkron\t2\nbad row\nLima\t3\n")
    assert rows(files.gazetteer(spark, str(tmp_path / "g.txt"), ["name", "id"], "name")) == [("Akron", "1"), ("Lima", "3")]
    with pytest.raises(ValueError, match="repeated"):
        files.gazetteer(spark, str(tmp_path / "g.txt"), ["name", "id"], "name", strict=True)
    (tmp_path / "s.csv").write_text("text,start,end,label\nParis,0,5,GPE\na,b,c,d,e\nx,one,2,ORG\n")
    assert rows(files.spacy_rows(spark, str(tmp_path / "s.csv")), "seq", "text", "bad") == [(1, "Paris", False), (3, "x", True)]
    (tmp_path / "t.tsv").write_text("-LSB-\tO\nUS\tLOCATION\nno label\n")
    assert rows(files.stanford_rows(spark, str(tmp_path / "t.tsv")), "seq", "token", "label") == [(0, "-LSB-", "O"), (1, "US", "LOCATION")]
    (tmp_path / "a.json").write_text(json.dumps({"transcript": "a b", "words": [{"case": "success", "word": "a", "start": 0.0125, "end": 0.5, "startOffset": 0, "endOffset": 1}, {"case": "not-found-in-audio", "word": "b"}]}))
    assert rows(files.aligned_words(spark, str(tmp_path / "a.json")), "word", "start", "end")[0][0] == "a"
    (tmp_path / "tags.json").write_text(json.dumps({"71": {"accession": "A1", "lastModified": 5, "tags": ["x"]}}))
    assert rows(files.tag_records(spark, str(tmp_path / "tags.json")), "segment_id", "accession", "last_modified", "tags") == [(71, "A1", 5, ["x"])]
    body = io.BytesIO()
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t>one</w:t><w:tab/><w:t>two</w:t></w:r></w:p><w:p><w:r><w:t>three</w:t></w:r></w:p></w:body></w:document>')
    (tmp_path / "d.docx").write_bytes(body.getvalue())
    assert [r["value"] for r in files.documents_text(spark, str(tmp_path)).collect()] == ["one two\nthree"]
    assert ("d.docx",) in rows(files.listing(spark, str(tmp_path)), "file")
    assert one(spark, files.probed(F.col("x")), x="Duration: 00:01:02.50, start\n Stream Video: h264, yuv420p, 640x360, 29.97 fps").asDict() == {"duration": 62500, "width": 640, "height": 360, "fps": 29.97}
    (tmp_path / "sheet.csv").write_text("Accession,Name\nA1,x\n")
    assert files.spreadsheet(spark, str(tmp_path / "sheet.csv"), ["accession"]).count() == 1
    with pytest.raises(ValueError, match="Birth"):
        files.spreadsheet(spark, str(tmp_path / "sheet.csv"), ["Accession", "Birth"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [("x", 1)])], "story_id int, main_title string, parts array<struct<part_name:string,part_no:int>>")
    assert json.loads(sinks.json_documents(df, "story_id").first()["content"]) == {"storyId": 1, "mainTitle": "a", "parts": [{"partName": "x", "partNo": 1}]}
    cues = spark.createDataFrame([(1, 1, 1000, 2000, ["b <c>"]), (1, 0, 0, 1000, ["a", "d"])], "k int, seq int, start long, end long, lines array<string>")
    assert sinks.vtt(cues, "k").first()["content"] == "WEBVTT\n\n00:00.000 --> 00:01.000\na\nd\n\n00:01.000 --> 00:02.000\nb &lt;c&gt;\n"
    sinks.write_report(spark.createDataFrame([(1, 2)], "good int, bad int"), str(tmp_path / "r"))
    assert sorted(r["_c0"] + r["_c1"] for r in spark.read.csv(str(tmp_path / "r")).collect()) == ["bad2", "good1"]


# captions -----------------------------------------------------------------------------------------


def spoken(text, step=300, unaligned=()):
    words, at = [], 0
    for i, w in enumerate(text.split()):
        at = text.index(w, at)
        words.append(C.Word(w, i * step, i * step + step - 20, at, at + len(w), i not in unaligned))
        at += len(w)
    return words


def test_captions_keep_every_word_in_order():
    text = "Where were you born?\n\n" + "I was born in a very small town " * 8 + "\n\nYes.\n\nAnd then we moved to the city."
    text = text.replace(" \n", "\n").strip()
    cues = C.cue_rows(spoken(text), text, 100_000, CaptionLimits())
    said = " ".join(" ".join(c[3]) for c in cues)
    assert said.split() == text.split()
    assert all(a[2] <= b[1] for a, b in zip(cues, cues[1:])) and all(c[1] < c[2] for c in cues)
    assert cues[0][4][0] == "S1" and len(cues) > 4


def test_captions_repair_and_interpolation():
    w = spoken("a b c d e f g h")
    w[2].start, w[2].end, w[3].start, w[3].end = w[3].start, w[3].end, w[2].start, w[2].end
    C.repair_times(w, 10_000)
    assert [x.start for x in w] == sorted(x.start for x in w)
    late = spoken("a b c d")
    C.repair_times(late, 700)
    assert late[-1].end <= 700 and late[0].start == 0
    gap = spoken("a b c d e", unaligned=(1, 2))
    out = C.interpolate(gap, 5000, 3)
    assert [(x.start, x.end) for x in out[1:3]] == [(280, 590), (590, 900)]
    assert len(C.interpolate(spoken("a b c d e f", unaligned=(2, 3, 4, 5)), 5000, 3)) == 2
    assert len(C.interpolate(spoken("a b c d", unaligned=(2, 3)), 5000, 3)) == 4


def test_captions_words_take_quotes_and_hyphens():
    text = 'He said "well [laughs] known-by name"'
    words = [C.Word(t, i * 300, i * 300 + 200, text.index(t), text.index(t) + len(t)) for i, t in enumerate(("He", "said", "well", "laughs", "known", "by", "name"))]
    ((cleaned, dealt),) = C.deal(words, text)
    assert cleaned == 'He said "well known-by name"' and "".join(w.text for w in dealt) == cleaned
    assert [w.text for w in dealt] == ["He ", "said ", '"well ', "known-by ", 'name"']


def test_captions_over_segments(spark):
    text = "one two three four five six seven eight nine ten"
    w = [(5, i, "success", x.text, x.start, x.end, x.begin, x.stop) for i, x in enumerate(spoken(text))]
    words = spark.createDataFrame(w, "segment_id long, seq int, case string, word string, start int, end int, offset_start int, offset_end int")
    segments = spark.createDataFrame([(5, text, 4000), (6, "no words", 1)], "segment_id long, transcript string, duration int")
    out = C.captions(words, segments).collect()
    assert {r["segment_id"] for r in out} == {5} and " ".join(x for r in sorted(out, key=lambda r: r["seq"]) for x in r["lines"]) == text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=40))
def test_interpolated_times_never_run_back(known):
    words = [C.Word(f"w{i}", i * 100, i * 100 + 90, 0, 0, k) for i, k in enumerate(known)]
    out = C.interpolate(words, len(known) * 100, 3)
    times = [t for w in out for t in (w.start, w.end)]
    assert times == sorted(times)


def test_column_form_of_interpolation_agrees(spark):
    known = [True, False, False, True, True, False, True, False, False]
    words = C.interpolate([C.Word("", i * 100, i * 100 + 90, 0, 0, k) for i, k in enumerate(known)], 690, 3)
    df = spark.createDataFrame([(1, i, i * 100, i * 100 + 90, k) for i, k in enumerate(known)], "k int, seq int, start long, end long, known boolean")
    got = [(r["start"], r["end"]) for r in S.interpolated(df, "k", ["seq"], "start", "end", F.col("known")).orderBy("seq").collect()]
    assert got[:7] == [(w.start, w.end) for w in words[:7]]


# entities -----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("in '29 [1929] we", ["1929"]), ("5'11\" tall", []), ("1900 South Michigan", []), ("1500 Pennsylvania Ave.", []), ("1959], East St. Louis", ["1959"]), ("1899 in St. Augustine", ["1899"]),
        ("'87 [1987] well Lane Tech", ["1987"]), ("'57, you know, 1957", ["1957"]), ("the 1920s", ["1920s"]), ("'73' quoted", []), ("1929\n1930", ["1929", "1930"]), ("room 12345 and 0999", []), ("", []),
    ],
)
def test_years(text, want):
    assert [v for _, v, _ in E.years_in(text, 2020)] == want


def test_dates_are_counted_and_boosted(spark):
    df = spark.createDataFrame([(1, "in 1950 and by 1950 and the 1960s"), (2, None)], "segment_id long, transcript string")
    assert rows(E.resolve_dates(df, 2020), "segment_id", "value", "n", "confidence") == [(1, "1950", 2, 4), (1, "1960s", 1, 2)]


def test_tokens_become_entities(spark):
    tokens = [("-LSB-", "O"), ("US", "LOCATION"), ("Congressman", "O"), ("William", "PERSON"), ("-RSB-", "PERSON"), ("Dawson", "PERSON"), ("went", "O"), ("to", "O"), ("Paris", "LOCATION")]
    df = spark.createDataFrame([(1, i, t, k) for i, (t, k) in enumerate(tokens)], "segment_id long, seq int, token string, label string")
    assert rows(E.grouped_tokens(df), "kind", "text") == [("Loc", "Paris"), ("Person", "[US Congressman William] Dawson")]


def test_merge_of_passes(spark):
    second = spark.createDataFrame([(1, 0, 0, 10, "Org", "Acme Works"), (1, 1, 20, 25, "Loc", "Paris"), (1, 2, 90, 95, "Loc", "Later")], "segment_id long, seq int, start int, end int, kind string, text string")
    spacy = spark.createDataFrame([(1, 0, 0, 4, "Org", "Acme", True), (1, 1, 20, 25, "Org", "Paris", True), (1, 2, 40, 44, "Person", "Dawn", True), (1, 3, 50, 55, "Loc", "wrong", False), (1, 4, 60, 65, "Loc", "Lima", True)], "segment_id long, seq int, start int, end int, kind string, text string, good boolean")
    got = rows(E.merged(second, spacy), "start", "kind", "text", "confidence")
    assert got == [(0, "Org", "Acme", 3), (20, "Loc", "Paris", 1), (20, "Org", "Paris", 2), (40, "Person", "Dawn", 1)]


STATES = [("VA", "Virginia", ()), ("WV", "West Virginia", ()), ("IL", "Illinois", ()), ("NY", "New York", ()), ("MD", "Maryland", ()), ("WA", "Washington", ())]


@pytest.mark.parametrize(("name", "want"), [("West Virginia", "WV"), ("in West Virginia", "WV"), ("Virginia", "VA"), ("U.S. Naval Academy , Maryland", "MD"), ("Washington", "WA"), ("George Washington", None), ("Oregon", None), ("IL", "IL")])
def test_states(spark, name, want):
    assert one(spark, E.looked_up_state(F.col("x"), STATES), x=name) == want


@pytest.mark.parametrize(("context", "want"), [("Washington, D.C.", "DC"), ("Washington near Tacoma, not D.C.", "WA"), ("Washington", None)])
def test_washington(spark, context, want):
    assert one(spark, E.washington(F.col("x")), x=context) == want


def test_places(spark):
    e = spark.createDataFrame([
        (1, 0, 7, "Loc", "Chicago", 2), (1, 9, 17, "Loc", "Illinois", 2), (1, 40, 60, "Loc", "the city of Akron", 1), (1, 70, 80, "Loc", "Lake Michigan", 1), (1, 100, 110, "Loc", "Annapolis [ Academy , Maryland ]", 1), (1, 120, 130, "Loc", "Paris, France", 1), (1, 140, 145, "Loc", "France", 1), (1, 150, 155, "Loc", "Wyoming Avenue", 1),
    ], "segment_id long, start int, end int, kind string, text string, confidence int")
    hints = spark.createDataFrame([("Akron", "OH", 39)], "name string, state string, place_id int")
    places = spark.createDataFrame([("IL", "Chicago", 7), ("MD", "Annapolis", 8)], "state string, name string, place_id int")
    resolved, rest = E.resolve_places(e, STATES, hints, places)
    assert {(r["state"], r["place_id"]) for r in resolved.collect()} == {("IL", 7), ("IL", None), ("OH", 39), ("MD", 8)}
    countries = spark.createDataFrame([(4, "France"), (5, "Peru")], "country_id int, name string")
    cities = spark.createDataFrame([("Paris", 4, 1), ("Paris", 5, 2)], "name string, country_id int, city_id int")
    world = E.resolve_world(rest, countries, spark.createDataFrame([], "name string, city_id int, country_id int"), cities)
    assert {(r["country_id"], r["city_id"]) for r in world.collect()} == {(4, 1), (4, None)}


def test_organizations(spark):
    e = spark.createDataFrame([(1, 0, "Org", "UC Berkeley", 1), (1, 20, "Org", "the Carnegie Mellon", 2), (1, 50, "Org", "Buffalo Bills football team", 1), (1, 60, "Org", "Nobody Inc", 1)], "segment_id long, start int, kind string, text string, confidence int")
    synonyms = spark.createDataFrame([("Carnegie Mellon", "n79054102")], "name string, org_id string")
    authority = spark.createDataFrame([("University of California, Berkeley", "u1"), ("Buffalo Bills (Football team)", "b1")], "name string, org_id string")
    out = E.resolve_organizations(e, synonyms, authority)
    assert rows(out, "org_id", "n") == [("b1", 1), ("n79054102", 1), ("u1", 1)]
    none = spark.createDataFrame([], "segment_id long, state string, place_id int, country_id int, city_id int")
    dates = spark.createDataFrame([(1, "1950"), (1, "1960s"), (1, "x999")], "segment_id long, value string")
    assert rows(E.emitted(dates, out, none, none)) == [(1, "Decade", "1950"), (1, "Decade", "1960"), (1, "Organization", "b1"), (1, "Organization", "n79054102"), (1, "Organization", "u1"), (1, "Year", "1950")]


# state, documents, mutations and feeds ------------------------------------------------------------


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 9)), max_size=8), st.lists(st.tuples(st.integers(1, 6), st.integers(0, 9)), max_size=8))
def test_upsert_twice_is_upsert_once(spark, old, new):
    a, b = (spark.createDataFrame(list(dict(x).items()) if i == 0 else x, "k int, v int") for i, x in enumerate((old, new)))
    once = M.upsert(a, b, ["k"], "v")
    want = dict(old) | {k: max(v for x, v in new if x == k) for k, _ in new}
    assert dict(rows(once)) == want and rows(M.upsert(once, b, ["k"], "v")) == rows(once)


def test_mutations(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    table, conflicts = M.update_if_unchanged(old, spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(1, "a"), (2, "old")], "k int, v string"), ["k"], ["v"])
    assert rows(table) == [(1, "x"), (2, "b")] and rows(conflicts) == [(2,)]
    assert rows(M.insert_if_absent(old, spark.createDataFrame([(2, "z"), (3, "c"), (3, "d")], "k int, v string"), ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    blobs = spark.createDataFrame([("p", "x"), ("q", "y")], "path string, content string")
    manifest = M.changed(blobs, spark.createDataFrame([], "path string, content_md5 string")).select("path", "content_md5")
    assert M.changed(blobs, manifest).count() == 0


def test_lookups(spark):
    df = spark.createDataFrame([(0, "A"), (2, "b")], "id int, name string")
    assert L.single(df.where("id = 2")).first()["name"] == "b"
    for bad in ("id = 9", "id >= 0"):
        with pytest.raises(ValueError):
            L.single(df.where(bad))
    assert rows(df.select(L.null_id("id").alias("x")).where("x is not null")) == [(2,)]
    assert L.missing_columns(df, ["ID", "Other"]) == ["Other"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=12))
def test_links_form_one_chain(spark, orders):
    df = spark.createDataFrame([(1, o, i + 1) for i, o in enumerate(orders)], "k int, o int, id int")
    got = {r["id"]: (r["prev_id"], r["next_id"]) for r in S.linked(df, "k", ["o", "id"], "id").collect()}
    assert all(n == 0 or got[n][0] == i for i, (_, n) in got.items()) and sum(p == 0 for p, _ in got.values()) == 1


def test_documents(spark):
    day = datetime.date(1950, 3, 4)
    c = spark.createDataFrame([(1, "A1", "Dawson", day), (2, "A2", "Solo", None)], "collection_id int, accession string, last_name string, birth_date date")
    s = spark.createDataFrame([(11, 1, 2, day, "x", "y"), (10, 1, 1, day, "x", "y")], "session_id int, collection_id int, session_order int, interview_date date, interviewer string, location string")
    m = spark.createDataFrame([(100, 10, 2, 640, 360), (101, 10, 1, 640, 480)], "movie_id int, session_id int, tape int, width int, height int")
    g = spark.createDataFrame([(7, 100, 1, "t", 0, None, "x"), (8, 101, 1, "u", 0, 5, "y")], "segment_id int, movie_id int, segment_order int, title string, start_time int, duration int, transcript string")
    a = spark.createDataFrame([(7, "Tag", "ABCDEFGH-1"), (7, "Tag", "ABCDEFGH-2"), (7, "Facet", "12"), (7, "Facet", "x")], "segment_id int, type string, value string")
    bio = D.biography_details(c, s, m, g).orderBy("collection_id").collect()
    assert [x["session_order"] for x in bio[0]["sessions"]] == [1, 2] and [t["tape"] for t in bio[0]["sessions"][0]["tapes"]] == [1, 2] and bio[1]["sessions"] == []
    assert (bio[0]["birth_year"], bio[0]["last_initial"]) == (1950, "D")
    assert rows(D.story_ids(D.biography_details(c, s, m, g))) == [(1, 7), (1, 8)]
    assert rows(D.facet_ids(a, "segment_id", "Facet", "ids")) == [(7, [12])]
    stories = D.story_details(g, m, s, c, a)
    assert rows(stories, "story_id", "aspect_ratio", "tags", "duration") == [(7, "16:9", ["ABCDEFGH"], -1), (8, "4:3", [], 5)]
    found = D.story_search(stories, spark.createDataFrame([(7, "Year", "1950")], "segment_id int, type string, value string"))
    assert rows(found, "story_id", "entity_years", "entity_states") == [(7, ["1950"], []), (8, [], [])]


def test_joins(spark):
    docs = spark.createDataFrame([(1, [(10, [(100,), (101,)])]), (2, [])], "c int, sessions array<struct<s:int,stories:array<struct<x:int>>>>")
    assert rows(J.flatten(docs, "sessions", "stories"), "c", "s", "x") == [(1, 10, 100), (1, 10, 101)]
    g = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "name string, n int")
    assert rows(J.first_wins(g, "name", "n")) == [("a", 1), ("b", 3)]


def test_tag_feed(spark, tmp_path):
    local = str(tmp_path / "local")
    spark.createDataFrame([(1, 5, ["a"]), (2, 5, ["b"])], "segment_id int, last_modified long, tags array<string>").write.parquet(f"{local}/v0")
    spark.createDataFrame([(1, 5, ["z"]), (2, 6, ["c"]), (3, 1, ["d"])], "segment_id int, last_modified long, tags array<string>").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("segment_id int, last_modified long, tags array<string>").parquet(str(tmp_path / "in"))
    seen = []
    feeds.sync_tags(stream, local, str(tmp_path / "cp"), lambda s: seen.extend(rows(s, "segment_id", "status"))).awaitTermination()
    assert seen == [(1, "unchanged"), (2, "changed"), (3, "new")]
    assert rows(spark.read.parquet(f"{local}/v1"), "segment_id", "tags") == [(1, ["a"]), (2, ["c"]), (3, ["d"])]
    queue = spark.readStream.schema("segment_id int, last_modified long, tags array<string>").parquet(str(tmp_path / "in"))
    feeds.drain_queue(queue, lambda b: b.select("segment_id", (F.col("segment_id") > 1).alias("succeeded")), str(tmp_path / "done"), str(tmp_path / "cp2")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "done")), "segment_id") == [(2,), (3,)]


def test_state(spark):
    df = spark.createDataFrame([("P", True, True, False), ("C", True, False, False), ("C", True, False, True), ("P", False, True, False)], "s string, r boolean, ok boolean, f boolean")
    got = [r["v"] for r in df.select(state.next_state(F.col("s"), F.col("r"), F.col("ok"), F.col("f")).alias("v")).collect()]
    assert got == ["C", "C", "F", "P"]
