"""Other inputs: gazetteers, spreadsheets as CSV, recognizer and aligner output, tag records, listings, office documents."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.operators.joins import first_wins
from storyloom.operators.lookups import missing_columns

ALIGNMENT = "transcript string, words array<struct<case:string,word:string,start:double,end:double,startOffset:int,endOffset:int>>"
TAG_RECORD = "accession string, lastModified bigint, tags array<string>"
PROBE = {"hours": r"Duration: (\d+):\d+:\d+", "minutes": r"Duration: \d+:(\d+):\d+", "seconds": r"Duration: \d+:\d+:(\d+(?:\.\d+)?)", "width": r"Video:.*?\s(\d{2,5})x\d{2,5}", "height": r"Video:.*?\s\d{2,5}x(\d{2,5})", "fps": r"(\d+(?:\.\d+)?) fps"}


def gazetteer(spark: SparkSession, path: str, columns: list[str], key: str | list[str] | None = None, strict: bool = False) -> DataFrame:
    """A tab-delimited file with a header line; rows with another number of fields go. With a key the first row of each
    stays, by line; strict raises on a repeated key instead."""
    text = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n")).alias("seq", "line")).where("seq > 0 and line <> ''")
    parts = text.select("seq", F.split("line", "\t").alias("p")).where(F.size("p") == len(columns))
    rows = parts.select("seq", *(F.get("p", F.lit(i)).alias(c) for i, c in enumerate(columns)))
    if key is None:
        return rows.drop("seq")
    keys = [key] if isinstance(key, str) else key
    if strict and not rows.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated keys in {path}")
    return first_wins(rows, keys, "seq").drop("seq").select(*columns)


def spreadsheet(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A sheet exported as CSV with a header; all its required columns must be there."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    if gone := missing_columns(df, required):
        raise ValueError(f"columns missing: {', '.join(gone)}")
    return df


def _rows(spark: SparkSession, path: str, header: bool) -> DataFrame:
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.posexplode(F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n")).alias("seq", "line"))
    return text.where("seq > 0" if header else "true")


def spacy_rows(spark: SparkSession, path: str) -> DataFrame:
    """path, seq, text, start, end, label, and bad where the offsets are no numbers. Rows without exactly four fields go."""
    d = _rows(spark, path, header=True).withColumn("p", F.split("line", ",")).where(F.size("p") == 4)
    d = d.select("path", "seq", F.col("p")[0].alias("text"), F.col("p")[1].try_cast("int").alias("start"), F.col("p")[2].try_cast("int").alias("end"), F.trim(F.col("p")[3]).alias("label"))
    return d.withColumn("bad", F.col("start").isNull() | F.col("end").isNull())


def stanford_rows(spark: SparkSession, path: str) -> DataFrame:
    """path, seq, token, label of two-field rows."""
    d = _rows(spark, path, header=False).withColumn("p", F.split("line", "\t")).where(F.size("p") == 2)
    return d.select("path", "seq", F.col("p")[0].alias("token"), F.trim(F.col("p")[1]).alias("label"))


def aligned_words(spark: SparkSession, path: str) -> DataFrame:
    """path, seq and the fields of each word of aligner documents; times in whole ms, halves to even."""
    d = spark.read.schema(ALIGNMENT).json(path, multiLine=True).select(F.input_file_name().alias("path"), F.posexplode("words").alias("seq", "w"))
    ms = lambda c: (F.bround(F.col(c).cast("float").cast("double"), 3) * 1000).cast("int")
    return d.select("path", "seq", F.col("w.case").alias("case"), F.col("w.word").alias("word"), ms("w.start").alias("start"), ms("w.end").alias("end"), F.col("w.startOffset").alias("offset_start"), F.col("w.endOffset").alias("offset_end"))


def tag_records(spark: SparkSession, path: str) -> DataFrame:
    """Records keyed by segment, one map a file: segment_id, accession, last_modified, tags."""
    maps = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string, struct<{TAG_RECORD.replace(' ', ':', 1).replace(', lastModified ', ', lastModified:').replace(', tags ', ', tags:')}>>").alias("m"))
    d = maps.select(F.explode("m").alias("segment_id", "r"))
    return d.select(F.col("segment_id").try_cast("int").alias("segment_id"), "r.accession", F.col("r.lastModified").alias("last_modified"), "r.tags")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path: file (name in lower case), path, length. Contents aren't read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return d.withColumn("file", F.lower(F.regexp_extract("path", "([^/]*)$", 1)))


def probed(text: Column) -> Column:
    """Duration in ms, size and frame rate from a media probe's report."""
    v = {k: F.nullif(F.regexp_extract(text, e, 1), F.lit("")) for k, e in PROBE.items()}
    ms = ((v["hours"].cast("int") * 60 + v["minutes"].cast("int")) * 60000 + F.round(v["seconds"].cast("double") * 1000)).cast("int")
    return F.struct(ms.alias("duration"), v["width"].cast("int").alias("width"), v["height"].cast("int").alias("height"), v["fps"].cast("double").alias("fps"))


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx_text(data: bytes) -> str | None:
    """Paragraphs on lines of their own; tabs and no-break spaces are spaces, breaks are newlines."""
    try:
        body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml"))
    except (KeyError, zipfile.BadZipFile, ElementTree.ParseError):
        return None
    out = []
    for p in body.iter(f"{_W}p"):
        text = []
        for e in p.iter():
            if e.tag == f"{_W}t":
                text.append((e.text or "").replace(" ", " ").replace("\t", " "))
            elif e.tag == f"{_W}tab":
                text.append(" ")
            elif e.tag in (f"{_W}br", f"{_W}cr"):
                text.append("\n")
        out.append("".join(text))
    return "\n".join(out)


def documents_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of .docx and .docm files; NULL for what is none. The zip reader has no built-in counterpart."""

    @F.pandas_udf("string")
    def text(content: pd.Series) -> pd.Series:
        return content.map(_docx_text)

    d = spark.read.format("binaryFile").option("pathGlobFilter", "*.doc[xm]").load(path)
    return d.select("path", text("content").alias("value"))


def in_order(df: DataFrame, key: str = "path", seq: str = "seq"):
    """The window over a file's rows."""
    return Window.partitionBy(key).orderBy(seq)
