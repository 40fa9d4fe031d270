"""XML documents of the archive: four kinds, told apart by their root element, read and written with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()


def _fields(**kinds) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


_ANNOTATION = _fields(Type=_S, Value=_S)
_ANNOTATIONS = _fields(Annotation=T.ArrayType(_ANNOTATION))
_SESSION = _fields(SessionOrder=_I, InterviewDate=_S, Interviewer=_S, Location=_S, Videographer=_S, Sponsor=_S, SponsorURL=_S)
_SEGMENT = _fields(Title=_S, Abstract=_S, TimeFormat=_S, StartTime=_I, EndTime=_I, Transcript=_fields(Paragraph=T.ArrayType(_S)), Annotations=_ANNOTATIONS)

#: Root element -> schema.
SCHEMAS = {
    "XmlCollection": _fields(
        Accession=_S, DescriptionShort=_S, BiographyShort=_S, FirstName=_S, LastName=_S, PreferredName=_S, Gender=_S, WebsiteURL=_S, Region=_S,
        BirthCity=_S, BirthState=_S, BirthCountry=_S, BirthDate=_S, DeceasedDate=_S,
        Sessions=_fields(Session=T.ArrayType(_SESSION)), Annotations=_ANNOTATIONS, Partitions=_fields(Partition=T.ArrayType(_S)),
    ),
    "XmlMovie": _fields(Collection=_S, SessionOrder=_I, Tape=_I, Path=_S, Abstract=_S, Annotations=_ANNOTATIONS, Segments=_fields(Segment=T.ArrayType(_SEGMENT))),
    "XmlWorld": _fields(Name=_S, Description=_S, Partitions=_fields(Partition=T.ArrayType(_fields(Name=_S, Description=_S)))),
    "XmlAnnotationType": _fields(Name=_S, Scope=_S, Description=_S),
}


def root_elements(spark: SparkSession, path: str) -> DataFrame:
    """(path, root) of each file: the first element's name, without prefix; empty for what isn't XML."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return text.select("path", F.regexp_extract("value", r"(?s)^\s*(?:<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>|\s)*<(?:[\w.-]+:)?([A-Za-z_][\w.-]*)", 1).alias("root"))


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Documents of one kind; files of other kinds give no rows. Lengths are limits that only validation looks at."""
    return spark.read.format("xml").option("rowTag", kind).schema(SCHEMAS[kind]).load(path)


def read_all(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {kind: read(spark, path, kind) for kind in SCHEMAS}


def write(df: DataFrame, path: str, kind: str) -> None:
    """UTF-8 and indented; one root around the rows of each file."""
    df.write.format("xml").option("rowTag", kind).option("rootTag", f"{kind}s").mode("overwrite").save(path)


def segments(movies: DataFrame) -> DataFrame:
    """A row for each segment of the movies, numbered from 1, with its transcript's paragraphs and its annotations."""
    rows = movies.select("Collection", "SessionOrder", "Tape", "Path", F.posexplode("Segments.Segment").alias("n", "s"))
    return rows.select("Collection", "SessionOrder", "Tape", "Path", (F.col("n") + 1).alias("segment_order"), "s.Title", "s.TimeFormat", "s.StartTime", "s.EndTime", F.col("s.Transcript.Paragraph").alias("paragraphs"), F.col("s.Annotations.Annotation").alias("annotations"))


def annotations(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.explode("Annotations.Annotation").alias("a")).select(*keys, F.col("a.Type").alias("type"), F.col("a.Value").alias("value"))
