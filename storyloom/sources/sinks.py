"""Outputs: nested JSON documents, captions, key-value reports, changed blobs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyloom.functions.scalar import vtt_escaped, vtt_time


def camel(name: str) -> str:
    return re.sub(r"_+([a-zA-Z0-9])", lambda m: m[1].upper(), name[:1].lower() + name[1:])


def _camel_type(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(camel(f.name), _camel_type(f.dataType), f.nullable) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_camel_type(t.elementType), t.containsNull)
    return t


def camel_cased(df: DataFrame) -> DataFrame:
    """The frame with all field names, nested ones too, in camel case."""
    return df.select(*(F.col(f"`{f.name}`").cast(_camel_type(f.dataType)).alias(camel(f.name)) for f in df.schema.fields))


def json_documents(df: DataFrame, key: str) -> DataFrame:
    """(key, content): each row as one JSON document with camel-case keys; nulls are left out."""
    d = camel_cased(df)
    return d.select(F.col(camel(key)).cast("string").alias(key), F.to_json(F.struct("*")).alias("content"))


def write_json(df: DataFrame, path: str) -> None:
    camel_cased(df).write.mode("overwrite").json(path)


def vtt(cues: DataFrame, key: str, seq: str = "seq", start: str = "start", end: str = "end", lines: str = "lines") -> DataFrame:
    """(key, content): the caption file of each key; cues have an array of lines and times in ms."""
    text = F.array_join(F.transform(lines, vtt_escaped), "\n")
    cue = F.concat(vtt_time(F.col(start)), F.lit(" --> "), vtt_time(F.col(end)), F.lit("\n"), text, F.lit("\n"))
    body = F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("seq"), cue.alias("cue")))), lambda x: x["cue"])
    return cues.groupBy(key).agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(body, "\n")).alias("content"))


def tsync(words: DataFrame, key: str, offset: str = "offset_start", time: str = "start") -> DataFrame:
    """(key, sync): offsets into the text with their times, in order."""
    return words.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(offset).alias("offset"), F.col(time).alias("time")))).alias("sync"))


def write_report(df: DataFrame, path: str) -> None:
    """One row of counts as key,value lines."""
    pairs = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in df.columns))).alias("p")).select("p.*")
    pairs.coalesce(1).write.mode("overwrite").csv(path)


def write_blobs(changed: DataFrame, path: str) -> DataFrame:
    """Writes what mutations.changed() found, partitioned by nothing, and gives the manifest rows for it."""
    changed.write.mode("append").parquet(path)
    return changed.select("path", "content_md5")


def replace_table(df: DataFrame, path: str) -> None:
    """Initialises a store anew: what was there goes."""
    df.write.mode("overwrite").parquet(path)
