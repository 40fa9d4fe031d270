"""Tagged plain text: lines that begin with three asterisks name a field, the lines below are its value.

All rules are set operations over exploded lines (path, seq, line): values by forward fill, stories and paragraphs as
islands, brackets by a running sum. A file is one group; nothing is carried from file to file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KINDS = {"***COLLECTION": "collection", "***SESSIONINFO": "session", "***MOVIE": "movie"}
#: Frames a second of the time codes.
FPS = 30


def _by_file(*order: str):
    return Window.partitionBy("path").orderBy(*(order or ("seq",)))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """path, kind (by the first line, NULL if it is none), seq (from 0) and line of each file."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return explode_lines(files)


def explode_lines(files: DataFrame) -> DataFrame:
    """files (path, value) -> path, kind, seq, line."""
    d = files.withColumn("l", F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n"))
    first, kind = F.upper(F.trim(F.get("l", F.lit(0)))), F.lit(None).cast("string")
    for tag, name in KINDS.items():
        kind = F.when(F.startswith(first, F.lit(tag)), name).otherwise(kind)
    return d.select("path", kind.alias("kind"), F.posexplode("l").alias("seq", "line"))


def is_tag(line: Column) -> Column:
    return F.startswith(F.trim(line), F.lit("***"))


def tag_of(line: Column, tags: list[str] | None = None) -> Column:
    """The tag on a line, in upper case: the longest known one that it begins with, or the whole line."""
    text = F.upper(F.trim(line))
    if tags is None:
        return F.when(is_tag(line), text)
    from storyloom.functions.scalar import first_prefix

    return first_prefix(text, [t.upper() for t in tags])


def fields(exploded: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """path, kind, tag, n (its occurrence), value: the lines below each tag line, joined by spaces; blank lines don't count."""
    d = exploded.withColumn("_is", is_tag(F.col("line"))).withColumn("n", F.sum(F.col("_is").cast("int")).over(_by_file()))
    d = d.withColumn("tag", F.last(tag_of(F.when(F.col("_is"), F.col("line")), tags), ignorenulls=True).over(Window.partitionBy("path", "n").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)))
    value = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("_is") & (F.trim("line") != ""), F.struct("seq", F.trim("line").alias("line"))))), lambda x: x["line"]), " ")
    return d.where("n > 0 and tag is not null").groupBy("path", "kind", "n", "tag").agg(value.alias("value"))


def values(exploded: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """path, tag, value: each line below a tag is a value of its own, as multi-value tags have it."""
    d = exploded.withColumn("_tag", F.last(tag_of(F.col("line"), tags), ignorenulls=True).over(_by_file().rowsBetween(Window.unboundedPreceding, 0)))
    return d.where(~is_tag(F.col("line")) & (F.trim("line") != "") & F.col("_tag").isNotNull()).select("path", F.col("_tag").alias("tag"), F.trim("line").alias("value"), "seq")


def missing_tags(found: DataFrame, required: dict[str, list[str]]) -> DataFrame:
    """(path, kind, tag) of the required tags that a file of their kind lacks or leaves empty."""
    rows = [(k, t.upper()) for k, ts in required.items() for t in ts]
    need = found.sparkSession.createDataFrame(rows, "kind string, tag string")
    files = found.select("path", "kind").distinct().join(F.broadcast(need), "kind")
    return files.join(found.where("value <> ''").select("path", "tag").distinct(), ["path", "tag"], "left_anti")


def stories(exploded: DataFrame) -> DataFrame:
    """path, story (from 1), start, end (NULL where none is given), title and transcript paragraphs. Below ***STORY stand the
    start, perhaps an end, then the title; below ***TRANSCRIPT its paragraphs; ***END ends the file."""
    d = exploded.withColumn("_t", F.upper(F.trim("line")))
    d = d.withColumn("story", F.sum(F.startswith("_t", F.lit("***STORY")).cast("int")).over(_by_file())).where("story > 0")
    per = Window.partitionBy("path", "story").orderBy("seq")
    d = d.withColumn("_part", F.last(F.when(F.startswith("_t", F.lit("***STORY")), "head").when(F.startswith("_t", F.lit("***TRANSCRIPT")), "body").when(F.startswith("_t", F.lit("***")), "other"), ignorenulls=True).over(per))
    d = d.where(~F.startswith("_t", F.lit("***")))
    code = F.col("line").rlike(r"^\s*[0-9]{1,3}(:[0-9]{1,2}){2}([:.][0-9]{1,2})?\s*$")
    head = d.where("_part = 'head' and trim(line) <> ''").withColumn("i", F.row_number().over(per)).withColumn("_code", code & (F.col("i") <= 2))
    head = head.groupBy("path", "story").agg(
        F.max(F.when(F.col("_code") & (F.col("i") == 1), F.trim("line"))).alias("start"),
        F.max(F.when(F.col("_code") & (F.col("i") == 2), F.trim("line"))).alias("end"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("_code"), F.struct("seq", F.trim("line").alias("line"))))), lambda x: x["line"]), " ").alias("title"),
    )
    body = paragraphs(d.where("_part = 'body'"), ["path", "story"])
    body = body.groupBy("path", "story").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "paragraph"))), lambda x: x["paragraph"]).alias("paragraphs"))
    return head.join(body, ["path", "story"], "left").withColumn("paragraphs", F.coalesce("paragraphs", F.array().cast("array<string>")))


def paragraphs(exploded: DataFrame, key: list[str]) -> DataFrame:
    """key, n, paragraph: a blank line ends a paragraph, its lines are joined by spaces."""
    w = Window.partitionBy(*key).orderBy("seq")
    d = exploded.withColumn("n", F.sum((F.trim("line") == "").cast("int")).over(w)).where(F.trim("line") != "")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.trim("line").alias("line")))), lambda x: x["line"]), " ")
    return d.groupBy(*key, "n").agg(text.alias("paragraph"))


def unbalanced_brackets(exploded: DataFrame) -> DataFrame:
    """Lines at which a bracket closes that isn't open, and the last line of files that leave one open."""
    depth = F.length(F.regexp_replace("line", r"[^\[]", "")) - F.length(F.regexp_replace("line", r"[^\]]", ""))
    d = exploded.withColumn("depth", F.sum(depth).over(_by_file())).withColumn("_last", F.lead("seq").over(_by_file()).isNull())
    return d.where("depth < 0 or (_last and depth <> 0)").select("path", "seq", "line", "depth")


def with_default_ends(found: DataFrame) -> DataFrame:
    """stories() in frames: start_frame, and end_frame, by default one frame before the next start; NULL and to_end for the
    last."""
    from storyloom.functions.timecode import parse

    frames = lambda c: F.round(parse(c) * FPS).cast("bigint")
    d = found.withColumn("start_frame", frames(F.col("start")))
    following = F.lead("start_frame").over(_by_file("story"))
    return d.withColumn("end_frame", F.coalesce(F.when(F.col("end").isNotNull(), frames(F.col("end"))), following - 1)).withColumn("to_end", F.col("end_frame").isNull())


def assemble(collections: DataFrame, sessions: DataFrame, key: str = "accession") -> DataFrame:
    """Collections with their sessions; sessions whose collection isn't among them stand alone, and the other way round."""
    grouped = sessions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*[c for c in sessions.columns if c != key]))).alias("sessions"))
    return collections.join(grouped, key, "full_outer")


def movie_path(accession: Column, file_name: Column) -> Column:
    """Folders by the accession's parts; the file gets the extension flv."""
    return F.concat_ws("/", F.array_join(F.split(accession, "\\."), "/"), F.concat(F.regexp_replace(file_name, r"\.[^.]*$", ""), F.lit(".flv")))
