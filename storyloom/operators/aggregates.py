"""Metrics and folds. Everything aggregates on the map side first; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each table."""
    parts = [df.agg(F.count("*").alias(name)) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))  # single rows
    return out


def media_metrics(df: DataFrame, duration: Column) -> DataFrame:
    """Sum, least, greatest and whole mean of a duration; zeros if there is none."""
    zero = lambda c: F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    return df.agg(zero(F.sum(duration)).alias("total"), zero(F.min(duration)).alias("shortest"), zero(F.max(duration)).alias("longest"), zero(F.floor(F.avg(duration))).alias("average"))


def processing_metrics(states: DataFrame, key: str, name: str, state: str, names: list[str]) -> DataFrame:
    """How many subjects are all complete, and how many have any failed, pending or running task. The last three overlap; a task
    without a row is pending. `total` is their sum, as it is reported."""
    tasks = {n: F.coalesce(F.max(F.when(F.col(name) == n, F.col(state))), F.lit("P")) for n in names}
    wide = states.groupBy(key).agg(*(c.alias(n) for n, c in tasks.items()))
    held = F.array(*names)
    count = lambda c, a: F.count_if(c).alias(a)
    out = wide.agg(count(F.forall(held, lambda x: x == "C"), "complete"), *(count(F.array_contains(held, s), a) for s, a in (("F", "failed"), ("P", "pending"), ("R", "running"))))
    return out.withColumn("total", F.expr("complete + failed + pending + running"))


def corpus_metrics(collections: DataFrame, sessions: DataFrame, stories: DataFrame, tagged: DataFrame, phases: list[str], subset: Column) -> DataFrame:
    """Eight counts in one row: biographies and stories, all and tagged, of the whole corpus and of a subset. A biography counts
    if it has a session of one of the phases; a story if it lies in such a session. collections (collection_id, ...),
    sessions (session_id, collection_id, phase), stories (story_id..., session_id), tagged (session_id, story_no)."""
    live = sessions.where(F.col("phase").isin(phases)).select("session_id", "collection_id")
    tags = tagged.distinct().withColumn("is_tagged", F.lit(True))
    rows = live.join(collections.withColumn("in_subset", subset).select("collection_id", "in_subset"), "collection_id").join(stories, "session_id", "left")
    rows = rows.join(tags, ["session_id", "story_no"], "left")
    per = rows.groupBy("collection_id", "in_subset").agg(F.count("story_no").alias("stories"), F.count_if("is_tagged").alias("tagged_stories"))
    sums = []
    for prefix, cond in (("all", F.lit(True)), ("subset", F.col("in_subset"))):
        sums += [
            F.count_if(cond).alias(f"{prefix}_biographies"),
            F.count_if(cond & (F.col("tagged_stories") > 0)).alias(f"{prefix}_tagged_biographies"),
            F.coalesce(F.sum(F.when(cond, F.col("stories"))), F.lit(0).cast("bigint")).alias(f"{prefix}_stories"),
            F.coalesce(F.sum(F.when(cond, F.col("tagged_stories"))), F.lit(0).cast("bigint")).alias(f"{prefix}_tagged_stories"),
        ]
    return per.agg(*sums)


def fold(df: DataFrame, key: list[str], order: str, confidence: str, keep: list[str]) -> DataFrame:
    """Count and greatest confidence per key, with the first row's other columns."""
    return df.groupBy(*key).agg(F.count("*").alias("n"), F.max(confidence).alias("confidence"), F.min_by(F.struct(*keep), order).alias("_k")).select(*key, "n", "confidence", "_k.*")


def boosted(confidence: Column, n: Column, above: int, ceiling: int | None = None) -> Column:
    """Confidence and one more where the count exceeds `above`, up to the ceiling."""
    more = F.when(n > above, confidence + 1).otherwise(confidence)
    return F.least(more, F.lit(ceiling)) if ceiling is not None else more


def runs(df: DataFrame, key: str, order: list[str], flag: Column) -> DataFrame:
    """Gaps and islands: per key, the flagged rows, and the longest run of them that an unflagged row follows (a run at the
    very end doesn't count for the longest)."""
    w = Window.partitionBy(key).orderBy(*order)
    d = df.select(key, *order, flag.alias("_f")).withColumn("_island", F.sum((~F.col("_f")).cast("int")).over(w))
    islands = d.groupBy(key, "_island").agg(F.count_if("_f").alias("n"))
    last = F.max("_island").over(Window.partitionBy(key))
    islands = islands.withColumn("_last", last)
    return islands.groupBy(key).agg(F.sum("n").alias("flagged"), F.coalesce(F.max(F.when(F.col("_island") < F.col("_last"), F.col("n"))), F.lit(0).cast("bigint")).alias("longest"))


def alternating_lengths(df: DataFrame, key: str, index: str, text: str) -> DataFrame:
    """Characters of even and of odd rows: two speakers who take turns."""
    n = F.length(text).cast("bigint")
    part = lambda odd: F.coalesce(F.sum(F.when(F.col(index) % 2 == odd, n)), F.lit(0).cast("bigint"))
    return df.groupBy(key).agg(part(0).alias("speaker1"), part(1).alias("speaker2"))


def facet(df: DataFrame, key: str, order: Column, value: Column, alias: str) -> DataFrame:
    """Each key's values in an array, in order."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))).alias("_a")).select(key, F.transform("_a", lambda x: x["v"]).alias(alias))


def facet_counts(df: DataFrame, array_column: str, alias: str) -> DataFrame:
    return df.select(F.explode(array_column).alias(alias)).groupBy(alias).agg(F.count("*").alias("n"))


def eav_pivot(df: DataFrame, key: str, attribute: str, value: str, order: str, names: dict[str, str]) -> DataFrame:
    """One column for each named attribute: the last value in order."""
    return df.groupBy(key).agg(*(F.max_by(F.when(F.col(attribute) == a, F.col(value)), F.when(F.col(attribute) == a, F.col(order))).alias(alias) for a, alias in names.items()))


def good_bad_total(df: DataFrame, valid: Column, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.count_if(valid).alias("good"), F.count_if(~valid).alias("bad"), F.count("*").alias("total"))


def extents(df: DataFrame, key: list[str], order: str, start: str, end: str, text: str) -> DataFrame:
    """Start of the first row, end of the last, and the texts in order with spaces between."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), " ")
    return df.groupBy(*key).agg(F.min_by(start, order).alias(start), F.max_by(end, order).alias(end), joined.alias(text)).withColumn("length", F.length(text).cast("bigint"))


def percent(processed: int, total: int) -> int:
    """Whole percent done; nothing to do is done."""
    return 100 * processed // total if total else 100


def remaining_seconds(elapsed: float, processed: int, total: int) -> float | None:
    return elapsed / processed * (total - processed) if processed else None
