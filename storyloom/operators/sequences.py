"""Ordered sequences: linking, naming, default times, repair and interpolation, as window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def linked(df: DataFrame, key: str, order: list[str], id_column: str) -> DataFrame:
    """prev_id and next_id in order; 0 at the ends."""
    w = Window.partitionBy(key).orderBy(*order)
    near = lambda f: F.coalesce(f(id_column).over(w), F.lit(0)).cast("bigint")
    return df.withColumns({"prev_id": near(F.lag), "next_id": near(F.lead)})


def ordinal_names(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """A 1-based ordinal per key, and the key's name with it in three digits."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("ordinal", n.cast("bigint")).withColumn("ordinal_name", F.format_string("%s_%03d", F.col(name), F.col("ordinal")))


def default_ends(df: DataFrame, key: str, order: list[str], start: str, unit: int | float = 1) -> DataFrame:
    """A missing end is one unit (a frame) before the next start; the last runs to the end (NULL, runs_to_end)."""
    w = Window.partitionBy(key).orderBy(*order)
    following = F.lead(start).over(w)
    return df.withColumns({"default_end": following - F.lit(unit), "runs_to_end": following.isNull()})


def gap_status(df: DataFrame, key: str, order: list[str], start: str, low: float, high: float) -> DataFrame:
    """What is wrong with the distance to the start before: first, short, long or ok."""
    d = F.col(start) - F.lag(start).over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("gap", F.when(d.isNull(), "first").when(d < low, "short").when(d > high, "long").otherwise("ok"))


def reassigned(df: DataFrame, key: str, seq: str, value: str) -> DataFrame:
    """Values out of order are dealt out again by position: the n-th row gets the n-th value in order (ties as they stood)."""
    by_seq, by_value = Window.partitionBy(key).orderBy(seq), Window.partitionBy(key).orderBy(value, seq)
    n = df.withColumns({"_n": F.row_number().over(by_seq), "_v": F.row_number().over(by_value)})
    return n.drop(value, "_v").join(n.select(key, F.col("_v").alias("_n"), value), [key, "_n"]).drop("_n")


def respread_tail(df: DataFrame, key: str, seq: str, start: str, end: str, duration: str) -> DataFrame:
    """Rows after the last one that ends within the duration share what is left of it, in whole ms; the remainder stays at
    the very end."""
    whole = Window.partitionBy(key)
    good = F.max(F.when(F.col(end) <= F.col(duration), F.col(seq))).over(whole)
    d = df.withColumn("_good", F.coalesce(good, F.lit(-1)))
    tail = F.col(seq) > F.col("_good")
    d = d.withColumns({
        "_from": F.coalesce(F.max(F.when(F.col(seq) == F.col("_good"), F.col(end))).over(whole), F.lit(0)),
        "_count": F.count_if(tail).over(whole),
        "_nth": F.sum(tail.cast("int")).over(whole.orderBy(seq)),
    })
    step = F.expr(f"({duration} - _from) div greatest(_count, 1)")
    return d.withColumns({start: F.when(tail, F.col("_from") + (F.col("_nth") - 1) * step).otherwise(F.col(start)), end: F.when(tail, F.col("_from") + F.col("_nth") * step).otherwise(F.col(end))}).drop("_good", "_from", "_count", "_nth")


def interpolated(df: DataFrame, key: str, seq: list[str], start: str, end: str, known: Column, trailing_limit: int = 3) -> DataFrame:
    """Blocks of rows without times are spread evenly, in whole ms, between the end before and the start after them. A block
    at the very end has no start after it: it collapses onto the end before, and goes if it is longer than the limit."""
    w, back = Window.partitionBy(key).orderBy(*seq), Window.partitionBy(key).orderBy(*(F.col(s).desc() for s in seq))
    d = df.withColumn("_known", known)
    d = d.withColumns({
        "_block": F.sum(F.col("_known").cast("int")).over(w),
        "_before": F.coalesce(F.last(F.when(F.col("_known"), F.col(end)), ignorenulls=True).over(w), F.lit(0)),
        "_after": F.last(F.when(F.col("_known"), F.col(start)), ignorenulls=True).over(back),
    })
    block = Window.partitionBy(key, "_block", "_known")
    d = d.withColumns({"_n": F.count("*").over(block), "_i": F.row_number().over(block.orderBy(*seq)) - 1})
    step = F.expr("(coalesce(_after, _before) - _before) div _n")
    d = d.where(F.col("_known") | F.col("_after").isNotNull() | (F.col("_n") <= trailing_limit))
    spread = lambda c, k: F.when(F.col("_known"), F.col(c)).otherwise(F.col("_before") + (F.col("_i") + k) * step).cast("bigint")
    return d.withColumns({start: spread(start, 0), end: spread(end, 1)}).drop("_known", "_block", "_before", "_after", "_n", "_i")


def speaker_labels(df: DataFrame, key: str, order: list[str], ratio_at_least: float = 4.0, text: str = "text") -> DataFrame:
    """Speakers alternate by row. The one who says less asks: odd rows are speaker 1 if even rows have at least `ratio` times
    their characters (in whole numbers), else speaker 2."""
    w = Window.partitionBy(key).orderBy(*order)
    d = df.withColumn("_i", F.row_number().over(w) - 1)
    whole = Window.partitionBy(key)
    even, odd = (F.coalesce(F.sum(F.when(F.col("_i") % 2 == k, F.length(text))).over(whole), F.lit(0)) for k in (0, 1))
    swapped = F.expr("true") & (F.floor(even / F.greatest(odd, F.lit(1))) >= ratio_at_least)
    return d.withColumn("speaker", (F.when(swapped, (F.col("_i") + 1) % 2).otherwise(F.col("_i") % 2) + 1).cast("bigint")).drop("_i")


def header_changes(df: DataFrame, order: list[str], prefix: Column, key: str | None = None) -> DataFrame:
    """Marks rows whose prefix differs from the row before. Give a key to keep it distributed."""
    w = (Window.partitionBy(key) if key else Window.partitionBy()).orderBy(*order)
    d = df.withColumn("_p", prefix)
    return d.withColumn("is_header", ~F.lag("_p").over(w).eqNullSafe(F.col("_p"))).drop("_p")


def take_while_valid(df: DataFrame, key: str, seq: str, valid: Column) -> DataFrame:
    """Rows before the key's first invalid one."""
    d = df.withColumn("_bad", F.min(F.when(~valid, F.col(seq))).over(Window.partitionBy(key)))
    return d.where(F.col("_bad").isNull() | (F.col(seq) < F.col("_bad"))).drop("_bad")


def all_or_nothing(df: DataFrame, key: str, valid: Column) -> DataFrame:
    """Rows of keys without any invalid row."""
    return df.withColumn("_ok", F.bool_and(valid).over(Window.partitionBy(key))).where("_ok").drop("_ok")


def expanded_to_next(df: DataFrame, key: str, seq: str, begin: str, stop: str) -> DataFrame:
    """Each word's end moves to the next word's beginning (offsets into the text); the last stays."""
    return df.withColumn(stop, F.coalesce(F.lead(begin).over(Window.partitionBy(key).orderBy(seq)), F.col(stop)))
