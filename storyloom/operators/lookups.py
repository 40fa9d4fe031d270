"""Scans, point lookups and predicates. All of them are plain column expressions, so filters and column lists reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The id that stands for "none" in stored tables.
NULL_ID = 0


def null_id(c: Column | str) -> Column:
    """A stored id, with the sentinel read as NULL."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(NULL_ID))


def point_lookup(df: DataFrame, order_by: str | None = None, **keys) -> DataFrame:
    """The first row whose columns equal the given values. Where several match, order_by says which is first."""
    for k, v in keys.items():
        df = df.where(F.col(k) == F.lit(v))
    return (df.orderBy(order_by) if order_by else df).limit(1)


def ci_lookup(df: DataFrame, column: str, value: str) -> DataFrame:
    """Equality without regard to case, as the stored tables' collation has it."""
    return df.where(F.lower(column) == F.lit(value.lower()))


def single(df: DataFrame) -> DataFrame:
    """The only row; an error if there isn't exactly one."""
    n = len(rows := df.limit(2).collect())
    if n != 1:
        raise ValueError(f"expected one row, found {'none' if not n else 'several'}")
    return df.sparkSession.createDataFrame(rows, df.schema)


def one_of(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values))


def half_open(df: DataFrame, column: str, low, high) -> DataFrame:
    """low <= column < high."""
    return df.where((F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high)))


def exists(df: DataFrame, predicate: Column) -> DataFrame:
    """One row: whether any row satisfies the predicate. The scan stops at the first that does."""
    return df.where(predicate).limit(1).agg((F.count("*") > 0).alias("found"))


def all_any(df: DataFrame, key: str, predicate: Column) -> DataFrame:
    """Per key: whether all children satisfy the predicate, and whether any does."""
    return df.groupBy(key).agg(F.bool_and(predicate).alias("all_true"), F.bool_or(predicate).alias("any_true"))


def keep_integers(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Values that parse as integers, parsed; all other rows go."""
    return df.withColumn(alias, F.col(column).try_cast("bigint")).where(F.col(alias).isNotNull())


def within_tolerance(actual: Column, start: Column, end: Column, tolerance_ms: int = 150) -> Column:
    return F.abs(actual - (end - start)) <= tolerance_ms


def bounded_segment(start: Column, end: Column, duration: Column, to_end: Column) -> tuple[Column, Column]:
    """(end, valid): the end is the duration where the segment runs to the end, else at most that; a segment is valid if
    it starts within the duration and ends after it starts."""
    bounded = F.when(to_end, duration).otherwise(F.least(end, duration))
    return bounded, (start <= duration) & (bounded > start)


def page(df: DataFrame, order: list[str], skip: int, top: int) -> DataFrame:
    """Rows skip .. skip + top in a total order."""
    return df.orderBy(*order).offset(skip).limit(top)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns that the frame lacks, in the order required."""
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def truncated(df: DataFrame, column: str, limit: int) -> DataFrame:
    """The column cut to `limit` characters, with a flag where it was."""
    return df.withColumns({f"{column}_cut": F.length(column) > limit, column: F.substring(column, 1, limit)})
