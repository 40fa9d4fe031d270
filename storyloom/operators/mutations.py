"""Changes of tables as pure functions (old, delta) -> new. The caller swaps the result in; nothing here writes.

Keys are unique in the result. Where a delta repeats a key, the docstring says which row wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one(df: DataFrame, key: list[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*key, "_r.*").select(df.columns)


def insert_if_absent(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows stay; of new ones with a key that isn't there, the least row of a key is added."""
    fresh = new.join(existing.select(*key).distinct(), key, "left_anti").select(existing.columns)
    rest = [c for c in existing.columns if c not in key]
    least = fresh.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(*key, "_r.*").select(existing.columns) if rest else fresh.distinct()
    return existing.unionByName(least)


def insert_set(existing: DataFrame, new: DataFrame) -> DataFrame:
    """A table that is a set of whole rows."""
    return existing.unionByName(new).distinct()


def upsert(existing: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """New rows replace existing ones of the same key; of new rows of a key, the last in order."""
    new = _one(new, key, F.col(order)).select(existing.columns)
    return existing.join(new.select(*key), key, "left_anti").select(existing.columns).unionByName(new)


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    return _one(df, key, F.struct(*order))


def replace_children(existing: DataFrame, new: DataFrame, parent: str, parents: DataFrame | None = None) -> DataFrame:
    """All children of the parents concerned (those of new, or the ones given) go, then the new ones come."""
    gone = (parents if parents is not None else new).select(parent).distinct()
    return existing.join(gone, parent, "left_anti").select(existing.columns).unionByName(new.select(existing.columns))


def update_if_unchanged(existing: DataFrame, new: DataFrame, original: DataFrame, key: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(table, conflicts): new values are taken where the stored ones still are the original ones; other keys conflict."""
    e, o, n = existing, original.select(*key, *(F.col(c).alias(f"_o_{c}") for c in columns)), new.select(*key, *(F.col(c).alias(f"_n_{c}") for c in columns))
    met = e.join(o.join(n, key).withColumn("_asked", F.lit(True)), key, "left")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    asked = F.col("_asked").isNotNull()
    table = met.select(*(F.when(asked & same, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else c for c in e.columns))
    return table, met.where(asked & ~same).select(*key)


def cascade_delete(tables: dict[str, DataFrame], links: list[tuple[str, str, str]], root: str, key: str, ids: DataFrame) -> dict[str, DataFrame]:
    """Deletes rows of `root` with the ids and, along links (child, parent, column), what hangs below them, parents first."""
    doomed = {root: ids.select(key).distinct()}
    out = dict(tables)
    out[root] = tables[root].join(doomed[root], key, "left_anti").select(tables[root].columns)
    for child, parent, column in links:
        gone = doomed[parent].select(F.col(doomed[parent].columns[0]).alias(column))
        table = out[child]
        rows = table.join(gone, column, "left_semi")
        own = table.columns[0]
        doomed[child] = rows.select(own).distinct() if child not in doomed else doomed[child].union(rows.select(own)).distinct()
        out[child] = table.join(gone, column, "left_anti").select(table.columns)
    return out


def dequeue(queue: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return queue.join(done.select(key).distinct(), key, "left_anti").select(queue.columns)


def changed(blobs: DataFrame, manifest: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Blobs whose base64 MD5 differs from the manifest's, or that it lacks: those to be written."""
    digest = F.base64(F.unhex(F.md5(F.col(content).cast("binary"))))
    met = blobs.withColumn("content_md5", digest).join(manifest.select(path, F.col("content_md5").alias("_was")), path, "left")
    return met.where(~F.col("content_md5").eqNullSafe(F.col("_was"))).drop("_was")


def guarded_update(existing: DataFrame, new: DataFrame, key: list[str], columns: list[str], parent: str, locked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table, touched parents): chosen columns are replaced for keys whose parent isn't locked. Parents that got a change are
    to be demoted by the caller."""
    n = new.join(locked.select(parent).distinct(), parent, "left_anti").select(*key, *(F.col(c).alias(f"_n_{c}") for c in columns), F.lit(True).alias("_hit"))
    met = existing.join(n, key, "left")
    table = met.select(*(F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else c for c in existing.columns))
    return table, met.where("_hit").select(parent).distinct()


def propagated_modified(parents: DataFrame, children: DataFrame, key: str, modified: str = "modified") -> DataFrame:
    """A parent is modified when it or any child was."""
    last = children.groupBy(key).agg(F.max(modified).alias("_m"))
    return parents.join(last, key, "left").withColumn(modified, F.greatest(modified, "_m")).drop("_m")


def pk_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once: what a primary key would refuse."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def fk_violations(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key no parent has: what a foreign key would refuse."""
    return df.where(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")
