"""Joins of the archive. Small sides are left to the optimizer's size estimates unless their size is fixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_count(parents: DataFrame, children: DataFrame, key: str, alias: str = "n") -> DataFrame:
    """Each parent with the number of its children. Only children of these parents are counted."""
    counts = children.join(parents.select(key), key, "left_semi").groupBy(key).agg(F.count("*").alias(alias))
    return parents.join(counts, key, "left").withColumn(alias, F.coalesce(alias, F.lit(0).cast("bigint")))


def group_join(parents: DataFrame, children: DataFrame, key: str, item: Column, alias: str = "items") -> DataFrame:
    """Each parent with the sorted array of its children's items; parents without children have an empty one. Children are
    grouped before the join, so parents aren't repeated."""
    grouped = children.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias(alias))
    joined = parents.join(grouped, key, "left")
    return joined.withColumn(alias, F.coalesce(F.col(alias), F.array().cast(grouped.schema[alias].dataType)))


def semi(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def route(kind: Column, routes: dict[str, str], other: str = "unknown") -> Column:
    """Three-way (or any-way) routing of a looked-up kind; a missing kind goes the other way too."""
    out = F.lit(None).cast("string")
    for k, to in routes.items():
        out = F.when(kind == k, F.lit(to)).otherwise(out)
    return F.coalesce(out, F.lit(other))


def complete_dimension(facts: DataFrame, dimension: DataFrame, name: str, id_column: str) -> DataFrame:
    """The dimension with a row for each name that facts use and it lacks; new ids follow the greatest one in order of
    name. Only the missing names meet in one window."""
    new = facts.select(name).where(F.col(name).isNotNull()).distinct().join(dimension, name, "left_anti")
    top = dimension.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top"))
    numbered = new.withColumn("n", F.row_number().over(Window.orderBy(name))).join(F.broadcast(top))
    rows = numbered.select((F.col("top") + F.col("n")).cast(dimension.schema[id_column].dataType).alias(id_column), name)
    return dimension.select(id_column, name).unionByName(rows)


def reconcile(upstream: DataFrame, downstream: DataFrame, key: str, place: str) -> DataFrame:
    """Bucket of each key: matched (same place), elsewhere, missing (upstream only) or unreferenced (downstream only). A
    downstream row is used up by the first upstream row of its key, in order of place; further ones are missing."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(place))
    up, down = (x.select(key, F.col(place).alias(p), nth.alias("nth")) for x, p in ((upstream, "up_place"), (downstream, "down_place")))
    both = up.join(down, [key, "nth"], "full_outer")
    bucket = F.when(F.col("down_place").isNull(), "missing").when(F.col("up_place").isNull(), "unreferenced").when(F.col("up_place") == F.col("down_place"), "matched").otherwise("elsewhere")
    return both.select(key, bucket.alias("bucket"))


def orphans(listing: DataFrame, scopes: dict[str, DataFrame], scope: str = "scope", key: str = "id") -> DataFrame:
    """Listed rows with whether their scope's table knows their key. scopes: scope -> frame of one key column. A scope without a
    table knows nothing."""
    known = None
    for name, keys in scopes.items():
        rows = keys.select(F.lit(name).alias(scope), F.col(keys.columns[0]).cast("string").alias(key)).distinct()
        known = rows if known is None else known.union(rows)
    known = known.withColumn("is_valid", F.lit(True))
    return listing.join(known, [scope, key], "left").withColumn("is_valid", F.coalesce("is_valid", F.lit(False)))


def _celled(df: DataFrame, start: str, end: str, cell: float) -> DataFrame:
    """Each interval once for each cell of the line that it touches."""
    at = lambda c: F.floor(F.col(c) / cell)
    return df.withColumn("_cell", F.explode(F.sequence(at(start), F.greatest(at(start), at(end)))))


def contained_in(points: DataFrame, spans: DataFrame, key: str, start: str, end: str, lower: str, upper: str, cell: float = 60_000) -> DataFrame:
    """Rows whose [start, end] lies within a span [lower, upper] of the same key. Both are joined by key and by the cell of the line in
    which the row starts, so a key's rows meet the spans near them only; `cell` is about a span's usual length."""
    met = points.withColumn("_cell", F.floor(F.col(start) / cell)).join(_celled(spans, lower, upper, cell), [key, "_cell"])
    return met.where((F.col(start) >= F.col(lower)) & (F.col(end) <= F.col(upper))).drop("_cell")


def overlapping(left: DataFrame, right: DataFrame, key: str, s1: str, e1: str, s2: str, e2: str, cell: float = 60_000) -> DataFrame:
    """Pairs of half-open intervals of the same key that overlap, joined by key and cell of the line; a pair counts in the cell of
    the later start."""
    met = _celled(left, s1, e1, cell).join(_celled(right, s2, e2, cell), [key, "_cell"])
    return met.where((F.col(s1) < F.col(e2)) & (F.col(s2) < F.col(e1)) & (F.col("_cell") == F.floor(F.greatest(s1, s2) / cell))).drop("_cell")


def ordinal_zip(left: DataFrame, right: DataFrame, key: str, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows of both sides paired by their position within the key, outer where one side is longer."""
    n = lambda order: F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return left.withColumn("ordinal", n(left_order)).join(right.withColumn("ordinal", n(right_order)), [key, "ordinal"], "full_outer")


def tree_match(published: DataFrame, stored: DataFrame, root: str, path: list[str]) -> DataFrame:
    """Per root: whether both sides have the same keys on the path. Both are compared as sets of paths, so the counts of
    every level agree if they match."""
    columns = [root, *path]
    p, s = (x.select(*columns).distinct().withColumn(f"in_{n}", F.lit(1)) for x, n in ((published, "p"), (stored, "s")))
    met = p.join(s, columns, "full_outer")
    return met.groupBy(root).agg(F.bool_and(F.col("in_p").isNotNull() & F.col("in_s").isNotNull()).alias("matches"))


def densify(subjects: DataFrame, states: DataFrame, key: str, name: str, state: str, names: list[str], default: str) -> DataFrame:
    """One row for each subject and each of a fixed list of names, with the known state or the default. The list is a few
    literals, exploded in place."""
    grid = subjects.select(key).distinct().select(key, F.explode(F.array(*map(F.lit, names))).alias(name))
    return grid.join(states.select(key, name, state), [key, name], "left").withColumn(state, F.coalesce(state, F.lit(default)))


def flatten(documents: DataFrame, *levels: str) -> DataFrame:
    """Chained explode of nested arrays: flatten(df, "sessions", "tapes") leaves a row for each tape, keyed by all above."""
    for level in levels:
        others = [c for c in documents.columns if c != level]
        documents = documents.select(*others, F.explode(level).alias("_x"))
        inner = [f.name for f in documents.schema["_x"].dataType.fields]
        documents = documents.select(*(c for c in others if c not in inner), *(F.col(f"_x.{c}").alias(c) for c in inner))
    return documents


def ranked_lookup(attempts: DataFrame, gazetteer: DataFrame, subject: list[str], candidate: str, rank: str, value: str) -> DataFrame:
    """Multi-attempt lookup: of each subject's candidates the first (least rank) that the gazetteer (candidate, value) knows."""
    hits = attempts.join(gazetteer, candidate)
    return hits.groupBy(*subject).agg(F.min_by(F.struct(F.col(value), F.col(candidate)), F.struct(rank, candidate)).alias("hit")).select(*subject, f"hit.{value}", f"hit.{candidate}")


def first_wins(gazetteer: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """Of rows with the same key the first."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in gazetteer.columns if c not in keys]
    return gazetteer.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def next_within(key: str, start: str, end: str, value: str, limit: int, *ties: str) -> Column:
    """The value of the next row (by start, then `ties`) of the same key if it starts at most `limit` after this one ends."""
    w = Window.partitionBy(key).orderBy(start, *ties)
    return F.when(F.lead(start).over(w) - F.col(end) <= limit, F.lead(value).over(w))


def propagate(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Rows without a value take the first one of their twins (same key)."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(value, F.coalesce(value, F.first(value, ignorenulls=True).over(w)))
