"""N-gram Jaccard self-join by rare-first prefix filtering, and the groups of linked documents.

1. Each document becomes a set of word-shingle hashes. Documents with equal sets are one class; only classes go on.
2. A count-min table of all documents' shingles (fixed size) orders shingles from rare to frequent; any order that all
   documents share keeps the filter exact. Each class gives its first n - ceil(t * n) + 1 shingles: linked sets share one.
3. Rows meet by shingle, sorted, in a stream. Pairs must pass the length filter, the positional filter and a suffix filter
   (counts by eighths of the hash space bound the sets' difference). A shingle of at most SMALL classes gives all pairs; a
   larger one gives each class with the class in which it comes first, which for near copies is the least changed one.
4. Each pair is verified once on whole sets, made anew from the texts of the two classes. Linked classes are united by contraction.
5. Classes that meet in a large shingle's bucket but are still in different groups are then paired exhaustively (outside
   the bucket's main group, against all of the bucket) and verified too: no link between groups is lost.

Defined results: texts that are null, empty or without words have size 0 and are linked with nothing. A text of fewer
words than a shingle is one shingle. Equal texts, repeated rows and ties share a group, named by the least doc_id; null
doc_ids count as greater than all. An empty table gives no rows. Only doc_id and text are read, whatever else there is.

A class is known by 64 bits of its set, checked by 64 others: if two sets ever agree in the first alone, all is done
again under another seed."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import scratch
from storyloom.llm.components import connected_components
from storyloom.llm.textkernel import Words, buffers, merge_tables, mix, shingles, slices, table_parts

#: A bucket of at most so many classes gives all its pairs.
SMALL = 32
#: Cells of the count-min table, 4 bytes each.
CELLS = 1 << 21
#: Bits of the filter of wanted documents; more documents than it can tell apart only mean sets that nobody asks for.
FILTER_BITS = 1 << 26
#: Rows that may be broadcast.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Sets link if 100 * intersection >= percent * union; shingles of `size` words."""

    size: int = 3
    percent: int = 90
    seed: int = 0

    def overlap(self, na, nb):
        """The least intersection that links sets of these sizes."""
        return -((-self.percent * (na + nb)) // (100 + self.percent))

    def prefix(self, n):
        return n + (-self.percent * n) // 100 + 1


def _sets(rule: Rule, column: pa.Array):
    """The sorted set of each text."""
    data, offsets = buffers(column)
    for i, j in slices(offsets):
        hashes, begin = shingles(Words(data, offsets[i : j + 1]), rule.size, rule.seed)
        for k in range(j - i):
            yield np.unique(hashes[begin[k] : begin[k + 1]])


def _class_of(found: np.ndarray) -> tuple[int, int]:
    """Key and check of a set: sums that don't depend on order."""
    a = int(mix(found + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64))
    b = int(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return a - 2**63, b - 2**63


def _cells(found: np.ndarray) -> np.ndarray:
    return (found & np.uint64(CELLS - 1)).astype(np.int64)


def _describe(rule: Rule):
    """Rows of doc_id, size, class; at a task's end its table of counts."""

    def run(batches):
        table, held, waiting, some = np.zeros(CELLS, np.uint32), [], 0, False
        for batch in batches:
            n, key, check = [], [], []
            for found in _sets(rule, batch.column("text")):
                n.append(len(found))
                a, b = _class_of(found) if len(found) else (None, None)
                key.append(a)
                check.append(b)
                held.append(_cells(found))
                waiting += len(found)
                if waiting > CELLS:
                    table += np.bincount(np.concatenate(held), minlength=CELLS).astype(np.uint32)
                    held, waiting = [], 0
            some = some or bool(n)
            none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.int64()), pa.array(check, pa.int64()), *none], names=["doc_id", "n", "key", "check", "part", "cells"])
        if some:
            if held:
                table += np.bincount(np.concatenate(held), minlength=CELLS).astype(np.uint32)
            parts = table_parts(table)
            none = pa.nulls(len(parts), pa.int64())
            yield pa.record_batch([none, none, none, none, *parts.columns], names=["doc_id", "n", "key", "check", "part", "cells"])

    return run


def _eighths(found: np.ndarray) -> int:
    """How many of the set lie in each eighth of the hash space, 255 at most, in one integer."""
    counts = np.diff(np.searchsorted(found, np.arange(1, 8, dtype=np.uint64) << np.uint64(61)), prepend=0, append=len(found))
    return int(np.minimum(counts, 255).astype(np.uint8).view(np.int64)[0])


def _prefixes(rule: Rule, counts):
    """Rows (token, key, at, eighths) of each class's prefix; at: position << 32 | size."""

    def run(batches):
        table, seen = counts.value, set()
        for batch in batches:
            out = [[], [], [], []]
            for found in _sets(rule, batch.column("text")):
                n = len(found)
                if not n or (key := _class_of(found)[0]) in seen:
                    continue
                seen.add(key)
                p = rule.prefix(n)
                count = table[_cells(found)]
                if p < n // 2 > 8:  # those before the p-th least count, and all that tie with it
                    among = np.flatnonzero(count <= np.partition(count, p - 1)[p - 1])
                    first = among[np.argsort(count[among], kind="stable")[:p]]
                else:
                    first = np.argsort(count, kind="stable")[:p]
                out[0].append(found[first].view(np.int64))
                out[1].append(np.full(p, key, np.int64))
                out[2].append((np.arange(p, dtype=np.int64) << 32) | n)
                out[3].append(np.full(p, _eighths(found), np.int64))
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in out], names=["token", "key", "at", "eighths"])

    return run


def _meet(rule: Rule):
    """Rows sorted by token -> pairs (a, b, na, nb), and the rows of large buckets (token, a, na: at, nb: eighths)."""

    def near(x, y, first: bool) -> np.ndarray:
        """The filters over rows x and y of equal tokens. first: only if the token can be the first that they share."""
        nx, ny, px, py = x[2] & 0xFFFFFFFF, y[2] & 0xFFFFFFFF, x[2] >> 32, y[2] >> 32
        need = rule.overlap(nx, ny)
        before = 0 if first else np.minimum(px, py)
        ok = (x[1] != y[1]) & (before + 1 + np.minimum(nx - px, ny - py) - 1 >= need)
        ok &= 100 * np.minimum(nx, ny) >= rule.percent * np.maximum(nx, ny)
        i = np.flatnonzero(ok)
        ex, ey = (np.ascontiguousarray(v[3][i]).view(np.uint8).reshape(-1, 8).astype(np.int16) for v in (x, y))
        i = i[np.abs(ex - ey).sum(axis=1) <= (nx + ny - 2 * need)[i]]
        return i

    def pairs(x, y, i):
        a, b, na, nb = x[1][i], y[1][i], x[2][i] & 0xFFFFFFFF, y[2][i] & 0xFFFFFFFF
        turn = a > b
        none = pa.nulls(len(i), pa.int64())
        return pa.record_batch([none, *(pa.array(v) for v in (np.where(turn, b, a), np.where(turn, a, b), np.where(turn, nb, na), np.where(turn, na, nb)))], names=["token", "a", "b", "na", "nb"])

    def large(rows, hub):
        yield pairs(hub, rows, near(hub, rows, False))
        yield pa.record_batch([pa.array(rows[0]), pa.array(rows[1]), pa.nulls(rows.shape[1], pa.int64()), pa.array(rows[2]), pa.array(rows[3])], names=["token", "a", "b", "na", "nb"])

    def whole(rows):
        """Buckets that are complete."""
        t = rows[0]
        begin = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        size = np.diff(np.r_[begin, len(t)])
        of = np.repeat(np.arange(len(begin)), size)
        big = size[of] > SMALL
        if big.any():
            yield from large(rows[:, big], rows[:, begin[of[big]]])
        rows = rows[:, ~big & (size[of] > 1)]
        for d in range(1, SMALL):
            x, y = rows[:, :-d], rows[:, d:]
            same = np.flatnonzero(x[0] == y[0])
            if not len(same):
                break
            x, y = x[:, same], y[:, same]
            yield pairs(x, y, near(x, y, True))

    def run(batches):
        held, hub, last = np.zeros((4, 0), np.int64), None, None
        for batch in batches:
            rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            again = (rows[0, 1:] == rows[0, :-1]) & (rows[1, 1:] == rows[1, :-1])  # a class that two tasks gave
            rows = rows[:, np.r_[True, ~again][: rows.shape[1]]]
            if hub is not None and rows.shape[1]:
                on = rows[0] == hub[0]
                mine = rows[:, on]
                if mine.shape[1] and last == mine[1, 0]:
                    mine = mine[:, 1:]
                if mine.shape[1]:
                    last = mine[1, -1]
                    yield from large(mine, np.repeat(hub[:, None], mine.shape[1], axis=1))
                rows = rows[:, ~on]
                hub = hub if not rows.shape[1] else None
            if not rows.shape[1]:
                held = rows
                continue
            at = int(np.searchsorted(rows[0] == rows[0, -1], True)) if (rows[0] == rows[0, -1]).all() else int(np.flatnonzero(rows[0] != rows[0, -1])[-1]) + 1
            if at:
                yield from whole(rows[:, :at])
            held = rows[:, at:]
            if held.shape[1] > SMALL:
                hub, last = held[:, 0], held[1, -1]
                yield from large(held, np.repeat(hub[:, None], held.shape[1], axis=1))
                held = held[:, :0]
        if held.shape[1]:
            yield from whole(held)

    return run


def _filter_bits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0xD1B54A32D192ED03))
    return ((h & np.uint64(FILTER_BITS - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)).astype(np.int64))


def _filter_of(ids: DataFrame) -> np.ndarray:
    """Bloom filter of one column of longs, as a bit table."""

    def run(batches):
        table, some = np.zeros(FILTER_BITS // 8, np.uint8), False
        for b in batches:
            for at in _filter_bits(b.column(0).to_numpy()):
                np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
            some = some or len(b) > 0
        if some:
            yield table_parts(table)

    return merge_tables(ids.mapInArrow(run, "part int, cells binary"), np.uint8, np.bitwise_or)


def _texts_of(rule: Rule, wanted):
    """(key, text) of the documents whose ids the filter may hold; texts as lower-cased words with single spaces between,
    which take far less room in a shuffle than the hashes of their shingles."""

    def run(batches):
        bits = wanted.value
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy()
            one, two = _filter_bits(ids)
            hit = np.flatnonzero((bits[one >> 3] >> (one & 7)) & (bits[two >> 3] >> (two & 7)) & 1)
            texts, key, plain = batch.column("text").take(pa.array(hit)), [], []
            for text, s in zip(texts, _sets(rule, texts), strict=True):
                if len(s):
                    key.append(_class_of(s)[0])
                    plain.append(b" ".join(text.as_buffer().to_pybytes().lower().split()))  # of bytes: A-Z and ASCII white space
            yield pa.record_batch([pa.array(key, pa.int64()), pa.array(plain, pa.binary()).cast(pa.string())], names=["key", "found"])

    return run


def _verify(rule: Rule):
    def run(batches):
        for batch in batches:
            ok = []
            for s, t in zip(_sets(rule, batch.column("xs")), _sets(rule, batch.column("ys")), strict=True):
                at = np.searchsorted(s, t)
                at[at == len(s)] = 0
                ok.append(int((s[at] == t).sum()) >= rule.overlap(len(s), len(t)))
            yield pa.record_batch([batch.column("a").filter(pa.array(ok, pa.bool_())), batch.column("b").filter(pa.array(ok, pa.bool_()))], names=["a", "b"])

    return run


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, to be broadcast if it has at most so many rows; else it is joined by shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def _linked(spark: SparkSession, docs: DataFrame, rule: Rule, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets link. Sets are made again for the documents in question only."""
    with scratch.scope(spark) as kept:
        return kept(_checked(spark, docs, rule, classes, pairs))


def _checked(spark: SparkSession, docs: DataFrame, rule: Rule, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    ids = classes.join(keys, "key", "left_semi").select(F.coalesce("doc", F.lit(-1)).alias("doc"))
    wanted = spark.sparkContext.broadcast(_filter_of(ids))
    if not len(wanted.value):
        return scratch.save(spark, pairs.select("a", "b").where("false"), "linked")
    sets = scratch.save(spark, docs.mapInArrow(_texts_of(rule, wanted), "key long, found string"), "texts")
    if not sets.groupBy("key").count().where("count > 1").isEmpty():  # rows that repeat a doc_id, or ids that the filter let through
        sets = sets.groupBy("key").agg(F.first("found").alias("found"))
    x, y = sets.select(F.col("key").alias("a"), F.col("found").alias("xs")), sets.select(F.col("key").alias("b"), F.col("found").alias("ys"))
    return scratch.save(spark, pairs.select("a", "b").join(x, "a").join(y, "b").mapInArrow(_verify(rule), "a long, b long"), "linked")


def _rest(rule: Rule, hot: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs in large buckets whose classes are still in different groups: those outside the bucket's largest group, each
    against the whole bucket, under the same filters."""
    h = hot.join(groups.select(F.col("id").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    main = h.groupBy("token", "root").agg(F.count("*").alias("c")).groupBy("token").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    side = h.join(main, "token").where("root <> main").drop("main")
    x, y = side.select("token", *(F.col(c).alias(f"{c}_x") for c in ("key", "at", "eighths", "root"))), h.select("token", *(F.col(c).alias(f"{c}_y") for c in ("key", "at", "eighths", "root")))
    nx, ny = (F.col(f"at_{s}").bitwiseAND(0xFFFFFFFF) for s in "xy")
    px, py = (F.shiftright(f"at_{s}", 32) for s in "xy")
    need = F.ceil(rule.percent * (nx + ny) / (100 + rule.percent) - 1e-9)
    eighth = lambda s, k: F.shiftright(F.col(f"eighths_{s}"), 8 * k).bitwiseAND(255)
    apart = sum((F.abs(eighth("x", k) - eighth("y", k)) for k in range(8)), F.lit(0))
    met = x.join(y, (x.token == y.token) & (F.col("root_x") != F.col("root_y")) & (100 * F.least(nx, ny) >= rule.percent * F.greatest(nx, ny)) & (F.least(nx - px, ny - py) >= need) & (apart <= nx + ny - 2 * need))
    return met.select(F.least("key_x", "key_y").alias("a"), F.greatest("key_x", "key_y").alias("b")).distinct()


def link_groups(spark: SparkSession, documents: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of documents."""
    scratch.bound_batches(spark)
    with scratch.scope(spark) as kept:
        return kept(scratch.save(spark, _groups(spark, documents, size, percent), "ngram-groups"))


def _groups(spark: SparkSession, documents: DataFrame, size: int, percent: int) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for seed in range(8):
        rule = Rule(size, percent, seed * 0x9E3779B9)
        rows = scratch.save(spark, docs.mapInArrow(_describe(rule), "doc_id long, n long, key long, check long, part int, cells binary"), "described")
        described = rows.where("part is null").select("doc_id", "n", "key", "check")
        classes = described.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc"), F.min("check").alias("low"), F.max("check").alias("high"))
        classes = scratch.save(spark, classes, "classes")
        if classes.where("low <> high").isEmpty():
            break
    counts = merge_tables(rows.where("part is not null").select("part", "cells"), np.uint32)
    if not len(counts):
        return described.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    prefixes = docs.mapInArrow(_prefixes(rule, spark.sparkContext.broadcast(counts)), "token long, key long, at long, eighths long")
    met = prefixes.repartition("token").sortWithinPartitions("token", "at", "key").mapInArrow(_meet(rule), "token long, a long, b long, na long, nb long")
    met = scratch.save(spark, met, "met")
    del prefixes
    scratch.release(spark)
    pairs = scratch.save(spark, met.where("token is null").select("a", "b").distinct(), "pairs")
    links = _linked(spark, docs, rule, classes, pairs)
    groups = connected_components(spark, links, "ngram")
    hot = met.where("token is not null").select("token", F.col("a").alias("key"), F.col("na").alias("at"), F.col("nb").alias("eighths"))
    if not hot.isEmpty():
        rest = scratch.save(spark, _rest(rule, hot, groups).join(pairs, ["a", "b"], "left_anti"), "rest")
        if not rest.isEmpty():
            groups = connected_components(spark, links.union(_linked(spark, docs, rule, classes, rest)), "ngram-all")
    named = classes.select("key", "doc").join(groups.select(F.col("id").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    to = named.join(least, "root").select("key", "component_id")
    return described.join(to, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(spark: SparkSession, documents: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """documents without those whose group has a lesser doc_id, with all columns. Of rows that repeat a doc_id one stays
    if they have words. Rows without doc_id stay, as nothing names them."""
    groups = link_groups(spark, documents, size, percent)
    gone = small(groups.where("doc_id <> component_id").select("doc_id").distinct())
    kept = documents.join(gone, "doc_id", "left_anti").select(documents.columns)
    twice = groups.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if twice.isEmpty():
        return kept
    one = kept.join(small(twice), "doc_id", "left_semi").select(documents.columns)
    one = one.groupBy("doc_id").agg(F.min_by(F.struct("*"), F.coalesce("text", F.lit(""))).alias("r")).select("r.*")
    return kept.join(small(twice), "doc_id", "left_anti").select(documents.columns).unionByName(one)
