"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted in numpy over whole Arrow batches. Trees are grown on the driver from a sample of labelled rows,
bounded by TRAIN_ROWS (those with the least hashes of their doc_id, so the sample is the same each time), with features cut
into at most BINS quantile bins; second-order logistic loss, depth-wise. The grown ensemble is flattened to three arrays
(feature, threshold, value) in heap order, which tasks walk for all rows at once.

Defined results: a null or empty text has statistics of zero and a score like any other. A null doc_id isn't held out. Of
several labels of a doc_id the least counts; null labels don't. Without labels, or with one class only, the score is the
share of label 1 (0.5 without any). Repeated rows are scored each; an empty table gives none. Only doc_id and text
of documents, and doc_id and quality of labels, are read, and only the text enters the score."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import scratch
from storyloom.llm.textkernel import Words, buffers, slices

#: Labelled rows to train on, at most.
TRAIN_ROWS = 40_000
BINS = 64
TREES, DEPTH, RATE, MIN_ROWS, L2 = 80, 4, 0.15, 20, 1.0

#: Classes of bytes whose shares are statistics.
CLASSES = ("lower", "upper", "digit", "space", "newline", "end", "comma", "bang", "bar", "symbol", "other_mark", "beyond_ascii")
_CLASS = np.full(256, 10, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10], _CLASS[[46, 63]], _CLASS[[44, 59, 58]], _CLASS[33], _CLASS[124] = 3, 4, 5, 6, 7, 8
_CLASS[[35, 42, 36, 37, 38, 60, 62]], _CLASS[128:] = 9, 11
FEATURES = (*CLASSES, "log_bytes", "log_words", "word_bytes", "word_bytes_sd", "longest_word", "distinct_share", "distinct_root", "top_share", "line_words", "dup_line_share", "repeat_share")


def _groups(first: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text's hashes: how many are distinct, and how often the commonest occurs."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    if not len(h):
        return np.zeros(n), np.zeros(n)
    begin = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])])
    size = np.diff(np.r_[begin, len(h)])
    top = np.zeros(n)
    np.maximum.at(top, r[begin], size)
    return np.bincount(r[begin], minlength=n).astype(float), top


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    data, offsets = buffers(column)
    out = []
    for i, j in slices(offsets):
        at = offsets[i : j + 1]
        n = j - i
        raw = data[at[0] : at[-1]]
        row = np.repeat(np.arange(n), np.diff(at))
        counts = np.bincount(row * len(CLASSES) + _CLASS[raw], minlength=n * len(CLASSES)).reshape(n, len(CLASSES)).astype(float)
        size = np.maximum(np.diff(at), 1)
        words = Words(data, at)
        hashes, length = words.hashes(), (words.end - words.start).astype(float)
        w = np.diff(words.first)
        w1 = np.maximum(w, 1)
        per = lambda x: np.bincount(np.repeat(np.arange(n), w), weights=x, minlength=n)  # noqa: E731, B023
        mean = per(length) / w1
        longest = np.zeros(n)
        np.maximum.at(longest, np.repeat(np.arange(n), w), length)
        distinct, top = _groups(words.first, hashes)
        # Lines: sums of their words' hashes; those without words aren't counted.
        word_row = np.repeat(np.arange(n), w)
        line = np.searchsorted(np.flatnonzero(words.data == 10), words.start) if len(words.start) else np.zeros(0, np.int64)
        starts = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (word_row[1:] != word_row[:-1])]) if len(line) else np.zeros(0, np.int64)
        sums = np.add.reduceat(hashes * (np.arange(len(hashes), dtype=np.uint64) - np.repeat(starts, np.diff(np.r_[starts, len(hashes)])).astype(np.uint64) * np.uint64(1) + np.uint64(3)), starts) if len(starts) else np.zeros(0, np.uint64)
        lines = np.bincount(word_row[starts], minlength=n) if len(starts) else np.zeros(n)
        line_first = np.r_[0, np.cumsum(lines)].astype(np.int64)
        other_lines, _ = _groups(line_first, sums)
        pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
        inner = word_row[:-1] == word_row[1:] if len(word_row) else np.zeros(0, bool)
        n_pairs = np.maximum(w - 1, 0)
        other_pairs, _ = _groups(np.r_[0, np.cumsum(n_pairs)], pairs[inner])
        out.append(np.column_stack([
            counts / size[:, None], np.log1p(np.diff(at)), np.log1p(w), mean, np.sqrt(np.maximum(per(length * length) / w1 - mean * mean, 0)), longest,
            distinct / w1, distinct / np.sqrt(w1), top / w1, w / np.maximum(lines, 1), 1 - other_lines / np.maximum(lines, 1), 1 - other_pairs / np.maximum(n_pairs, 1),
        ]))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


@dataclass
class Trees:
    """The ensemble as arrays (tree, node) in heap order; a leaf above the lowest level passes its value down."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int = DEPTH

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    inner, leaves = 2**depth - 1, 2**depth
    rate = float(y.mean()) if len(y) else 0.5
    none = np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves))
    if not len(y) or not 0 < rate < 1:
        return Trees(float(np.log((rate + 1e-3) / (1 - rate + 1e-3))), *none, depth)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(q, c, "left") for q, c in zip(cuts, x.T, strict=True)])
    total = np.full(len(y), np.log(rate / (1 - rate)))
    forest = [[], [], []]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best, where = np.full(width, 1e-6), np.zeros((width, 2), np.int64)
            for k in range(x.shape[1]):
                key = local * BINS + binned[:, k]
                hist = [np.bincount(key, w, width * BINS).reshape(width, BINS).cumsum(axis=1) for w in (g, h, None)]
                (gl, hl, nl), (gt, ht, nt) = hist, (a[:, -1:] for a in hist)
                gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
                gain[(nl < MIN_ROWS) | (nt - nl < MIN_ROWS)] = -1
                at = gain.argmax(axis=1)
                better = gain[np.arange(width), at] > best
                best[better], where[better] = gain[np.arange(width), at][better], np.column_stack([np.full(width, k), at])[better]
            for m in range(width):
                if best[m] > 1e-6 and where[m, 1] < len(cuts[where[m, 0]]):
                    feature[first + m], threshold[first + m] = where[m, 0], cuts[where[m, 0]][where[m, 1]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + L2)
        total += value[leaf]
        for to, a in zip(forest, (feature, threshold, value), strict=True):
            to.append(a)
    return Trees(float(np.log(rate / (1 - rate))), *map(np.array, forest), depth)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees from labelled documents that aren't held out, `rows` of them at most."""
    scratch.bound_batches(spark)
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    sample = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches):
        for b in batches:
            x = features(b.column("text"))
            yield pa.record_batch([b.column("quality"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], names=["quality", "x"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Of rows that repeat a doc_id one counts, so that what reaches the driver is bounded by the sample.
    known = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))
    got = known.select("text", "quality").mapInArrow(run, "quality int, x array<double>").toArrow()
    if not got.num_rows:
        return grow(np.zeros((0, len(FEATURES))), np.zeros(0))
    x, y = np.array(got.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES)), np.array(got.column("quality"), dtype=float)
    order = np.lexsort(np.column_stack([x, y]).T[::-1])  # the same trees whatever the order of rows
    return grow(x[order], y[order])


def classify(spark: SparkSession, documents: DataFrame, labels: DataFrame, threshold: float = 0.7, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of documents."""
    trees = spark.sparkContext.broadcast(train(spark, documents, labels, rows))

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(trees.value.score(features(b.column("text"))))], names=["doc_id", "held_out", "score"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), "text")
    scored = docs.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
