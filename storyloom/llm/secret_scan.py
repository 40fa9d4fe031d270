"""Secret scan: base patterns, and a battery of randomness tests for what they don't name.

Base. assign, access and hex matches, leftmost and not overlapping per kind; matches that fail their length are dropped
without another try. They are always reported.

Battery. Any other run of 16 or more characters of the base-64 alphabet is a candidate. Its encoding is inferred (decimal,
hex, letters of one case, base-32, alphanumeric, base-64, the narrowest that holds it), and three tests take it for
independent uniform draws from that alphabet: chi-squared of the characters' counts, runs above and below the middle of
the alphabet, and serial correlation of neighbours. The least of the three p-values, times three, is how far the candidate
is from random; for a secret it is large.

False-discovery control. What must be bounded is the share of ordinary text among the reports, so the null hypothesis is
ordinary text: what each encoding's alphabet shows of the whole texts, in their order and without candidates, in rows as
long as the candidate. It gives the distribution of the same statistic by encoding and length class (a table of fixed
size over all documents). For hex and base-32 letters of either case count, and white space is the hyphen of base-64. A
candidate's p-value is the share of that null at or above it, with its length setting how small that can get;
Benjamini-Hochberg over the histogram of all candidates' p-values gives the level at which they are reported as `random`.
Texts of more than PIECE bytes give their rows piece by piece, which bounds memory.

Defined results: a null or empty text has no spans. Repeated rows each have theirs; an empty table gives no rows. Spans are
in code points, the end exclusive. Only doc_id and text are read, whatever else there is."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import scratch
from storyloom.llm.textkernel import SPACE, buffers, merge_tables, slices, table_parts

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:(?:w|W)(?:o|O)(?:r|R)(?:d|D)|(?:w|W)(?:d|D))|(?:s|S)(?:e|E)(?:c|C)(?:r|R)(?:e|E)(?:t|T)|(?:t|T)(?:o|O)(?:k|K)(?:e|E)(?:n|N)|(?:a|A)(?:p|P)(?:i|I)_?(?:k|K)(?:e|E)(?:y|Y))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_HINT = re.compile(r"[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")

ALPHABETS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alphanumeric", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "+/-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"),
)
_HELD = [frozenset(a) for _, a in ALPHABETS]
#: Each byte's number in each alphabet; NONE stands for a byte that isn't in it.
NONE = 255
_NUMBER = np.full((len(ALPHABETS), 256), NONE, np.uint8)
for _e, (_, _a) in enumerate(ALPHABETS):
    _NUMBER[_e, np.frombuffer(_a.encode(), np.uint8)] = np.arange(len(_a))
#: The same for ordinary text. HEX shows of it what hex does.
_SHOWN = _NUMBER.copy()
_LOW, _HIGH = np.arange(97, 123), np.arange(65, 91)
HEX, HEX_UPPER, LOWER, BASE32, BASE64 = 1, 2, 3, 4, 6
_SHOWN[HEX, _HIGH], _SHOWN[LOWER, _HIGH], _SHOWN[BASE32, _LOW] = _NUMBER[HEX, _LOW], _NUMBER[LOWER, _LOW], _NUMBER[BASE32, _HIGH]
_SHOWN[BASE64, SPACE] = _NUMBER[BASE64, ord("-")]
SHORTEST, PIECE = 16, 1_000_000
#: Length classes 16-23, 24-31, 32-47, 48-63, 64 and more; bins of the statistic, in steps of its logarithm.
LENGTHS = (16, 24, 32, 48, 64)
BINS = 64
SHAPE = len(ALPHABETS), len(LENGTHS), BINS


def encoding_of(token: str) -> int:
    held = set(token)
    return next(k for k, a in enumerate(_HELD) if held <= a)


def _limits(factor: float) -> np.ndarray:
    """The z from which on factor * erfc(z / sqrt(2)) is at most 2 ** -1, 2 ** -2 and so on."""
    out = []
    for b in range(1, BINS):
        low, high = -10.0, 20.0
        for _ in range(80):
            z = (low + high) / 2
            low, high = (low, z) if factor * math.erfc(z / math.sqrt(2)) <= 2.0**-b else (z, high)
        out.append(high)
    return np.array(out)


#: Three times a p-value, of one side for chi-squared and of both for the others.
_ONE_SIDE, _BOTH_SIDES = _limits(1.5), _limits(3.0)


class Draws:
    """Characters as numbers in an alphabet of k; bins() gives the battery's verdict on any rows of them."""

    def __init__(self, x: np.ndarray, k: int):
        self.x, self.k = x, k
        v = x.astype(np.int64)
        high = 2 * v >= k
        change, product = np.zeros(len(v), bool), np.zeros(len(v), np.int64)
        change[1:] = high[1:] != high[:-1]
        product[1:] = v[1:] * v[:-1]
        self.high, self.sum, self.square, self.change, self.product = (np.concatenate([[0], np.cumsum(a, dtype=np.int64)]) for a in (high, v, v * v, change, product))

    def bins(self, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The bin of three times the least p-value of each row x[start : start + n]. Bin 0 is the most random; the last
        holds all below 2 ** (1 - BINS)."""
        k, m, end = self.k, len(start), start + n
        row = np.repeat(np.arange(m), n)
        at = np.arange(len(row)) + np.repeat(start - (np.cumsum(n) - n), n)
        counts = np.bincount(row * k + self.x[at], minlength=m * k).reshape(m, k)
        chi = np.einsum("ij,ij->i", counts, counts) * (k / n) - n
        # Wilson-Hilferty: the cube root of chi-squared over its degrees of freedom is nearly normal.
        f = k - 1
        out = np.searchsorted(_ONE_SIDE, (np.cbrt(np.maximum(chi, 0) / f) - (1 - 2 / (9 * f))) / math.sqrt(2 / (9 * f)), "right")
        high = self.high[end] - self.high[start]
        runs = 1 + self.change[end] - self.change[start + 1]
        mean = 1 + 2 * high * (n - high) / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        total, first, last = self.sum[end] - self.sum[start], self.x[start].astype(np.int64), self.x[end - 1].astype(np.int64)
        center = total / n
        s = self.square[end] - self.square[start] - n * center**2
        pairs = self.product[end] - self.product[start + 1] - center * (2 * total - first - last) + (n - 1) * center**2
        with np.errstate(divide="ignore", invalid="ignore"):
            z_runs = np.where(var > 0, np.abs(runs - mean) / np.sqrt(np.maximum(var, 0)), 0.0)
            z_serial = np.abs(pairs / s) * np.sqrt(n)
        constant = np.clip(n - 1 - math.log2(3), 0, BINS - 1).astype(np.int64)  # a p-value of 2 ** (1 - n)
        out = np.maximum(out, np.where((high > 0) & (high < n), np.searchsorted(_BOTH_SIDES, z_runs, "right"), constant))
        return np.maximum(out, np.where(s > 1e-9, np.searchsorted(_BOTH_SIDES, z_serial, "right"), constant))


def _length_class(n: int) -> int:
    return max(i for i, low in enumerate(LENGTHS) if n >= low)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches."""
    found = []
    if _ASSIGN_HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list) -> list[tuple[int, int, int]]:
    """(start, end, encoding) of runs outside the base spans."""
    out, k, reach = [], 0, 0
    for m in _RUN.finditer(text):
        a, b = m.span()
        while k < len(base) and base[k][0] < b:
            k, reach = k + 1, max(reach, base[k][2])
        if reach <= a:
            out.append((a, b, encoding_of(m[0])))
    return out


def _found(texts: list) -> tuple[list, list, np.ndarray]:
    """The base spans of each text, its candidates as (text, start, end, encoding), and these candidates' bins."""
    base = [base_spans(t) if t else [] for t in texts]
    found = [(i, *c) for i, t in enumerate(texts) if t for c in candidates(t, base[i])]
    bins = np.zeros(len(found), np.int64)
    encoding = np.array([e for *_, e in found], np.int64)
    for e in np.unique(encoding).tolist():
        rows = np.flatnonzero(encoding == e)
        tokens = [texts[i][a:b].encode() for i, a, b, _ in (found[r] for r in rows.tolist())]
        n = np.array([len(t) for t in tokens])
        draws = Draws(_NUMBER[e, np.frombuffer(b"".join(tokens), np.uint8)], len(ALPHABETS[e][1]))
        bins[rows] = draws.bins(np.cumsum(n) - n, n)
    return base, found, bins


def _ordinary(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> None:
    """Adds the rows of ordinary text to table (encoding, length class, bin). data, offsets: the texts of one slice."""
    inside = _NUMBER[BASE64, data] != NONE
    cut = np.zeros(len(data) + 1, bool)  # where a run may begin or end
    cut[offsets] = True
    cut[1:-1] |= inside[1:] != inside[:-1]
    bounds = np.flatnonzero(cut)
    long_run = (np.diff(bounds) >= SHORTEST) & inside[bounds[:-1]]
    ordinary = ~np.repeat(long_run, np.diff(bounds))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for e, (_, alphabet) in enumerate(ALPHABETS):
        if e == HEX_UPPER:
            continue
        x = _SHOWN[e, data]
        shown = np.flatnonzero((x != NONE) & ordinary)
        if not len(shown):
            continue
        draws = Draws(x[shown], len(alphabet))
        size = np.bincount(text[shown], minlength=len(offsets) - 1)
        first = np.cumsum(size) - size
        for c, n in enumerate(LENGTHS):
            rows = size // n
            start = np.repeat(first - n * (np.cumsum(rows) - rows), rows) + n * np.arange(int(rows.sum()))
            table[e, c] += np.bincount(draws.bins(start, np.full(len(start), n)), minlength=BINS)


def _pieces(offsets: np.ndarray) -> np.ndarray:
    """Offsets of the texts with long ones cut."""
    if np.diff(offsets).max(initial=0) <= PIECE:
        return offsets
    return np.concatenate([*(np.arange(i, max(j, i + 1), PIECE) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)), offsets[-1:]])


def _survey(batches):
    """Counts of the null and of the candidates by encoding, length class and bin; the same text in many documents counts as
    often."""
    table, some = np.zeros((2, *SHAPE), np.int64), False
    for batch in batches:
        some = some or len(batch) > 0
        data, offsets = buffers(batch.column("text"))
        offsets = _pieces(offsets)
        for i, j in slices(offsets):
            if offsets[j] > offsets[i]:
                _ordinary(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], table[0])
        _, found, bins = _found(batch.column("text").to_pylist())
        if found:
            np.add.at(table[1], ([e for *_, e in found], [_length_class(b - a) for _, a, b, _ in found], bins), 1)
    if some:
        flat = np.zeros(-(-table.size // 64) * 64, np.int64)
        flat[: table.size] = table.ravel()
        yield table_parts(flat)


def thresholds(table: np.ndarray, level: float = 0.01) -> np.ndarray:
    """The last bin that is reported, by encoding and length class; -1 reports none. Without rows of the null nothing is."""
    null, seen = table[0].copy(), table[1]
    null[HEX_UPPER] = null[HEX]
    p = (null.cumsum(axis=2) + 1) / (null.sum(axis=2, keepdims=True) + 1)  # share of the null as random or more so
    order = np.argsort(p.ravel(), kind="stable")
    total = seen.sum()
    rank = np.cumsum(seen.ravel()[order])
    good = p.ravel()[order] * total <= level * np.maximum(rank, 1)
    limit = p.ravel()[order][good].max(initial=-1.0)
    return np.where(p <= limit, np.arange(BINS), -1).max(axis=2)


def _report(limits):
    def run(batches):
        last = limits.value
        for batch in batches:
            out = []
            base, found, bins = _found(batch.column("text").to_pylist())
            more = [[] for _ in base]
            for (i, a, b, e), x in zip(found, bins.tolist(), strict=True):
                if x <= last[e, _length_class(b - a)]:
                    more[i].append((a, 3, b))
            write = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
            for doc, own, added in zip(batch.column("doc_id").to_pylist(), base, more, strict=True):
                n = [sum(k == i for _, k, _ in own) for i in range(3)]
                out.append((doc, *n, hashlib.sha256(write(own).encode()).hexdigest(), write([*own, *added]), len(added)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * 7, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return run


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def scan(spark: SparkSession, documents: DataFrame, level: float = 0.01) -> DataFrame:
    """The spans of each document, and how many the battery added."""
    scratch.bound_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = merge_tables(docs.select("text").mapInArrow(_survey, "part int, cells binary"), np.int64)
    size = 2 * math.prod(SHAPE)
    table = table[:size].reshape(2, *SHAPE) if len(table) else np.zeros((2, *SHAPE), np.int64)
    return docs.mapInArrow(_report(spark.sparkContext.broadcast(thresholds(table, level))), SCHEMA)
