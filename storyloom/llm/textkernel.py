"""Vectorised text kernels over Arrow string columns: word bounds, word hashes and shingle hashes of many texts at once.

A word's hash is a sum of random 64-bit values, one a byte, times powers of an odd number: with running sums each word
costs a few array operations whatever its length. All arithmetic is modulo 2 ** 64 and the same on every machine."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that one call works on, but for a longer text, which is a slice of its own. Memory is about 40 times this.
SLICE_BYTES = 2_000_000

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 4096), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 2 * SLICE_BYTES:
            _powers[int(base)] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words ([^\\x20\\x09-\\x0D]+) of the texts of one slice. start, end: byte bounds; first: where each text's words begin
    (one more entry at the end); data: the slice's bytes, lower-cased A-Z if asked."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.data = LOWER[data[offsets[0] : offsets[-1]]] if lower else data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        n = len(self.data)
        solid = ~SPACE[self.data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        begins[inner] = solid[inner]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        ends[inner - 1] = solid[inner - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUE[self.data] * _power(BASE, n + 1)[:n], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * _power(BASE_INVERSE, n + 1)[self.start])


_TURN = [np.uint64(x | 1) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingles(words: Words, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of `size` words, text after text, and where each text's begin (one more entry at the end).
    A text with fewer words, but one at least, has its whole sequence as its only shingle; a text without words none."""
    h = words.hashes() ^ np.uint64(seed)
    first, count = words.first[:-1], np.diff(words.first)
    total = np.zeros(max(0, len(h) - size + 1), dtype=np.uint64)
    for k in range(size):
        total += h[k : k + len(total)] * _TURN[k]
    total = mix(total + np.uint64(size))
    full = np.maximum(count - size + 1, 0)
    each = np.where((count > 0) & (full == 0), 1, full)
    begin = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(each, out=begin[1:])
    out = np.empty(begin[-1], dtype=np.uint64)
    row = np.repeat(np.arange(len(count)), full)
    at = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
    out[begin[row] + at] = total[first[row] + at]
    for i in np.flatnonzero((count > 0) & (full == 0)):
        short = np.uint64(count[i])
        for k in range(count[i]):
            short = short + h[first[i] + k : first[i] + k + 1] * _TURN[k]
        out[begin[i]] = mix(short)[0]
    return out, begin


# Dense tables of a fixed size, summed over all tasks: each task gives its table in parts, each part is summed up in a
# stream, and the whole table, whose size doesn't depend on the input, goes to the driver.

PARTS = 64


def _packed(x: np.ndarray) -> bytes:
    """The cells byte plane by byte plane, compressed: most cells are small numbers."""
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 1)


def _unpacked(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def table_parts(values: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"part": pa.array(range(PARTS), pa.int32()), "cells": pa.array([_packed(x) for x in np.split(values, PARTS)], pa.binary())})


def merge_tables(parts, dtype, how=np.add) -> np.ndarray:
    """Frame (part int, cells binary) of many tasks' tables -> the merged table, in the driver."""

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for p, cells in zip(b.column("part").to_pylist(), b.column("cells"), strict=True):
                x = _unpacked(cells.as_py(), dtype)
                held[p] = how(held[p], x) if p in held else x
        if held:
            yield pa.record_batch({"part": pa.array(list(held), pa.int32()), "cells": pa.array([_packed(x) for x in held.values()], pa.binary())})

    rows = parts.repartition(PARTS // 4, "part").mapInArrow(merge, "part int, cells binary").collect()
    cells = {r["part"]: bytes(r["cells"]) for r in rows}
    return np.concatenate([_unpacked(cells[p], dtype) for p in range(PARTS)]) if cells else np.zeros(0, dtype)
