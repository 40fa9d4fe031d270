"""Benchmark decontamination by edit distance.

Texts are taken as their words (A-Z in lower case) with single spaces between. A document holds an item if some part of it
is within `rate` edits a byte of the whole item.

1. Items are cut into segments of at most SEGMENT words; where a whole item is within the rate, one of its segments is.
   Windows of a segment's size are laid where a document shares an anchor with it, at the segment's beginning as the anchor
   tells it, in words and in bytes. Anchors are pairs of words up to GAPS apart: of a segment's pairs, all that chance would
   seldom bring about by the words' counts in all documents, and in any case its LEAST rarest. Items of fewer than SHORT
   words are anchored by single words, the rarest, so many that as many edits as are allowed leave one of them whole if
   there are that many. Besides, all positions of all texts are looked up among the segments' pieces, which are as many runs of
   at most PIECE bytes, end to end, as a segment has: an edit changes one of them at most, so all but as many as
   the allowed edits stand in any text that is near, at shifts that differ by no more than these. Where that many do, a window is laid at the
   beginning that each of them tells. So each text that is near a segment has a window, whichever words are changed.
2. CGK embedding: a random walk reads a window for three times its length, staying or moving on after each symbol by a
   random bit for (step, symbol), the same for all texts. Texts few edits apart give strings few positions apart.
3. Bit-sampling LSH: WALKS embeddings with REPEATS samples of SAMPLED positions each; a window and an item that agree in
   all positions of any sample go on. With agreement a of an embedding's positions, 1 - (1 - a ** SAMPLED) ** (WALKS * REPEATS)
   of the pairs do: 0.99 at a = 0.5; unrelated texts, which agree in a fifteenth, once in a hundred.
4. The edit distance of the item to the best part of the window (and a margin) is computed exactly, bit-parallel. An edit
   changes GRAM of the item's runs of GRAM characters at most; a window that lacks more of them than that can't be near.

The items are the stated query set: they go to all tasks in blocks of at most BLOCK_BYTES of text, one pass over the
documents for each, and one to count the items' words. Documents are never shuffled. What is lost is what the LSH loses.

Defined results: an item too short for an edit (under 1 / `rate` bytes) is held only where one of its words stands whole. Null or
empty texts hold nothing and no document holds an item that is null or has no words. Items of equal text each count. Repeated rows each have their hits. Empty tables give no
hits. Of the tables only doc_id, item_id and text are read; clean() keeps all columns of documents, whatever their names."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import scratch
from storyloom.llm.textkernel import BASE, PARTS, SPACE, Words, buffers, merge_tables, slices, table_parts

SEGMENT, SHORT, GAPS, LEAST = 256, 8, 3, 32
#: A pair of words that chance brings about at most so often a word of text is an anchor.
SELDOM = 3e-7
#: Characters of the runs that are counted before an edit distance is computed.
GRAM = 3
PIECE = 8
#: Pieces met at once, but in a text of a few segments' size.
MET = 4_000_000
#: Symbols of embeddings that are held at once.
HELD = 16_000_000
WALKS, REPEATS, SAMPLED = 3, 16, 3
BLOCK_BYTES = 8_000_000
HITS_SCHEMA = "doc_id long, item_id long, distance long, item_bytes long, first_word long"
_rng = np.random.Generator(np.random.PCG64(77))
_STEPS = 4096
#: Whether a walk moves on, by step (repeating after _STEPS) and symbol.
_MOVES = _rng.integers(0, 2, (WALKS, _STEPS, 256), dtype=np.uint8)
#: Which positions are sampled, as shares of an embedding's length.
_SAMPLES = _rng.random((WALKS, REPEATS * SAMPLED))


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())  # of bytes, lower() takes A-Z and split() ASCII white space


def embed(data: np.ndarray, start: np.ndarray, end: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """The first `steps` symbols of the embedding of data[start:end], a row each; 0 past the end."""
    out = np.zeros((steps, len(start)), np.uint8)
    at = start.copy()
    for j in range(steps):
        inside = at < end
        if not inside.any():
            break
        symbol = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
        out[j] = symbol
        at += _MOVES[walk, j % _STEPS][symbol]
    return out


def distance(item: bytes, text: bytes, limit: int) -> int:
    """Least edit distance of item to any part of text, if at most limit, else limit + 1 (Myers' bit vectors)."""
    if item in text:
        return 0
    m = len(item)
    peq: dict[int, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full  # any part of the text may be the beginning
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        best = min(best, score)
    return best if best <= limit else limit + 1


def _runs(n: np.ndarray) -> np.ndarray:
    """0 .. n[0] - 1, 0 .. n[1] - 1 and so on."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _values(data: np.ndarray, q: int) -> np.ndarray:
    """The q bytes from each position of data but the last PIECE ones, as one number."""
    x = np.ndarray((len(data) - PIECE,), "<u8", data, strides=(1,))
    return x if q == PIECE else x & np.uint64((1 << (8 * q)) - 1)


def _slot(value: np.ndarray, bits: int) -> np.ndarray:
    return ((value * BASE) >> np.uint64(64 - bits)).view(np.int64)


def grams(text: bytes) -> set[bytes]:
    return {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}


@dataclass
class Items:
    """One block of items: their words, their segments' sampled embeddings, and, once the words' shares of all text are
    known, their anchors."""

    ids: list[int]
    texts: list[bytes]
    rate: float

    def __post_init__(self):
        data, offsets = buffers(pa.array([t.decode() for t in self.texts], pa.large_string()))
        found, count, start = [], [], []
        for i, j in slices(offsets):
            w = Words(data, offsets[i : j + 1])
            found.append(w.hashes())
            count.append(np.diff(w.first))
            start.append(w.start + offsets[i])
        self.vocab, self.word = np.unique(np.concatenate(found), return_inverse=True)
        count, start = np.concatenate(count), np.concatenate(start)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.vocab & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        self.size = np.diff(offsets)
        self.limit = np.floor(self.size * self.rate).astype(np.int64)
        # Segments, of which the last takes what is less than half of one.
        parts = np.maximum(1, (count + SEGMENT // 2) // SEGMENT)
        self.item = np.repeat(np.arange(len(count)), parts)
        nth = _runs(parts)
        first = np.repeat(np.cumsum(count) - count, parts) + nth * SEGMENT
        last = np.where(nth + 1 < parts[self.item], first + SEGMENT, np.repeat(np.cumsum(count), parts))
        self.segment, self.place = np.repeat(np.arange(len(first)), last - first), _runs(last - first)
        self.word_before = first - np.repeat(np.cumsum(count) - count, parts)
        self.byte_before = start[first] - offsets[self.item]
        self.offset = start - np.repeat(start[first], last - first)
        end = np.where(last < len(start), start[np.minimum(last, len(start) - 1)] - 1, offsets[self.item + 1])
        end = np.where(nth + 1 < parts[self.item], end, offsets[self.item + 1])
        self.length, self.words = end - start[first], count
        self.sampled = self._samples(data, start[first], np.arange(len(first)))
        # Pieces. Edits of a segment: if each had more, the whole item, with the spaces between them, would have too many.
        self.edits = np.where(parts[self.item] > 1, np.floor((self.length + 1) * self.rate).astype(np.int64), self.limit[self.item])
        width = np.clip(self.length // (self.edits + 1), 1, PIECE)
        self.whole = np.maximum(self.length // width - self.edits, 1)
        text = np.concatenate([data, np.zeros(PIECE, np.uint8)])
        self.pieces = {}
        for q in np.unique(width).tolist():
            seg = np.flatnonzero(width == q)
            n = self.length[seg] // q
            at, place = np.repeat(seg, n), _runs(n) * q
            value = _values(text, q)[start[first][at] + place]
            order = np.argsort(value, kind="stable")
            bits = min(26, int(16 * len(order)).bit_length())
            maybe = np.zeros(1 << bits, bool)
            maybe[_slot(value, bits)] = True
            self.pieces[q] = value[order], at[order], place[order], bits, maybe

    def anchor(self, counts: np.ndarray, total: int) -> Items:
        """Chooses the anchors by the words' counts in `total` words of text."""
        share, n, rows = counts / max(total, 1), len(self.word), []
        short = self.words[self.item[self.segment]] < SHORT
        for g in range(GAPS + 1):
            i = np.arange(n - g)
            i = i[short] if g == 0 else i[(self.segment[i] == self.segment[i + g]) & ~short[i]]
            a, b = self.word[i], self.word[i + g]
            rows.append((self.segment[i], (a * len(self.vocab) + b) * (GAPS + 1) + g, self.place[i], self.offset[i], share[a] * share[b] if g else share[a]))
        segment, key, place, offset, chance = (np.concatenate(c) for c in zip(*rows, strict=True))
        here = chance > 0  # a word that no text has anchors nothing
        segment, key, place, offset, chance = segment[here], key[here], place[here], offset[here], chance[here]
        order = np.lexsort((chance, segment))
        rank = np.empty(len(order), np.int64)
        rank[order] = _runs(np.bincount(segment, minlength=len(self.item)))
        item = self.item[segment]
        keep = np.where(self.words[item] < SHORT, rank <= 2 * self.limit[item], (chance <= SELDOM) | (rank < LEAST))
        order = np.flatnonzero(keep)[np.argsort(key[keep], kind="stable")]
        self.key, self.at, self.at_place, self.at_offset = key[order], segment[order], place[order], offset[order]
        return self

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number among the items' words, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        i = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocab, hashes[i]), len(self.vocab) - 1)
        same = self.vocab[at] == hashes[i]
        out[i[same]] = at[same]
        return out

    def _samples(self, data: np.ndarray, start: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The sampled symbols of the embeddings of windows of data, each of its segment's size."""
        out = np.zeros((WALKS, len(start), REPEATS * SAMPLED), np.uint8)
        order, k = np.argsort(-self.length[segment], kind="stable"), 0
        while k < len(order):
            steps = int(3 * self.length[segment[order[k]]])
            some = order[k : k + max(1, HELD // max(steps, 1))]
            k += len(some)
            size = self.length[segment[some]]
            for w in range(WALKS):
                symbols = embed(data, start[some], np.minimum(start[some] + size, len(data)), steps, w)
                out[w, some] = symbols[(_SAMPLES[w][None] * (3 * size)[:, None]).astype(np.int64), np.arange(len(some))[:, None]]
        return out

    def similar(self, data: np.ndarray, start: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Which windows of data agree with their segment in a whole sample."""
        ok = np.zeros(len(start), bool)
        for k in range(0, len(start), 16384):
            some = slice(k, k + 16384)
            same = self._samples(data, start[some], segment[some]) == self.sampled[:, segment[some]]
            ok[some] = same.reshape(WALKS, -1, REPEATS, SAMPLED).all(axis=3).any(axis=(0, 2))
        return ok

    def _met(self, words: Words, begin: np.ndarray) -> np.ndarray:
        """Distinct (text, segment, word at which its window begins); begin: where words begin in the normal text."""
        if not len(self.key):
            return np.zeros((0, 3), np.int64)
        number = self.numbers(words.hashes())
        text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        met = []
        for g in range(GAPS + 1):
            i = np.flatnonzero((number[: len(number) - g] >= 0) & (number[g:] >= 0) & (text[: len(text) - g] == text[g:]))
            key = (number[i] * len(self.vocab) + number[i + g]) * (GAPS + 1) + g
            low = np.searchsorted(self.key, key, "left")
            hit = np.flatnonzero(self.key[np.minimum(low, len(self.key) - 1)] == key)
            i, low = i[hit], low[hit]
            n = np.searchsorted(self.key, key[hit], "right") - low
            entry, i = np.repeat(low, n) + _runs(n), np.repeat(i, n)
            first = words.first[text[i]]
            by_words = np.maximum(i - self.at_place[entry], first)
            byte = begin[i] - self.at_offset[entry]
            right = np.clip(np.searchsorted(begin, byte), first, i)
            left = np.maximum(right - 1, first)
            by_bytes = np.where(byte - begin[left] < begin[right] - byte, left, right)
            met += [np.column_stack([text[i], self.at[entry], f]) for f in (by_words, by_bytes)]
        return np.unique(np.concatenate(met), axis=0)

    def _stand(self, data: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Distinct (text, segment, byte at which its window begins) by the pieces of segments that stand in data: normal texts from
        base on, and PIECE bytes more."""
        out = [np.zeros((0, 3), np.int64)]
        for q, (value, at, place, bits, maybe) in self.pieces.items():
            x = _values(data, q)
            i = np.flatnonzero(maybe[_slot(x, bits)])
            low = np.searchsorted(value, x[i], "left")
            same = value[np.minimum(low, len(value) - 1)] == x[i]
            i, low = i[same], low[same]
            n = np.searchsorted(value, x[i], "right") - low
            reach, seg = int((self.length + 2 * self.edits)[at].max()) + 2 * PIECE, len(self.item)
            todo = [(0, len(x))]
            while todo:
                a, b = todo.pop()
                some = slice(*np.searchsorted(i, (a, b + reach)))  # what begins before b ends before b + reach
                if n[some].sum() > MET and b - a > 4 * reach:
                    todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
                    continue
                entry, pos = np.repeat(low[some], n[some]) + _runs(n[some]), np.repeat(i[some], n[some])
                text, piece = np.searchsorted(base, pos, "right") - 1, at[entry]
                begin = pos - place[entry]
                # Shifts of what is near differ by at most the edits, so they share one of two overlapping ranges.
                span = (begin + reach) // (self.edits[piece] + 1)
                group = (text * seg + piece) * (len(data) + 2 * reach) + span
                group, two = np.concatenate([group, group + 1]), np.tile(np.arange(len(pos)), 2)
                for distinct in (False, True):
                    key = group if not distinct else np.unique(np.column_stack([group, entry[two]]), axis=0)[:, 0]
                    have, c = np.unique(key, return_counts=True)
                    where = np.searchsorted(have, group)
                    keep = c[where] >= self.whole[piece[two]]
                    group, two = group[keep], two[keep]
                    if not len(two):
                        break
                two = np.unique(two)
                # Without edits a word has to stand whole: the middle ones of three always do.
                ends = np.minimum(begin[two] + self.length[piece[two]], len(data) - 1)
                bounds = ((data[begin[two] - 1] == 32) | (begin[two] == base[text[two]])).astype(np.int64) + (data[ends] == 32)
                two = two[(self.edits[piece[two]] > 0) | (bounds + self.words[self.item[piece[two]]] >= 3)]
                out.append(np.column_stack([text[two], piece[two], np.maximum(begin[two], base[text[two]])]))
        return np.unique(np.concatenate(out), axis=0)

    def hits(self, column: pa.Array):
        """(row, item, distance, first word) of the texts, once per row and item."""
        data, offsets = buffers(column)
        for i, j in slices(offsets):
            words = Words(data, offsets[i : j + 1])
            size = words.end - words.start
            begin = np.cumsum(size + 1) - size - 1
            if not len(size):
                continue
            # The texts made normal, in a row, each with a space after it.
            data_ = np.full(int(begin[-1] + size[-1]) + 1 + PIECE, 32, np.uint8)
            inside = np.ones(len(data_) - PIECE, bool)
            inside[begin + size] = False
            data_[:-PIECE][inside] = words.data[~SPACE[words.data]]
            base = np.append(begin, len(inside))[words.first]
            met = self._met(words, begin)
            met[:, 2] = begin[met[:, 2]]
            met = np.unique(np.concatenate([met, self._stand(data_, base[:-1])]), axis=0)
            if not len(met):
                continue
            texts = {r: data_[base[r] : base[r + 1] - 1].tobytes() for r in np.unique(met[:, 0]).tolist()}
            place = met[:, 2] - base[met[:, 0]]
            # The word that begins next to the window's beginning.
            right = np.minimum(np.searchsorted(begin, met[:, 2]), words.first[met[:, 0] + 1] - 1)
            left = np.maximum(right - 1, words.first[met[:, 0]])
            met[:, 2] = np.where(np.abs(met[:, 2] - begin[left]) < np.abs(begin[right] - met[:, 2]), left, right)
            near = self.similar(data_, base[met[:, 0]] + place, met[:, 1])
            best: dict[tuple[int, int], tuple[int, int]] = {}
            tried, own = set(), {}
            for (r, m, f), p in zip(met[near].tolist(), place[near].tolist(), strict=True):
                k, s, f = int(self.item[m]), p - int(self.byte_before[m]), max(0, f - int(words.first[r]) - int(self.word_before[m]))
                if best.get((r, k), (1, 0))[0] == 0 or (r, k, s // 16) in tried:
                    continue
                tried.add((r, k, s // 16))
                limit = int(self.limit[k])
                margin = limit + 32
                part = texts[r][max(0, s - margin) : s + int(self.size[k]) + margin]
                if k not in own:
                    own[k] = grams(self.texts[k])
                if len(own[k] - grams(part)) > GRAM * limit:
                    continue
                d = distance(self.texts[k], part, limit)
                if d <= limit and (d, f) < best.get((r, k), (limit + 1, 0)):
                    best[r, k] = d, f
            for (r, k), (d, f) in sorted(best.items()):
                yield i + r, k, d, f


def _counted(items: Items, docs: DataFrame) -> Items:
    """The items with anchors by the counts of their words in all documents."""
    shared, cells = docs.sparkSession.sparkContext.broadcast(items), -(-(len(items.vocab) + 1) // PARTS) * PARTS

    def run(batches):
        table, some = np.zeros(cells, np.int64), False
        for b in batches:
            data, offsets = buffers(b.column("text"))
            for i, j in slices(offsets):
                number = shared.value.numbers(Words(data, offsets[i : j + 1]).hashes())
                table[:-1] += np.bincount(number[number >= 0], minlength=cells - 1)
                table[-1] += len(number)
                some = True
        if some:
            yield table_parts(table)

    table = merge_tables(docs.select("text").mapInArrow(run, "part int, cells binary"), np.int64)
    shared.unpersist()
    return items.anchor(table[: len(items.vocab)], int(table[-1])) if len(table) else items.anchor(np.zeros(len(items.vocab)), 0)


def _blocks(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, rate: float):
    """The items in blocks of a bounded size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect() if n > 1 else items.orderBy("item_id", "text").collect()
        kept = [(r["item_id"], t) for r in rows if (t := normal(r["text"]))]
        if kept:
            yield _counted(Items([i for i, _ in kept], [t for _, t in kept], rate), documents)


def find(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, rate: float = 0.1) -> DataFrame:
    """HITS_SCHEMA: a row for each document and each item that it holds."""
    scratch.bound_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for items in _blocks(spark, docs, benchmark, rate):
        shared = spark.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            items = shared.value
            for b in batches:
                doc = b.column("doc_id").to_pylist()
                out = [(doc[r], items.ids[k], d, int(items.size[k]), f) for r, k, d, f in items.hits(b.column("text"))]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 5)], names=[x.split()[0] for x in HITS_SCHEMA.split(", ")])

        hits = docs.mapInArrow(run, HITS_SCHEMA)
        found = hits if found is None else found.union(hits)
    return found if found is not None else spark.createDataFrame([], HITS_SCHEMA)


def clean(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, rate: float = 0.1) -> DataFrame:
    """documents without those that hold an item, with all columns."""
    scratch.bound_batches(spark)
    for items in _blocks(spark, documents, benchmark, rate):
        shared = spark.sparkContext.broadcast(items)
        named = documents.select(F.struct("*").alias("doc"), F.col("text").alias("text"))

        def run(batches, shared=shared):
            for b in batches:
                keep = np.ones(len(b), bool)
                keep[[r for r, *_ in shared.value.hits(b.column("text"))]] = False
                yield pa.record_batch([b.column("doc").filter(pa.array(keep))], names=["doc"])

        documents = named.mapInArrow(run, named.select("doc").schema).select("doc.*")
    return documents
