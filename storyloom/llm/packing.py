"""Hierarchical packing of documents into sequences of several lengths.

Each task packs the documents of its own input as they stream by: nothing is shuffled, and memory holds a pool of at most
POOL remainders. A document's full windows of the longest tier are sequences of their own. What remains of it is routed
to the least tier that holds it and waits in the pool. The longest remainder opens a window of its tier; shorter ones fill
the gap, best fit first, and where none fits, the first part of one does and the rest of it goes back. So every window is
full: its length is a power of two and it has no padding. What is left at a task's end, less than one window, is cut into
powers of two as well.

A step group is what one training step reads: sequences of one length that come to STEP_TOKENS tokens, whatever the length, so
that all steps cost alike. Groups are closed across tasks: the pieces, which are small rows, are written, the sequences of each
length are numbered over all tasks by prefix sums of the tasks' counts, and cut into groups. Only the last group of a length
may hold fewer tokens.

Sequence ids are unique: the task's partition number, then a count within it. A task that is run again gives the same.

Defined results: a null or empty text has the separator only. Repeated rows are packed as often as they occur. A null
doc_id stays null. An empty table gives no pieces. Only doc_id and text are read, whatever else there is."""

from __future__ import annotations

import bisect
import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm import scratch

TIERS = (1024, 512, 256, 128)
#: Remainders that wait in a task; packing starts here and stops at half.
POOL = 512
#: Tokens of one step group.
STEP_TOKENS = 8192
#: How byte-level BPE of this kind cuts texts before merging; fixed by the vocabulary.
BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, nth long"


class ByteEncoder:
    """Ids as the tokenizers library gives them by a tokenizer file. Where the file is a byte-level BPE whose ids are in the
    order of its merges, texts without special tokens go to the same vocabulary in tiktoken, which is three times as fast;
    that both agree is tried out at the start, and what tiktoken can't do goes to the file's own tokenizer."""

    TRIED = ("The cat's  12 3\n\n x", "a", " \tété übß!?", "I'LL they've", "日本 \U0001f600", "x" * 50 + "   ")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.fast = self._fast(path)
        if self.fast and any(self.fast.encode_ordinary(t) != self._slow(t) for t in self.TRIED):
            self.fast = None

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _fast(path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"].get("type") != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            return None
        import tiktoken

        # Printable Latin-1 characters stand for their own bytes, the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in added}
        return tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.fast and not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
            except (ValueError, RuntimeError):  # its regular expressions gave up
                pass
        return np.array(self._slow(text), np.uint32)


@lru_cache(1)
def encoder_of(path: str) -> ByteEncoder:
    """One a worker."""
    return ByteEncoder(path)


class Packer:
    """The packing of one task; rows() takes what is ready."""

    def __init__(self, partition: int, tiers: tuple[int, ...] = TIERS, pool: int = POOL):
        self.tiers, self.pool_size = sorted(tiers, reverse=True), pool
        self.base, self.made, self.by_tier = partition << 32, 0, dict.fromkeys(tiers, 0)
        self.pool: list[tuple[int, int, tuple]] = []  # tokens, a running number, (doc_id, ids, start, end)
        self.number = 0
        self.out: list[tuple] = []

    def _wait(self, doc, ids, start, end) -> None:
        bisect.insort(self.pool, (end - start, self.number, (doc, ids, start, end)))
        self.number += 1

    def _emit(self, window: list[tuple], tier: int) -> None:
        """A sequence of these pieces, with its number and that among the task's sequences of its length."""
        offset, nth = 0, self.by_tier.get(tier, 0)
        self.by_tier[tier] = nth + 1
        for doc, ids, start, end in window:
            self.out.append((doc, start, end - start, zlib.crc32(ids[start:end].astype("<u4").tobytes()), len(ids), self.base | self.made, offset, tier, nth))
            offset += end - start
        self.made += 1

    def add(self, doc, ids: np.ndarray) -> None:
        longest, start = self.tiers[0], 0
        while len(ids) - start >= longest:
            self._emit([(doc, ids, start, start + longest)], longest)
            start += longest
        if start < len(ids):
            self._wait(doc, ids, start, len(ids))
        if len(self.pool) >= self.pool_size:
            while len(self.pool) > self.pool_size // 2:
                self._window()

    def _window(self) -> None:
        size, _, piece = self.pool.pop()
        tier = min(t for t in self.tiers if t >= size)
        window, gap = [piece], tier - size
        while gap and self.pool:
            at = bisect.bisect_right(self.pool, gap, key=lambda x: x[0])
            if at:
                n, _, fill = self.pool.pop(at - 1)
            else:
                n, (_, _, (doc, ids, start, end)) = gap, self.pool.pop(0)
                fill = (doc, ids, start, start + gap)
                self._wait(doc, ids, start + gap, end)
            window.append(fill)
            gap -= n
        if gap:
            self._powers(window)
        else:
            self._emit(window, tier)

    def _powers(self, window: list[tuple]) -> None:
        """What doesn't fill a window, cut into sequences of powers of two."""
        left = sum(end - start for _, _, start, end in window)
        while left:
            room = size = 1 << (left.bit_length() - 1)
            pieces = []
            while room:
                doc, ids, start, end = window.pop(0)
                n = min(room, end - start)
                pieces.append((doc, ids, start, start + n))
                if start + n < end:
                    window.insert(0, (doc, ids, start + n, end))
                room -= n
            self._emit(pieces, size)
            left -= size

    def finish(self) -> None:
        while self.pool:
            self._window()

    def rows(self) -> pa.RecordBatch:
        got, self.out = self.out, []
        columns = list(zip(*got, strict=True)) or [()] * 9
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])


def pack(spark: SparkSession, documents: DataFrame, tokenizer: str, end_id: int = 0, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """The pieces of all documents (doc_id, text): as SCHEMA, but step_group in place of nth. start and length are in the document, offset in
    the sequence."""
    scratch.bound_batches(spark)

    def run(batches):
        context = TaskContext.get()
        packer, encoder = Packer(context.partitionId() if context else 0, tiers), encoder_of(tokenizer)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                packer.add(doc, np.append(encoder.encode(text.as_py()), np.uint32(end_id)))
                if len(packer.out) > 5000:
                    yield packer.rows()
        packer.finish()
        yield packer.rows()

    pieces = scratch.save(spark, documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA), "pieces")
    pieces = pieces.withColumn("task", F.shiftright("sequence_id", 32))
    counts = pieces.groupBy("task", "tier").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("tier").orderBy("task").rowsBetween(Window.unboundedPreceding, 0)
    begin = scratch.save(spark, counts.select("task", "tier", (F.sum("n").over(before) - F.col("n")).alias("begin")), "sequence-counts")
    group = F.floor((F.col("begin") + F.col("nth")) / F.greatest(F.lit(1), F.floor(STEP_TOKENS / F.col("tier"))))
    # Groups of one length have ids in a row; the length's logarithm stands above them.
    pieces = pieces.join(begin, ["task", "tier"]).withColumn("step_group", (F.shiftleft(F.log2("tier").cast("long"), 48) + group).cast("long"))
    return pieces.select(*(x.split()[0] for x in SCHEMA.split(", ")[:-1]), "step_group")
