"""Token ids in length-delimited binary record files, with a separate offset index for shuffled reads.

File format. A shard is a run of frames, each followed by one newline byte (what Spark's text sink ends a row with):

    length   8 bytes, little-endian: bytes of the body
    check    4 bytes: masked CRC-32 of the length's bytes
    body     doc_id (8 bytes, signed; the least value stands for null), then the ids, 2 bytes each if the vocabulary
             fits, else 4; little-endian
    check    4 bytes: masked CRC-32 of the body

A mask (rotate right by 15, add a constant) keeps checksums of data that hold checksums apart. write() puts the shards under
<path>/records and the index as Parquet under <path>/index: shard (file name), offset, bytes, doc_id, start, n_tokens,
ids_crc32. A reader that knows the index opens any record by itself, in any order. Shards are numbered by their part and,
within a part, their file; in this order documents lie in ascending doc_id order (null first; equal ids by a hash of the text).

Texts go to ranges of (doc_id, hash of the text, a salt), whose bounds Spark samples, and are encoded there; so a doc_id that
a third of all rows repeat takes many ranges, and no list of cuts is held by the plan. A shard has at most as many records
as make `shard_mb` at the mean size, a task writes as many as it takes.

Spark's own writer puts the frames, so that a shared store of any kind works and lost tasks are written anew; files are read back
with the binaryFile source. Frames pass through a string column only as bytes. The index is made by reading all shards back
and checking every record.

Defined results: a null or empty text has only the end id. Repeated rows give repeated records. An empty table gives no
records. Only doc_id and text are read, whatever else there is. A shard that comes to over 2 GB (records far beyond the mean
size in a row) can't be read back by this source and raises an error."""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm import scratch

NULL_ID = -(2**63)
MASK_ADD = 0xA282EAD8
#: Distinct words whose ids a worker remembers; beyond that it starts anew. About 250 bytes each.
WORDS_KEPT = 200_000


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_ADD) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    head = struct.pack("<Q", len(body))
    return b"".join((head, struct.pack("<I", masked(head)), body, struct.pack("<I", masked(body))))


def frames(data: bytes):
    """(offset, body) of each record of a shard; raises ValueError on damage."""
    at, n = 0, len(data)
    while at < n:
        head = data[at : at + 8]
        if len(head) < 8 or struct.unpack_from("<I", data, at + 8)[0] != masked(head):
            raise ValueError(f"damaged length at byte {at}")
        size = struct.unpack("<Q", head)[0]
        body = data[at + 12 : at + 12 + size]
        if len(body) < size or struct.unpack_from("<I", data, at + 12 + size)[0] != masked(body) or data[at + 16 + size : at + 17 + size] != b"\n":
            raise ValueError(f"damaged record at byte {at}")
        yield at, body
        at += size + 17


@lru_cache(2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


LETTERS = "".join(chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7))
#: ASCII punctuation but the apostrophe, which may begin a token of its own.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


class WordEncoder:
    """Ids by a tokenizer whose tokens never span white space and don't depend on what stands beside it: each distinct
    word is encoded once, and a text's ids are its words' ids in a row. Such are tokenizers that drop white space; for
    others, per_word=False encodes whole texts.

    A word of Latin letters and, after them, ASCII punctuation other than an apostrophe falls into the two where the
    tokenizer would cut it, if it lower-cases and keeps letters and punctuation apart; that is tried out on words of
    this kind at the start, and else not done. Letters are then lower-cased here and go to the same BPE model in long
    rows without the normaliser, which is most of the cost; the model's end-of-word tokens show where each ends."""

    ROW = 400
    TRIED = ("The", "THATSTOR!!", "\u00c9tre,", "sch\u00f6n.", "x", "\u00d1andu\u00fa***", "tion$$$", "a_b", "\u00dfig)", "rewh\\", "[", "\u00ff|", " a  b. ")

    def __init__(self, path: str, per_word: bool):
        self.tokenizer, self.per_word = _tokenizer(path), per_word
        self.forget()
        self.bare = self._bare() if per_word else None
        if self.bare and any(not np.array_equal(x, y) for x, y in zip(self.encode(self.TRIED), self._whole(self.TRIED), strict=True)):
            self.bare = None
            self.forget()

    def _bare(self):
        from tokenizers import Tokenizer, pre_tokenizers

        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        t = Tokenizer(self.tokenizer.model)
        t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith(suffix)]] = True
        return t

    def forget(self) -> None:
        """Units are words, or the letters (with a space after them) and the punctuation of a word."""
        self.unit: dict[str, int] = {"": 0}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _whole(self, texts) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _keep(self, new: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n = len(self.unit)
        self.unit.update(zip(new, range(n, n + len(new)), strict=True))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        while len(self.unit) > len(self.size):
            self.begin, self.size = np.append(self.begin, np.zeros_like(self.begin)), np.append(self.size, np.zeros_like(self.size))
        self.flat[self.used : self.used + len(ids)] = ids
        self.size[n : n + len(new)] = size
        self.begin[n : n + len(new)] = self.used + np.cumsum(size) - size
        self.used += len(ids)

    def _numbers(self, column: pa.Array, bare: bool) -> np.ndarray:
        """Each word's unit number; new ones are encoded."""
        coded = column.dictionary_encode()
        words, unit = coded.dictionary.to_pylist(), self.unit
        new = [w for w in words if w not in unit]
        if new and bare:
            rows = ["".join(new[k : k + self.ROW]) for k in range(0, len(new), self.ROW)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.bare.encode_batch_fast(rows)])
            self._keep(new, ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1))
        elif new:
            each = self._whole(new)
            self._keep(new, np.concatenate(each), np.array([len(x) for x in each]))
        return np.fromiter(map(unit.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]

    def encode(self, texts) -> list[np.ndarray]:
        if not self.per_word:
            return self._whole(t or "" for t in texts)
        if len(self.unit) > WORDS_KEPT:
            self.forget()
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        split = pc.ascii_split_whitespace(column.cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_string())
        parts = np.zeros((len(words), 2), np.int64)
        plain = np.zeros(len(words), bool)
        if self.bare and len(words):
            stem = pc.utf8_rtrim(words, characters=MARKS)
            plain = pc.match_substring_regex(stem, f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False)
            stem, end = stem.filter(pa.array(plain)), pc.utf8_ltrim(words.filter(pa.array(plain)), characters=LETTERS)
            parts[plain, 0] = self._numbers(pc.binary_join_element_wise(pc.utf8_lower(stem), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())), True)
            parts[plain, 1] = self._numbers(end, False)
        parts[~plain, 0] = self._numbers(words.filter(pa.array(~plain)), False)
        k = parts[coded.indices.to_numpy()].ravel()
        n = self.size[k]
        ends = np.cumsum(n)
        ids = self.flat[np.repeat(self.begin[k] - (ends - n), n) + np.arange(int(n.sum()))]
        count = np.cumsum(pc.list_value_length(split).to_numpy())
        return np.split(ids, np.concatenate([[0], ends])[2 * count][:-1])


@lru_cache(1)
def _encoder(path: str, per_word: bool) -> WordEncoder:
    """One a worker, which keeps its words from task to task."""
    return WordEncoder(path, per_word)


def _encode(path: str, end_id: int, per_word: bool, wide: bool, chunk: int = 1000):
    """doc_id, text -> framed record; rows keep their order."""

    def run(batches):
        encoder = _encoder(path, per_word)
        for batch in batches:
            for i in range(0, len(batch), chunk):
                part, record = batch.slice(i, chunk), []
                for doc, found in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text")), strict=True):
                    found = np.append(found, np.uint32(end_id)).astype("<u4" if wide else "<u2")
                    record.append(frame(struct.pack("<q", NULL_ID if doc is None else doc) + found.tobytes()))
                yield pa.record_batch([pa.array(record, pa.binary())], names=["record"])
                pa.default_memory_pool().release_unused()

    return run


def write(spark: SparkSession, documents: DataFrame, tokenizer: str, end_id: int, path: str, per_word: bool = True, shard_mb: float = 16) -> None:
    """Writes the shards of documents (doc_id, text) and their index under path."""
    scratch.bound_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wide = _is_wide(tokenizer)
    seen = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    # About 3.5 bytes of text a token here; a guess that is off makes shards larger or smaller, no less right.
    shards = max(1, min(seen["n"], round((seen["b"] or 0) / 3.5 * (4 if wide else 2) / (shard_mb * 1e6) + 0.5)))
    order = ["doc_id", "_hash", "_salt"]
    keyed = docs.withColumns({"_hash": F.xxhash64("text"), "_salt": F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))})
    placed = keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    made = placed.mapInArrow(_encode(tokenizer, end_id, per_word, wide), "record binary")
    made.select(F.col("record").cast("string").alias("value")).write.options(compression="none", maxRecordsPerFile=max(1, 2 * seen["n"] // shards)).text(f"{path}/records")
    scratch.release(spark)
    _make_index(spark, path, wide)


@lru_cache(2)
def _is_wide(path: str) -> bool:
    return _tokenizer(path).get_vocab_size(with_added_tokens=True) > 65_536


def _parse(wide: bool):
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                out = [[], [], [], [], []]
                for at, body in frames(data):
                    ids = np.frombuffer(body, "<u4" if wide else "<u2", offset=8).astype("<u4")
                    doc = struct.unpack_from("<q", body)[0]
                    for to, x in zip(out, (at, len(body) + 16, None if doc == NULL_ID else doc, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                        to.append(x)
                n = np.array(out[3], np.int64)
                yield pa.record_batch([pa.array([path] * len(n), pa.string()), *(pa.array(x, pa.int64()) for x in out), pa.array(np.cumsum(n) - n)], names=["shard", "offset", "bytes", "doc_id", "n_tokens", "ids_crc32", "before"])

    return run


def _make_index(spark: SparkSession, path: str, wide: bool) -> None:
    """Only the shards' totals, one row for tens of MB, meet in one window."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records").select(F.regexp_extract("path", "[^/]+$", 0).alias("path"), "content")
    with scratch.scope(spark):
        rows = scratch.save(spark, files.mapInArrow(_parse(wide), "shard string, offset long, bytes long, doc_id long, n_tokens long, ids_crc32 long, before long"), "token-index")
        number = [F.regexp_extract("shard", pattern, 1).cast("long") for pattern in (r"^part-([0-9]+)", r"-c([0-9]+)\.[^.]*$")]
        before = Window.orderBy(*number, "shard").rowsBetween(Window.unboundedPreceding, 0)
        begin = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total")).select("shard", (F.sum("total").over(before) - F.col("total")).alias("begin"))
        rows.join(begin, "shard").select("shard", "offset", "bytes", "doc_id", (F.col("begin") + F.col("before")).alias("start"), "n_tokens", "ids_crc32").write.parquet(f"{path}/index")


def index(spark: SparkSession, path: str) -> DataFrame:
    """The stored index: shard, offset, bytes, doc_id, start (ids of all records before), n_tokens, ids_crc32."""
    return spark.read.schema("shard string, offset long, bytes long, doc_id long, start long, n_tokens long, ids_crc32 long").parquet(f"{path}/index")


def read_record(spark: SparkSession, path: str, shard: str, offset: int, size: int, wide: bool = False) -> tuple[int | None, np.ndarray]:
    """One record by its index entry, as a shuffled reader takes it: (doc_id, ids). Reads these bytes only."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/records/{shard}")
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        stream.seek(offset)
        data = bytes(x & 0xFF for x in stream.readNBytes(size + 1))
    finally:
        stream.close()
    ((_, body),) = frames(data)
    doc = struct.unpack_from("<q", body)[0]
    return (None if doc == NULL_ID else doc), np.frombuffer(body, "<u4" if wide else "<u2", offset=8).astype(np.uint32)


def write_and_read(spark: SparkSession, documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    path = scratch.new_path(spark, "token-records")
    write(spark, documents, tokenizer, end_id, path)
    return index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
