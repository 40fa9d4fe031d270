"""Fuzzy line dedup: MinHash signatures of character shingles, banding, exact Jaccard verification, union-find.

Lines are compared without white space at their ends and in lower case; lines without other characters are left alone. All is
done by column functions and joins; nothing runs in Python on the executors. The kernels in numpy below are the same sets,
sizes and comparisons in another form, which the tests hold against the column functions (and plain sets).

1. Equal lines become one, by 128 bits of hashes, with their first place and count. But for these a
   line is named by 64 bits; of different lines with one name, if chance brings that about, one is paired and the others stay.
2. Each gives hashes of all its runs of SHINGLE bytes. In their order, which is the same for all lines, each three in
   a row make a band, BANDS at most: lines whose least hashes agree in a row of three meet. A line that stands in more than SALTED
   places gives them once.
3. Each line is first paired with one other: the first of a band, the one that it meets in most of its bands. As long as this
   unites lines, and HUB_ROUNDS times at most, each group is then paired in the same way with each other group of which it
   meets a first line; only lines in different groups are paired, once.
4. Pairs that can't be similar go (see 5.). Each other is verified once: Jaccard of the sets of all shingles of VERIFY characters at least `similarity`.
5. Contraction unites linked lines. Lines of one band that are still in different groups are then paired as well. In bands of more
   than CROWD lines first with their next neighbour in a shuffled order, of which the likeliest of each group is verified; as long
   as this unites groups, and NEAR_ROUNDS times at most. Then what is still in different groups, exhaustively: all
   with all in bands of at most MIDDLE lines, once for each pair; lines of larger bands where they share one of the rare shingles
   that any similar pair must share (prefix, length and positional filters). Only pairs go on whose sets' parities, in 64 * CELLS classes of
   shingles, differ in no more classes than the sets of a similar pair can differ in shingles, which loses none. Of these pairs the likeliest of each group is verified
   first, then the likeliest of each two groups, then all that are still between two groups. No link within a band
   that would unite groups is lost.
6. Of each group the first line by (doc_id, hash of the text, line number) stays.

No join but one has a hint: what is broadcast is for the session's threshold in bytes to say. The exception is a table of 8 MB at most, whatever the input.

Defined results: null and empty texts have no lines to drop. A null doc_id comes before all others. Rows that share a doc_id, or
have none, are told apart by their texts; rows that repeat a doc_id and text keep and lose the same lines. Lines of one
character count as any other. An empty table gives no rows. Only doc_id and text are read; drop_lines() keeps all columns
of documents, whatever their names, and counts n_chars anew where a line goes. A text whose lines all go is empty, not gone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm import scratch
from storyloom.llm.components import connected_components
from storyloom.llm.textkernel import BASE, buffers, mix, slices

SHINGLE, VERIFY, BANDS = 8, 5, 12
WHITE = " \t\n\x0b\x0c\r"
#: Stands for a null doc_id where one must be compared.
NULL_ID = -(2**63)
#: Hashes of texts, as far as they tell rows of one doc_id apart in a line's place.
TEXT_SPAN = 1 << 26
#: A band of at most so many lines gives all pairs that are in different groups; one of up to MIDDLE those that share no lesser such band.
SMALL, MIDDLE = 64, 2048
#: Bits of the table that tells which lines may meet others.
MARKS = 1 << 26
#: Rounds of pairs with the first lines of bands, before all lines that share a band are compared.
HUB_ROUNDS = 4
#: Lines of a band up to which all are paired with all at once, and rounds of pairs with neighbours in larger ones before that.
CROWD, NEAR_ROUNDS = 8, 3
#: Neighbours of a line in one round, in bands of more than SMALL lines.
NEXT = 4
#: Lines with one shingle that meet in one task, and places of a line that are hashed and sent one by one.
SALTED = 1000
BITS = 512
_WORDS = BITS // 64
#: Words of parities in the columns' description of a line, with a class of shingles for each bit.
CELLS = 16
#: Bits of a hash beside the number of its line or pair in one sortable number.
_LOW = 40
_SET_LOW, _SET_PAIRS = 52, 4096
#: Bytes of lines that are hashed at once: what numpy holds of them stays in a core's cache.
SLICE = 200_000
#: Random values of the characters of the basic plane; others are mixed as they come.
CHAR_VALUE = mix(np.arange(1, 65537, dtype=np.uint64))


def normal(line: Column) -> Column:
    """The line in lower case, without white space at its ends. Trimming spaces looks at the ends alone; trimming a set of characters walks
    the whole line, so it is left to lines that have another one there."""
    t = F.trim(line)
    other = F.lit(False)
    for c in WHITE[1:]:
        other = other | F.startswith(t, F.lit(c)) | F.endswith(t, F.lit(c))
    return F.lower(F.when(other, F.btrim(line, F.lit(WHITE))).otherwise(t))


def _polynomial(v: np.ndarray, size: int) -> np.ndarray:
    """Of each run of so many values, their sum times falling powers of BASE; runs grow by doubling and by one."""
    total, have = v, 1
    for bit in f"{size:b}"[1:]:
        total = total[:-have] * np.uint64(pow(int(BASE), have, 2**64)) + total[have:]
        have *= 2
        if bit == "1":
            total = total[:-1] * BASE + v[have:]
            have += 1
    return total


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of so many characters, with repetitions, line after line, and how many each line has; a shorter
    line is one."""
    raw = data[offsets[0] : offsets[-1]]
    chars = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    begin = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets - offsets[0]]
    length = np.diff(begin)
    room = np.maximum(length, size)
    first = np.cumsum(room) - room
    v = CHAR_VALUE[chars] if not len(chars) or chars.max() < len(CHAR_VALUE) else mix(chars.astype(np.uint64) + np.uint64(1))
    if (room != length).any():
        wide = np.zeros(int(room.sum()), np.uint64)
        wide[np.arange(len(chars)) + np.repeat(first - begin[:-1], length)] = v
        v = wide
    total = _polynomial(v, size)
    whole = np.ones(len(total), bool)  # but for runs that reach into the next line
    for k in range(1, size):
        whole[first[1:] - k] = False
    return mix(total[whole]), room - size + 1


def bands(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bands of the lines of one slice, and each band's line."""
    h, count = shingles(data, offsets, SHINGLE)
    low, line, wide = h >> np.uint64(64 - _LOW), np.repeat(np.arange(len(count), dtype=np.uint64), count), BANDS + 2

    def least(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.sort((line[some] << np.uint64(_LOW)) | low[some])
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        return key, np.bincount((key >> np.uint64(_LOW)).astype(np.int64), minlength=len(count))

    # The least distinct hashes are among those below a bound, unless these repeat each other or are few by chance.
    bound = (np.minimum(3.0 * wide / np.maximum(count, 1), 1.0) * 2.0**_LOW).astype(np.uint64)
    below = low < np.repeat(bound, count)
    key, n = least(below)
    if (few := (n < wide) & (count > 3 * wide)).any():
        key, n = least(below | np.repeat(few, count))
    size, first, low_bits = np.minimum(n, wide)[:, None], (np.cumsum(n) - n)[:, None], np.uint64(2**_LOW - 1)
    at = np.arange(BANDS)
    band = np.zeros((len(count), BANDS), np.uint64)
    for j in range(3):
        band = mix(band * BASE + (key[first + (at + j) % size] & low_bits))
    has = at < size
    return band[has] >> np.uint64(64 - _LOW), np.nonzero(has)[0]  # what meets by chance is verified away; zeros shrink in the shuffle


def _distinct(h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each line's distinct hashes below its number, sorted, and how many they are; at most _SET_PAIRS lines."""
    key = np.sort((np.repeat(np.arange(len(count), dtype=np.uint64), count) << np.uint64(_SET_LOW)) | (h >> np.uint64(64 - _SET_LOW)))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key, np.bincount((key >> np.uint64(_SET_LOW)).astype(np.int64), minlength=len(count))


def _few(offsets: np.ndarray):
    """Ranges of rows of a slice, and of at most _SET_PAIRS."""
    for i, j in slices(offsets, SLICE):
        for k in range(i, j, _SET_PAIRS):
            yield k, min(j, k + _SET_PAIRS)


def _compare(similarity: float):
    def run(batches):
        for b in batches:
            (dx, ox), (dy, oy) = (buffers(b.column(c)) for c in "xy")
            for i, j in _few(ox + oy):
                (kx, nx), (ky, ny) = (_distinct(*shingles(d, o[i : j + 1], VERIFY)) for d, o in ((dx, ox), (dy, oy)))
                both = np.sort(np.concatenate([kx, ky]))
                both = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(_SET_LOW)).astype(np.int64), minlength=j - i)
                good = pa.array(both >= similarity * (nx + ny - both))
                yield pa.record_batch({c: b.column(c).slice(i, j - i).filter(good) for c in "ab"})

    return run


def _describe(batches):
    """id, n (distinct shingles) and the parities of their classes."""
    for b in batches:
        data, offsets = buffers(b.column("line"))
        for i, j in _few(offsets):
            key, n = _distinct(*shingles(data, offsets[i : j + 1], VERIFY))
            line = (key >> np.uint64(_SET_LOW)).astype(np.int64)
            odd = np.bincount(line * BITS + (key & np.uint64(BITS - 1)).astype(np.int64), minlength=(j - i) * BITS) & 1
            words = np.packbits(odd.astype(np.uint8).reshape(j - i, BITS), axis=1).view(np.int64)
            yield pa.record_batch({"id": b.column("id").slice(i, j - i), "n": pa.array(n), **{f"b{k}": pa.array(np.ascontiguousarray(words[:, k])) for k in range(_WORDS)}})


def runs(line: Column, size: int, encoded: bool = False) -> Column:
    """Hashes of all runs of so many bytes, or characters if the line is to be encoded; a shorter line is one."""
    # The bytes are bound as an array's only element, so that they are made once and not for each run.
    data, wide = (F.encode(line, "UTF-32"), 4) if encoded else (line.cast("binary"), 1)
    last = lambda b: F.greatest(F.octet_length(b) - (size * wide - 1), F.lit(1))
    each = lambda b: F.transform(F.sequence(F.lit(1), last(b), F.lit(wide)), lambda i: F.xxhash64(F.substr(b, i, F.lit(size * wide))))
    return F.get(F.transform(F.array(data), each), F.lit(0))


def tokens(line: Column) -> Column:
    """Hashes of all shingles of VERIFY characters, with repetitions; a shorter line is one."""
    return runs(line, VERIFY, encoded=True)


def similar(x: Column, y: Column, similarity: float, nx: Column | None = None, ny: Column | None = None) -> Column:
    """Whether two lines are, by their sets and the sizes of these, if known."""
    nx, ny = (F.size(F.array_distinct(tokens(c))) if n is None else n for c, n in ((x, nx), (y, ny)))
    both = F.size(F.array_intersect(tokens(x), tokens(y)))
    return (1 + similarity) * both >= similarity * (nx + ny) - 1e-9


def described(lines: DataFrame) -> DataFrame:
    """Of id and line: id, n (distinct shingles) and the parities of their classes."""
    rows = lines.select("id", F.explode(F.array_distinct(tokens(F.col("line")))).alias("t"))
    bit = F.expr("shiftleft(1L, cast(t & 63 as int))")
    word = F.expr(f"shiftrightunsigned(t, 6) & {CELLS - 1}")
    return rows.select("id", word.alias("word"), bit.alias("bit")).groupBy("id").agg(
        F.count("*").alias("n"), *(F.expr(f"bit_xor(if(word = {k}, bit, 0L))").alias(f"b{k}") for k in range(CELLS))
    )


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id (not null), text_hash, line_no and line (normal; empty ones too, since a filter here would make each line's normal
    form twice). The text's hash is made below the lines: above them it would be made once a line, of the whole text."""
    rows = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    rows = rows.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.withColumn("line", normal(F.col("line")))


def _place() -> Column:
    """Doc_id, text_hash and line_no of a line in one number, so that aggregates over it stay in their hash map."""
    low = F.shiftleft(F.col("text_hash").bitwiseAND(TEXT_SPAN - 1), 32) + F.col("line_no")
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(TEXT_SPAN << 32).cast("decimal(18,0)") + low.cast("decimal(18,0)")
    return place.cast("decimal(38,0)")


def _hashes() -> list[Column]:
    """128 bits of a line."""
    return [F.xxhash64("line").alias("h"), F.xxhash64(F.lit(7), "line").alias("g")]


def _bands(lines: DataFrame) -> DataFrame:
    """(id, band) of each line (h, line); some repeat."""
    wide = 2 * (BANDS + 2)
    d = lines.select("h", "line", F.sort_array(runs(F.col("line"), SHINGLE)).alias("_all"))
    # The least distinct hashes are among the first ones, unless these repeat each other.
    d = d.withColumn("_m", F.array_distinct(F.slice("_all", 1, wide)))
    whole = (F.size("_m") >= BANDS + 2) | (F.size("_all") <= wide)
    d = d.withColumn("_m", F.slice(F.when(whole, F.col("_m")).otherwise(F.array_distinct("_all")), 1, BANDS + 2))
    m, size = F.col("_m"), F.size("_m")
    # What meets by chance of 40 bits is verified away; zeros shrink in the shuffle.
    # One by one, since Catalyst compiles this and not a function of an array's elements.
    band = lambda i: F.shiftrightunsigned(F.xxhash64(*(F.get(m, F.lit(i + j) % size) for j in range(3))), 64 - _LOW)
    bands = F.slice(F.array(*(band(i) for i in range(BANDS))), 1, F.least(size, F.lit(BANDS)))
    return d.select(F.col("h").alias("id"), F.explode(F.when(F.col("line") != "", bands)).alias("band"))


def _meetings(lines: DataFrame) -> DataFrame:
    """(id, band, hub) of the lines that share a band with others; hub: the first of them."""
    w = Window.partitionBy("band")
    met = _bands(lines).select("id", "band", F.min("id").over(w).alias("hub"), F.max("id").over(w).alias("last"))
    return met.where("hub <> last").select("id", "band", "hub").distinct()


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _candidates(met: DataFrame) -> DataFrame:
    """Pairs (a, b): each line and the hub that it meets in most bands."""
    often = met.where("hub <> id").groupBy("id", "hub").agg(F.count("*").alias("c"))
    return often.groupBy("id").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub")).select(F.col("hub").alias("a"), F.col("id").alias("b"))


def _more_candidates(met: DataFrame, groups: DataFrame, tried: DataFrame) -> DataFrame:
    """Pairs (a, b) not tried yet: of each two groups whose lines and hubs meet, the two that do so in most bands."""
    often = met.where("hub <> id").groupBy("id", "hub").agg(F.count("*").alias("c"))
    often = often.join(tried.select(F.col("a").alias("hub"), F.col("b").alias("id")), ["id", "hub"], "left_anti")
    roots = groups.select("id", F.col("root").alias("x"))
    often = often.join(roots, "id", "left").join(roots.select(F.col("id").alias("hub"), F.col("x").alias("y")), "hub", "left")
    often = often.withColumns({"x": F.coalesce("x", "id"), "y": F.coalesce("y", "hub")}).where("x <> y")
    best = often.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.max_by(F.struct("hub", "id"), F.struct("c", "hub", "id")).alias("p"))
    return best.select(F.col("p.hub").alias("a"), F.col("p.id").alias("b"))


def _apart() -> Column:
    """In how many classes the parities of two described lines (columns with x and y at their ends) are different."""
    return sum((F.bit_count(F.col(f"b{k}x").bitwiseXOR(F.col(f"b{k}y"))) for k in range(1, CELLS)), F.bit_count(F.col("b0x").bitwiseXOR(F.col("b0y"))))


def _may_be_similar(similarity: float) -> Column:
    """Whether the sets of two described lines (columns with x and y at their ends) may be similar: by their sizes and the
    shingles that they don't share, which are at least the classes whose parity is different."""
    sizes = F.least("nx", "ny") >= similarity * F.greatest("nx", "ny") - 1e-9
    return sizes & (_apart() <= (1 - similarity) / (1 + similarity) * (F.col("nx") + F.col("ny")) + 1e-9)


_DESCRIBED = ("n", *(f"b{k}" for k in range(CELLS)))


def _rooted(rows: DataFrame, groups: DataFrame, by: str) -> DataFrame:
    """rows whose root is that of their `by` in groups (id, root), where there is one."""
    to = groups.select(F.col("id").alias(by), F.col("root").alias("_to"))
    return rows.join(to, by, "left").withColumn("root", F.coalesce("_to", "root")).drop("_to")


def _neighbours(spark: SparkSession, lines: Lines, rows: DataFrame, features: DataFrame, similarity: float) -> tuple[DataFrame, list[DataFrame]]:
    """rows (id, band, root, members) with the roots that links with neighbours in crowded bands give, and these links."""
    links = []
    for k in range(NEAR_ROUNDS):
        w = Window.partitionBy("band").orderBy(F.xxhash64(F.lit(k), "id"))
        others = F.array(*(F.lead(F.struct("id", "root"), d).over(w) for d in range(1, NEXT + 1)))
        near = rows.where(f"members > {CROWD}").select("id", "root", F.when(F.col("members") > SMALL, NEXT).otherwise(1).alias("next"), others.alias("others"))
        near = near.select("id", "root", F.explode(F.expr("filter(slice(others, 1, next), o -> o.root <> root)")).alias("other"))
        near = near.select(F.col("id").alias("idx"), F.col("root").alias("rootx"), F.col("other.id").alias("idy"), F.col("other.root").alias("rooty")).distinct()
        for end in "xy":
            near = near.join(features.select(*(F.col(c).alias(f"{c}{end}") for c in ("id", *_DESCRIBED))), f"id{end}")
        near = near.where(_may_be_similar(similarity)).select(*_pair("idx", "idy"), "rootx", "rooty", (_apart() / (F.col("nx") + F.col("ny"))).alias("apart"))
        near = scratch.save(spark, near, "line-near")
        ends = near.select("a", "b", "apart", F.explode(F.array("rootx", "rooty")).alias("x"))
        best = ends.groupBy("x").agg(F.min_by(F.struct("a", "b"), F.struct("apart", "a", "b")).alias("p"))
        found = _verified(spark, lines, scratch.save(spark, best.select("p.a", "p.b").distinct(), "line-near-some"), similarity)
        if found.isEmpty():
            break
        scratch.release(spark)
        links.append(found)
        united = near.join(found, ["a", "b"], "left_semi").select(F.col("rootx").alias("a"), F.col("rooty").alias("b"))
        to = connected_components(spark, united, "lines-near")
        rows = scratch.save(spark, _rooted(rows.withColumn("old", F.col("root")), to, "old").drop("old"), "line-rest")
    return rows, links


def _rest(spark: SparkSession, lines: Lines, met: DataFrame, groups: DataFrame, similarity: float) -> tuple[DataFrame, list[DataFrame]]:
    """Distinct pairs (a, b) of lines that share a band and are in different groups x and y, but for those that can't be similar;
    apart: the share of shingles in which they seem to differ. Beside them the links found on the way, which the groups hold."""
    pair = [*_pair("idx", "idy"), F.least("rootx", "rooty").alias("x"), F.greatest("rootx", "rooty").alias("y"), (_apart() / (F.col("nx") + F.col("ny"))).alias("apart")]
    rows = _rooted(met.select("id", "band", F.col("id").alias("root")), groups, "id")
    open_ = rows.groupBy("band").agg(F.count("*").alias("c"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band", F.col("c").alias("members"))
    rows = scratch.save(spark, rows.join(open_, "band"), "line-rest")
    features = lines.features
    rows, links = _neighbours(spark, lines, rows, features, similarity)
    few = scratch.save(spark, rows.where(f"members <= {SMALL}").join(features, "id"), "line-few")
    x, y = (few.select("band", *(F.col(c).alias(f"{c}{s}") for c in ("id", "root", *_DESCRIBED))) for s in "xy")
    pairs = x.join(y, "band").where(F.expr("idx < idy and rootx <> rooty") & _may_be_similar(similarity)).select(*pair)
    some = rows.where(f"members > {SMALL} and members <= {MIDDLE}").select("id", "band", "root")
    some = some.join(some.groupBy("id").agg(F.collect_list("band").alias("bands")), "id").join(features, "id")
    some = scratch.save(spark, some, "line-some")
    x, y = (some.select("band", *(F.col(c).alias(f"{c}{s}") for c in ("id", "root", "bands", *_DESCRIBED))) for s in "xy")
    near = x.join(y, "band").where(F.expr("idx < idy and rootx <> rooty") & _may_be_similar(similarity) & F.expr("band = array_min(array_intersect(bandsx, bandsy))"))
    pairs = pairs.union(near.select(*pair))
    many = scratch.save(spark, rows.where(f"members > {MIDDLE}").select("id", "root").distinct(), "line-many")
    if not many.isEmpty():
        some = scratch.save(spark, lines.texts.join(many.select("id"), "id", "left_semi"), "line-many-texts")
        shares = scratch.save(spark, some.select("id", F.explode(F.array_distinct(tokens(F.col("line")))).alias("token")), "line-shingles")
        shares = shares.join(shares.groupBy("token").agg(F.count("*").alias("c")), "token")
        w = Window.partitionBy("id")
        shares = shares.withColumns({"at": F.row_number().over(w.orderBy("c", "token")) - 1, "n": F.count("*").over(w)})
        shares = shares.where(F.col("at") <= F.col("n") - F.ceil(similarity * F.col("n") - 1e-9)).where("c > 1").drop("n")
        shares = shares.join(many.join(features, "id"), "id").withColumn("parts", F.ceil(F.col("c") / SALTED))
        shares = scratch.save(spark, shares, "line-prefixes")
        side = lambda s, salt: shares.select("token", salt.alias("salt"), *(F.col(c).alias(f"{c}{s}") for c in ("id", "root", "at", *_DESCRIBED)))
        need = similarity / (1 + similarity) * (F.col("nx") + F.col("ny")) - 1e-9
        near = side("x", F.pmod(F.xxhash64("id"), F.col("parts"))).join(side("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))), ["token", "salt"])
        near = near.where(F.expr("idx < idy and rootx <> rooty") & (F.least(F.col("nx") - F.col("atx"), F.col("ny") - F.col("aty")) >= need) & _may_be_similar(similarity))
        pairs = pairs.union(near.select(*pair))
    return pairs.distinct(), links


def _marked(spark: SparkSession, lines: DataFrame, met: DataFrame) -> DataFrame:
    """All lines (h, g, line) that meet others, and few that don't: bitmaps of MARKS bits in all tell most of these apart, so that their
    texts aren't shuffled."""
    bit = lambda c: F.pmod(c, F.lit(MARKS)) + 1
    at = bit(F.col("id"))
    # Of 8 MB at most, whatever the input; without the hint a session with a lower threshold shuffles the texts of all lines.
    marks = scratch.save(spark, met.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("cells")), "line-marks")
    at = bit(F.col("h"))
    rows = lines.select("h", "g", "line", F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("at")).join(F.broadcast(marks), "bucket")
    return rows.where(F.expr("(shiftright(ascii(decode(substr(cells, cast(at div 8 as int) + 1, 1), 'ISO-8859-1')), cast(at % 8 as int)) & 1) = 1")).select("h", "g", "line")


class Lines:
    """The texts of the lines that meet others."""

    def __init__(self, spark: SparkSession, lines: DataFrame, met: DataFrame):
        texts = _marked(spark, lines, met).join(met.select(F.col("id").alias("h")), "h", "left_semi")
        texts = texts.groupBy("h").agg(F.min(F.struct("g", "line")).alias("t")).select(F.col("h").alias("id"), "t.g", "t.line")
        self.texts = scratch.save(spark, texts, "line-texts")
        scratch.release(spark)
        self.features = scratch.save(spark, described(self.texts).select("id", *_DESCRIBED), "line-described")


def _possible(spark: SparkSession, lines: Lines, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) but for those whose lines can't be similar."""
    for end, c in (("x", "a"), ("y", "b")):
        pairs = pairs.join(lines.features.select(F.col("id").alias(c), *(F.col(k).alias(f"{k}{end}") for k in _DESCRIBED)), c)
    return scratch.save(spark, pairs.where(_may_be_similar(similarity)).select("a", "b"), "line-possible")


def _verified(spark: SparkSession, lines: Lines, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose lines are similar. pairs: a written table."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = lines.texts.join(ids, "id", "left_semi").join(lines.features.select("id", "n"), "id")
    texts = scratch.save(spark, texts.select("id", "line", "n"), "line-pair-texts")
    x, y = (texts.select(F.col("id").alias(c), F.col("line").alias(t), F.col("n").alias(f"n{t}")) for c, t in (("a", "x"), ("b", "y")))
    good = similar(F.col("x"), F.col("y"), similarity, F.col("nx"), F.col("ny"))
    return scratch.save(spark, pairs.join(x, "a").join(y, "b").where(good).select("a", "b"), "line-links")


def _uniting(spark: SparkSession, lines: Lines, rest: DataFrame, similarity: float) -> list[DataFrame]:
    """Links (a, b) among the pairs of _rest(), a written table, that unite whatever all links among these would: a pair whose groups others
    have united needs no look."""
    links, likeliest = [], F.min_by(F.struct("a", "b"), F.struct("apart", "a", "b")).alias("p")
    for step in ("group", "two groups", "all"):
        some = rest.select("a", "b", "x", "y")
        if step == "group":
            best = rest.union(rest.select("a", "b", F.col("y").alias("x"), F.col("x").alias("y"), "apart")).groupBy("x").agg(likeliest)
            some = some.join(best.select("p.a", "p.b").distinct(), ["a", "b"])
        elif step == "two groups":
            some = rest.groupBy("x", "y").agg(likeliest).select("p.a", "p.b", "x", "y")
        some = scratch.save(spark, some, "line-rest-some")
        links.append(_verified(spark, lines, some.select("a", "b"), similarity))
        scratch.release(spark)
        if step == "all":
            break
        united = some.join(links[-1], ["a", "b"], "left_semi").select(F.col("x").alias("a"), F.col("y").alias("b"))
        to = connected_components(spark, united, "lines-rest")
        left = rest.join(some.select("a", "b"), ["a", "b"], "left_anti")
        for c in "xy":
            left = left.join(to.select(F.col("id").alias(c), F.col("root").alias(f"to_{c}")), c, "left").withColumn(c, F.coalesce(f"to_{c}", c)).drop(f"to_{c}")
        left = left.where("x <> y").select("a", "b", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "apart")
        rest = scratch.save(spark, left, "line-rest-left")
        if rest.isEmpty():
            break
    return links


def _found(spark: SparkSession, documents: DataFrame, similarity: float) -> DataFrame:
    """doc_id (not null), text_hash, line_no and h of each line that goes, with the place of the one that stays."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with scratch.scope(spark) as kept:
        to = kept(_keepers(spark, docs, similarity))
    scratch.release(spark)
    met = _lines(docs).select("doc_id", "text_hash", "line_no", *_hashes()).join(to, ["h", "g"])
    return met.where(_place() != F.col("keep")).select("doc_id", "text_hash", "line_no", "h", "keep")


def find(spark: SparkSession, documents: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc_id and line_no (from 0) of each line that goes, with keep_doc_id and keep_line_no of the one that stays."""
    span = F.lit(TEXT_SPAN << 32).cast("decimal(18,0)")
    named = lambda c: F.nullif(c.cast("long"), F.lit(NULL_ID))
    return _found(spark, documents, similarity).select(
        named(F.col("doc_id")).alias("doc_id"), "line_no", named((F.col("keep") - F.pmod("keep", span)) / span).alias("keep_doc_id"), F.pmod("keep", F.lit(1 << 32).cast("decimal(10,0)")).cast("int").alias("keep_line_no")
    )


def _keepers(spark: SparkSession, docs: DataFrame, similarity: float) -> DataFrame:
    """(h, g, keep) of the lines that occur more than once or are linked; keep: the place of the one that stays."""
    places = _lines(docs).select("*", *_hashes())
    firsts = scratch.save(spark, places.withColumn("place", _place()).groupBy("h", "g").agg(F.min("place").alias("place"), F.count("*").alias("n")), "line-firsts")
    scratch.release(spark)
    often = scratch.save(spark, firsts.where(f"n > {SALTED}").select("h", "g", F.col("place").alias("first")), "line-often")
    once = places.join(often, ["h", "g"], "left").where(F.col("first").isNull() | (F.col("first") == _place())).select("h", "g", "line")
    met = scratch.save(spark, _meetings(once), "line-meetings")
    scratch.release(spark)
    lines = Lines(spark, once, met)
    scratch.release(spark)
    checked = lambda some: _verified(spark, lines, some, similarity)
    pairs = scratch.save(spark, _candidates(met), "line-pairs")
    links = checked(_possible(spark, lines, pairs, similarity))
    groups, late = connected_components(spark, links, "lines"), []
    for _ in range(HUB_ROUNDS - 1):
        more = scratch.save(spark, _more_candidates(met, groups, pairs), "line-more-pairs")
        if more.isEmpty():
            break
        found = checked(_possible(spark, lines, more, similarity))
        scratch.release(spark)
        pairs = pairs.union(more)
        if found.isEmpty():
            break
        if 100 * found.count() < links.count():  # the rest finds what further rounds would
            late.append(found)
            break
        links = links.union(found)
        groups = connected_components(spark, links, "lines")
    rest, near = _rest(spark, lines, met, groups, similarity)
    rest = scratch.save(spark, rest.join(pairs, ["a", "b"], "left_anti"), "line-rest-pairs")
    scratch.release(spark)
    late += near if rest.isEmpty() else near + _uniting(spark, lines, rest, similarity)
    if late:
        for found in late:
            links = links.union(found)
        groups = connected_components(spark, links, "lines-all")
    scratch.release(spark)
    named = lines.texts.select(F.col("id").alias("h"), "g").join(groups.withColumnRenamed("id", "h"), "h")
    blank = (F.col("h") == F.xxhash64(F.lit(""))) & (F.col("g") == F.xxhash64(F.lit(7), F.lit("")))
    several = scratch.save(spark, firsts.join(named, ["h", "g"], "left").where("n > 1 or root is not null").where(~blank), "line-several")
    keeper = several.where("root is not null").groupBy("root").agg(F.min("place").alias("keep"))
    alone = several.where("root is null").select("h", "g", F.col("place").alias("keep"))
    return scratch.save(spark, several.join(keeper, "root").select("h", "g", "keep").union(alone), "line-keepers")


def drop_lines(spark: SparkSession, documents: DataFrame, similarity: float = 0.8) -> DataFrame:
    """documents without the lines that go, with all columns."""
    with scratch.scope(spark) as kept:
        gone = _found(spark, documents, similarity).distinct()
        gone = kept(scratch.save(spark, gone.groupBy(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")).agg(F.collect_set(F.xxhash64("line_no", "h")).alias("_gone")), "lines-gone"))
    scratch.release(spark)
    whole = documents.select(F.struct("*").alias("_doc"))  # whatever the columns' names are
    doc_id = F.coalesce(F.col("_doc.doc_id").cast("long"), F.lit(NULL_ID))
    met = whole.join(gone, (doc_id == F.col("_doc_id")) & (F.xxhash64("_doc.text") == F.col("_text_hash")), "left")
    kept = F.filter(F.split("_doc.text", "\n"), lambda x, i: ~F.array_contains(F.col("_gone"), F.xxhash64(i, F.xxhash64(normal(x)))))
    met = met.withColumn("_new", F.when(F.col("_gone").isNotNull(), F.array_join(kept, "\n")))
    doc = F.col("_doc").withField("text", F.coalesce("_new", "_doc.text"))
    if "n_chars" in documents.columns:
        doc = doc.withField("n_chars", F.when(F.col("_gone").isNull(), F.col("_doc.n_chars")).otherwise(F.length("_new").cast(documents.schema["n_chars"].dataType)))
    return met.select(doc.alias("_doc")).select("_doc.*")
