"""The training-data operators against brute force, round trips and held-out labels, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from storyloom.llm import (
    chat_format, components, decontaminate, line_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, queries, scratch, secret_scan, textkernel, token_records,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _t string, _doc double, _gone boolean"
LONG = "one long text of many words " * 4000
ODD = [
    (1, None, "en", "a", None, "x", 0.5, True), (2, "", "en", None, 0, "x", None, None), (None, "a text without an id, and some words more", None, "a", 1, None, None, None),
    (3, " \t\n ", "en", "a", 4, "y", None, None), (4, "word", "en", "a", 4, "y", None, None), (5, LONG, "en", "a", len(LONG), "y", None, None),
    (6, "the same text in two rows, word for word and line for line", "en", "a", 9, "y", None, None), (6, "the same text in two rows, word for word and line for line", "en", "a", 9, "y", None, None),
    (7, "the same text in two rows, word for word and line for line", "en", "a", 9, "y", None, None), (8, "日本語 \U0001f600 \u0001\\ \"quoted\"\r\nline sep", "ja", "a", 9, "y", None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pydict()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def groups_of(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(50, 90)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["root"] for r in components.connected_components(spark, df).collect()}
    want = groups_of(300, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}
    assert components.connected_components(spark, df.limit(0)).count() == 0


def test_kernel_words_and_shingles():
    texts = ["A b  c\n", "", None, "  x", "a", "b", "A b c d", "É é", "q" * 5000]
    data, offsets = textkernel.buffers(pa.array(texts))
    w = textkernel.Words(data, offsets)
    got = [[w.data[s:e].tobytes().decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first, w.first[1:])]
    assert got == [words(lower(t)) for t in texts]
    h, begin = textkernel.shingles(w, 3)
    assert list(np.diff(begin)) == [1, 0, 0, 1, 1, 1, 2, 1, 1]
    assert h[begin[0]] == h[begin[6]] and len(set(h.tolist())) == 7


# 1 ------------------------------------------------------------------------------------------------


def test_line_dedup_finds_what_brute_force_finds(spark):
    got = {(r["doc_id"], r["line_no"]) for r in queries.op1_line_dedup(spark, SF).collect()}
    places, t = defaultdict(list), table("documents")
    for i, text in sorted(zip(t["doc_id"], t["text"])):
        for k, line in enumerate(text.split("\n")):
            if n := line.strip(line_dedup.WHITE).lower():
                places[n].append((i, k))
    # All pairs that share one of their rarest shingles, as all similar ones do; no shingle is left out.
    lines = list(places)
    sets = [{n[m : m + line_dedup.VERIFY] for m in range(max(1, len(n) - line_dedup.VERIFY + 1))} for n in lines]
    count, by, links = Counter(x for x2 in sets for x in x2), defaultdict(list), []
    for i, x2 in enumerate(sets):
        near = set()
        for x in sorted(x2, key=lambda x: (count[x], x))[: len(x2) - math.ceil(0.8 * len(x2)) + 1]:
            near.update(by[x])
            by[x].append(i)
        links += [(j, i) for j in near if 0.8 * len(x2) <= len(sets[j]) <= 1.25 * len(x2) and (n := len(sets[j] & x2)) >= 0.8 * (len(sets[j]) + len(x2) - n)]
    root, keep = groups_of(len(lines), links), defaultdict(list)
    for i, n in enumerate(lines):
        keep[root[i]] += places[n]
    want = {p for ps in keep.values() for p in ps if p != min(ps)}
    assert got <= want and len(got) >= 0.98 * len(want)


def test_line_dedup_edges(spark, odd, empty):
    assert line_dedup.find(spark, empty).count() == 0 and line_dedup.drop_lines(spark, empty).count() == 0
    out = line_dedup.drop_lines(spark, odd)
    assert out.columns == odd.columns
    rows = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert out.count() == len(ODD) and (7, "") in rows and (6, ODD[6][1]) in rows and (1, None) in rows and (5, LONG) in rows
    same = spark.createDataFrame([(1, "one line here\nand another"), (1, "one line here\nbut not this"), (None, "x y z\nsome"), (None, "X y z\nother")], "doc_id long, text string")
    assert sorted(r["text"] for r in line_dedup.drop_lines(spark, same).collect()) in (
        [a, b, c, d] for a, b in (("and another", "one line here\nbut not this"), ("but not this", "one line here\nand another")) for c, d in (("other", "x y z\nsome"), ("some", "X y z\nother")) for a, b, c, d in [sorted((a, b, c, d))])
    near = "The quick brown fox jumps over the lazy dog and then runs away from all the other animals of the big forest. "
    docs = spark.createDataFrame([(1, near + "\nkeep me", 1), (2, near.replace("lazy", "hazy") + "\nother", 1), (3, "keep  me\nkeep me ", 1)], "doc_id long, text string, n_chars int")
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.drop_lines(spark, docs).collect()}
    assert texts == {1: (near + "\nkeep me", 1), 2: ("other", 5), 3: ("keep  me", 8)}


def test_line_dedup_compares_all_characters_without_case(spark):
    rng, rows, want = random.Random(12), [], set()
    shingles = lambda t: {t[i : i + 5] for i in range(len(t) - 4)}
    for k in range(0, 200, 2):
        one = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(16 if k % 4 else 10)]
        two = list(one)
        two[rng.randrange(len(two))] = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9)))
        x, y = " ".join(one), " ".join(two)
        rows += [(k, x), (k + 1, y.title())]
        if (n := len(shingles(x) & shingles(y))) >= 0.8 * (len(shingles(x)) + len(shingles(y)) - n):
            want.add((k + 1, k))
    rows += [(1000, "Only CAPITALS are other here"), (1001, "only capitals are Other here")]
    got = {(r["doc_id"], r["keep_doc_id"]) for r in line_dedup.find(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want.add((1001, 1000))
    assert got <= want and len(got) >= 0.93 * len(want) and (1001, 1000) in got


@pytest.mark.parametrize("small", [64, 4])
def test_line_dedup_pairs_all_that_share_a_band(spark, monkeypatch, small):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    rng, word = random.Random(13), lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    common, rows = " ".join(word() for _ in range(50)), []
    for k in range(0, 600, 2):
        own = [word() for _ in range(10)]
        rows += [(k, f"{common} {' '.join(own)}"), (k + 1, f"{common} {' '.join([word() for _ in range(3)] + own[3:])}")]
    got = {(r["doc_id"], r["keep_doc_id"]) for r in line_dedup.find(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= {(k + 1, k) for k in range(0, 600, 2)} and len(got) >= 0.98 * 300


@pytest.mark.parametrize("middle", [2048, 4])
def test_line_dedup_pairs_all_of_larger_bands(spark, monkeypatch, middle):
    monkeypatch.setattr(line_dedup, "SMALL", 4)
    monkeypatch.setattr(line_dedup, "MIDDLE", middle)
    rng, word = random.Random(13), lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    common, rows = " ".join(word() for _ in range(50)), []
    for k in range(0, 600, 2):
        own = [word() for _ in range(10)]
        rows += [(k, f"{common} {' '.join(own)}"), (k + 1, f"{common} {' '.join([word() for _ in range(3)] + own[3:])}")]
    got = {(r["doc_id"], r["keep_doc_id"]) for r in line_dedup.find(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= {(k + 1, k) for k in range(0, 600, 2)} and len(got) >= 0.98 * 300


def test_line_dedup_verifies_no_pairs_within_a_group(spark, monkeypatch):
    """A group of near copies costs as many pairs as it has lines, not their square, and far lines that share its bands aren't united with it."""
    rng = random.Random(12)
    passage = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=300))
    rows = [(k, passage[:c] + "".join(rng.choices("QXZ", k=2)) + passage[c + 2 :]) for k in range(100) for c in [rng.randrange(290)]]
    rows += [(100 + k, passage[:250] + "".join(rng.choices("0123456789", k=120))) for k in range(5)]
    verify, seen = line_dedup._verified, []
    monkeypatch.setattr(line_dedup, "_verified", lambda spark, lines, pairs, similarity: seen.append(pairs.count()) or verify(spark, lines, pairs, similarity))
    monkeypatch.setattr(line_dedup, "_candidates", lambda met: met.selectExpr("hub AS a", "id AS b").limit(0))
    monkeypatch.setattr(line_dedup, "HUB_ROUNDS", 1)
    got = {(r["doc_id"], r["keep_doc_id"]) for r in line_dedup.find(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(k, 0) for k in range(1, 100)}
    assert sum(seen) < 1000  # of 4950


def test_line_dedup_joins_few_pairs_of_a_crowded_band(spark, monkeypatch):
    """Neighbours unite most of a group before all that is still apart in its bands is joined with all."""
    rng = random.Random(12)
    passage = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=300))
    rows = [(k, passage[:c] + "".join(rng.choices("QXZ", k=2)) + passage[c + 2 :]) for k in range(100) for c in [rng.randrange(290)]]
    save, seen = scratch.save, []

    def counted(spark, df, name):
        out = save(spark, df, name)
        if name == "line-rest-pairs":
            seen.append(out.count())
        return out

    monkeypatch.setattr(scratch, "save", counted)
    monkeypatch.setattr(line_dedup, "_candidates", lambda met: met.selectExpr("hub AS a", "id AS b").limit(0))
    monkeypatch.setattr(line_dedup, "HUB_ROUNDS", 1)
    got = {(r["doc_id"], r["keep_doc_id"]) for r in line_dedup.find(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(k, 0) for k in range(1, 100)} and len(seen) == 1 and seen[0] < 1000


def test_line_dedup_runs_no_python_on_the_executors(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("Python on the executors")

    docs = spark.createDataFrame([(k, f"the first line of {k // 2} all the documents that are here\nand {k} more") for k in range(40)], "doc_id long, text string")
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(docs), name, refuse)
    monkeypatch.setattr(type(docs), "rdd", property(refuse))
    assert line_dedup.find(spark, docs).count() >= 20
    assert line_dedup.drop_lines(spark, docs).count() == 40


def test_line_columns_agree_with_kernels_and_plain_sets(spark):
    rng, size = random.Random(33), line_dedup.VERIFY
    texts = ["".join(rng.choices(kind, k=rng.choice([1, 4, 5, 6, 40, 90]))) for kind in ("ab", "abé漢 𝒳", "ab\n ") for _ in range(30)]
    texts += [t[:-2] + "é" + t[-1:] for t in texts] + ["a" * 500]
    sets = [{t[i : i + size] for i in range(max(1, len(t) - size + 1))} for t in texts]
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    rows = {r["id"]: r for r in line_dedup.described(lines).collect()}
    assert [rows[i]["n"] for i in range(len(texts))] == [len(x) for x in sets]
    pairs = [(i, j) for i in range(len(texts)) for j in rng.sample(range(len(texts)), 20)] + [(i, i + 90) for i in range(90)]
    for i, j in pairs:
        assert sum(((rows[i][f"b{k}"] ^ rows[j][f"b{k}"]) & (2**64 - 1)).bit_count() for k in range(8)) <= len(sets[i] ^ sets[j])
    x, y = ([texts[p[k]] for p in pairs] for k in (0, 1))
    batch = pa.record_batch({"a": pa.array([i for i, _ in pairs]), "b": pa.array([j for _, j in pairs]), "x": pa.array(x), "y": pa.array(y)})
    kernel = {(r["a"], r["b"]) for out in line_dedup._compare(0.8)([batch]) for r in out.to_pylist()}
    both = spark.createDataFrame([(*p, *t) for p, t in zip(pairs, zip(x, y))], "a long, b long, x string, y string")
    got = {(r["a"], r["b"]) for r in both.where(line_dedup.similar(F.col("x"), F.col("y"), 0.8)).collect()}
    assert got == kernel == {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} and len(got) > 50


def test_line_dedup_of_a_line_in_many_places(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SALTED", 3)
    line = "a line that stands in more places than are hashed one by one"
    rows = [(k, f"{line}\nown {k * 7919}" if k else line.replace("more", "mare")) for k in range(12)] + [(5, f"{line}\nown {5 * 7919}")]
    got = {(r["doc_id"], r["line_no"], r["keep_doc_id"]) for r in line_dedup.find(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(k, 0, 0) for k in range(1, 12)} <= got


def test_line_dedup_tells_lines_of_one_hash_apart(spark):
    one, two = (
        "w=(bmf})the first of two lines, 5=,c}^'~which one hash can't tel",
        "46m@_u<ethe first of two lines, 0#g0%r`owhich one hash can't tel",
    )
    docs = spark.createDataFrame([(1, one), (2, one), (3, two)], "doc_id long, text string")
    hashes = docs.select("text").distinct().selectExpr("xxhash64(text)").collect()
    assert len(hashes) == 2 and hashes[0] == hashes[1]
    assert {(r["doc_id"], r["keep_doc_id"]) for r in line_dedup.find(spark, docs).collect()} == {(2, 1)}


def test_line_dedup_shuffles_no_texts(spark):
    rng = random.Random(14)
    rows = [(k, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=2000))) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = scratch.save(spark, docs, "docs")
    store, none = spark._jvm.org.apache.spark.SparkContext.getOrCreate().statusStore(), spark._sc._gateway.new_array(spark._jvm.double, 0)

    def shuffled():
        stages = store.stageList(None, False, False, none, None)
        return {stages.apply(k).stageId(): stages.apply(k).shuffleWriteBytes() for k in range(stages.size())}

    before = set(shuffled())
    assert line_dedup.find(spark, docs).count() == 0
    assert sum(n for k, n in shuffled().items() if k not in before) < 0.5 * 2_000_000


def test_line_dedup_shuffles_no_texts_to_mark_lines_whatever_the_threshold(spark):
    lines = spark.createDataFrame([(k * 10**12, k, f"line {k}") for k in range(20)], "h long, g long, line string")
    met, key = lines.where("g < 5").select(F.col("h").alias("id")), "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        marked = line_dedup._marked(spark, lines, met)
        assert {r["g"] for r in marked.collect()} == set(range(5))
        plan = marked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, was)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_line_dedup_verifies_no_hub_pairs_that_cannot_be_similar(spark, monkeypatch):
    rng = random.Random(15)
    text = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage = text(150)
    rows = [(k, passage + text(150)) for k in range(60)] + [(60, passage + text(150))]
    rows += [(61, rows[60][1][:-3] + "QXZ")]
    verify, seen = line_dedup._verified, []
    monkeypatch.setattr(line_dedup, "_verified", lambda spark, lines, pairs, similarity: seen.append(pairs.count()) or verify(spark, lines, pairs, similarity))
    got = {(r["doc_id"], r["keep_doc_id"]) for r in line_dedup.find(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(61, 60)} and 1 <= sum(seen) < 10  # of 61 with hubs alone


def test_line_kernels_agree_with_plain_sets():
    rng, size = random.Random(31), line_dedup.VERIFY
    texts = ["".join(rng.choices("abé漢 𝒳", k=rng.choice([1, 3, 4, 5, 6, 40, 300]))) for _ in range(300)] + ["a" * 500, "ab" * 400]
    sets = [{t[i : i + size] for i in range(max(1, len(t) - size + 1))} for t in texts]
    h, count = line_dedup.shingles(*textkernel.buffers(pa.array(texts)), size)
    hashes = np.split(h, np.cumsum(count)[:-1])
    of = {}
    for t, x in zip(texts, hashes):
        for i, v in enumerate(x.tolist()):
            assert of.setdefault(t[i : i + size], v) == v
    assert len(set(of.values())) == len(of) and [len(set(x.tolist())) for x in hashes] == [len(x) for x in sets]
    # The parities of similar lines differ in no more classes than the bound of _may_be_similar allows.
    described = next(line_dedup._describe([pa.record_batch({"id": pa.array(range(len(texts))), "line": pa.array(texts)})])).to_pylist()
    for _ in range(3000):
        i, j = rng.randrange(len(texts)), rng.randrange(len(texts))
        other = sum(((r[f"b{k}"] ^ described[j][f"b{k}"]) & (2**64 - 1)).bit_count() for r in [described[i]] for k in range(8))
        assert other <= len(sets[i] ^ sets[j]) and described[i]["n"] == len(sets[i])
    pairs = [(i, j) for i in range(0, 300, 3) for j in range(0, 300, 7)]
    batch = pa.record_batch({"a": pa.array([i for i, _ in pairs]), "b": pa.array([j for _, j in pairs]), "x": pa.array([texts[i] for i, _ in pairs]), "y": pa.array([texts[j] for _, j in pairs])})
    got = {(r["a"], r["b"]) for out in line_dedup._compare(0.8)([batch]) for r in out.to_pylist()}
    assert got == {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}


def test_bands_are_the_least_hashes_whatever_the_slice():
    rng = random.Random(32)
    texts = ["".join(rng.choices("abcdefgh", k=rng.choice([2, 9, 10, 60, 2000]))) for _ in range(200)] + ["ab" * 300]
    data, offsets = textkernel.buffers(pa.array(texts))
    band, of = line_dedup.bands(data, offsets)
    whole = [band[of == i].tolist() for i in range(len(texts))]
    h, count = line_dedup.shingles(data, offsets, line_dedup.SHINGLE)
    for i, x in enumerate(np.split(h >> np.uint64(64 - line_dedup._LOW), np.cumsum(count)[:-1])):
        assert len(whole[i]) == min(len(set(x.tolist())), line_dedup.BANDS)
        assert line_dedup.bands(data, offsets[i : i + 2])[0].tolist() == whole[i]


# 2 ------------------------------------------------------------------------------------------------


def test_edit_distance_is_that_of_the_best_part():
    rng = random.Random(5)
    for _ in range(200):
        a, t = (bytes(rng.choices(b"abc", k=rng.randint(lo, 12))) for lo in (1, 0))
        row = [0] * (len(t) + 1)
        for i, c in enumerate(a, 1):
            new = [i]
            for j, e in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != e)))
            row = new
        assert decontaminate.distance(a, t, 99) == min(row)


def test_decontamination_finds_exact_and_edited_items(spark):
    t, items = table("documents"), table("benchmark")
    plain = [decontaminate.normal(x) for x in items["text"]]
    exact = {(i, k) for i, x in zip(t["doc_id"], t["text"]) for k, n in zip(items["item_id"], plain) if n in decontaminate.normal(x)}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op2_decontamination(spark, SF).collect()}
    assert exact <= got
    found, n = edited_found(plain, 0.05)
    assert found >= 0.95 * n


def edited(rng, text, n):
    s = list(text)
    for _ in range(n):
        k, how = rng.randrange(len(s)), rng.randrange(3)
        s[k : k + (how < 2)] = [rng.choice("abcdefghijklmnopqrstuvwxyz")] * (how != 1)
    return "".join(s)


def edited_found(items, rate):
    """How many items are found in copies with that share of edits; an item of another text is an error."""
    rng = random.Random(3)
    texts = pa.array([f"first some other words, {edited(rng, n.decode(), int(rate * len(n)))} and then some more" for n in items])
    block = decontaminate.Items(list(range(len(items))), items, 0.1)
    data, offsets = textkernel.buffers(texts)
    number = block.numbers(textkernel.Words(data, offsets).hashes())
    found = {(r, k) for r, k, _, _ in block.anchor(np.bincount(number[number >= 0], minlength=len(block.vocab)), len(number)).hits(texts)}
    assert all(r == k or decontaminate.distance(items[k], decontaminate.normal(texts[r].as_py()), len(items[k])) <= 0.1 * len(items[k]) for r, k in found)
    return sum((i, i) in found for i in range(len(items))), len(items)


@pytest.mark.parametrize("words", [1, 2, 4, 8, 20, 40, 600])
def test_decontamination_recall_at_the_full_rate(words):
    rng = random.Random(words)
    items = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(words)).encode() for _ in range(200 if words < 100 else 20)]
    found, n = edited_found(items, 0.1)
    assert found >= 0.95 * n


def test_decontamination_finds_what_brute_force_finds(spark):
    t, items = table("documents"), table("benchmark")
    docs = [(i, decontaminate.normal(x)) for i, x in zip(t["doc_id"], t["text"])][:60]
    plain = [(k, decontaminate.normal(x)) for k, x in zip(items["item_id"], items["text"])]
    want = {(i, k, d) for i, x in docs if len(x) < 3000 for k, n in plain if (d := decontaminate.distance(n, x, len(n) // 10)) <= len(n) // 10}
    ids = {i for i, x in docs if len(x) < 3000}
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in queries.op2_decontamination(spark, SF).collect() if r["doc_id"] in ids}
    assert got == want


@pytest.mark.parametrize(("words", "letters", "at"), [(12, 12, 5), (40, 10, 9), (3, 20, 10), (300, 11, 0)])
def test_decontamination_finds_items_in_which_each_word_is_changed(words, letters, at):
    rng = random.Random(words)
    some = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=letters)) for _ in range(words * 20)]
    items = [some[i : i + words] for i in range(0, len(some), words)]
    texts = [" ".join(w[:at] + rng.choice("0123456789") + w[at + 1 :] for w in x) for x in items]
    block = decontaminate.Items(list(range(len(items))), [" ".join(x).encode() for x in items], 0.1)
    data, offsets = textkernel.buffers(pa.array(texts))
    number = block.numbers(textkernel.Words(data, offsets).hashes())
    assert (number < 0).all()  # no word stands
    found = {(r, k): d for r, k, d, _ in block.anchor(np.zeros(len(block.vocab)), len(number)).hits(pa.array([f"other words {x} at the end" for x in texts]))}
    assert found == {(i, i): words for i in range(len(items))}


@pytest.mark.parametrize("met", [100, 4_000_000])
def test_decontamination_looks_at_all_positions(monkeypatch, met):
    """Windows are laid wherever brute force finds an item within the rate: in words, between spaces, over repeated letters."""
    monkeypatch.setattr(decontaminate, "MET", met)
    rng = random.Random(8)
    items = [bytes(rng.choices(b"abc ", k=n)).strip() + b"x" for n in (*range(1, 40), 60, 80, 200)] + [b"a" * 50, b"ab" * 30]
    block = decontaminate.Items(list(range(len(items))), [decontaminate.normal(x.decode()) for x in items], 0.1)
    texts = [decontaminate.normal("".join(rng.choices("abcx  ", k=rng.randint(0, 300))) + edited(rng, x, len(x) // 10) + "c" * rng.randint(0, 90)) for x in [t.decode() for t in block.texts] * 3]
    base = np.cumsum([0, *(len(x) + 1 for x in texts)])
    data = np.frombuffer(b" ".join(texts) + b" " * (1 + decontaminate.PIECE), np.uint8)
    stand = {(r, k) for r, k, _ in block._stand(data, base[:-1]).tolist()}
    near = {(r, k) for r, x in enumerate(texts) for k, t in enumerate(block.texts) if decontaminate.distance(t, x, len(t) // 10) <= len(t) // 10 and (len(t) > 9 or b" " + t + b" " in b" " + x + b" ")}
    assert len(near) > 90 and near <= stand


def test_decontamination_of_a_long_item():
    rng = random.Random(2)
    item = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(5000))
    block = decontaminate.Items([0], [item.encode()], 0.1)
    texts = pa.array([f"before {item[:9000]} and {item[9004:]} after", item[:15000], "x"])
    assert [(r, k) for r, k, _, _ in block.anchor(np.ones(len(block.vocab)), 10_000).hits(texts)] == [(0, 0)]


def test_decontamination_edges(spark, odd, empty):
    bench = spark.createDataFrame([(1, "the same text in two rows, WORD for   word and line"), (2, None), (3, "word"), (4, "")], "item_id long, text string")
    hits = decontaminate.find(spark, odd, bench)
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in hits.collect()) == [(4, 3, 0), (6, 1, 0), (6, 1, 0), (6, 3, 0), (6, 3, 0), (7, 1, 0), (7, 3, 0)]
    out = decontaminate.clean(spark, odd, bench)
    assert out.columns == odd.columns and out.count() == len(ODD) - 4
    assert decontaminate.find(spark, empty, bench).count() == 0 and decontaminate.find(spark, odd, bench.limit(0)).count() == 0


# 3 and 5 ------------------------------------------------------------------------------------------


def luhn(d):
    return sum((v - 9 if v > 9 else v) for i, c in enumerate(reversed(d)) for v in [int(c) * (1 + i % 2)]) % 10 == 0


def pii_spans(t):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d)]
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


def check_pii(rows, got):
    for (i, t), r in zip(rows, got, strict=True):
        want = pii_spans(t or "")
        digest = hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
        assert (r["base_sha256"], *(r[f"n_{k}"] for k in pii.KINDS[:4])) == (digest, *(sum(x == k for _, x, _ in want) for k in range(4))), t


def test_pii_matches_plain_expressions(spark):
    rng, parts = random.Random(3), ["1", "25", "256", "0", "a", "_", ".", ".", "@", "-", " ", "+", "(", ")", "é", "\U0001f600", "\n", "4539148803436467", "a@b.c", "1.2.3.4", "+1 (415) 555-0101"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 30)))) for i in range(1500)] + [(9000, None), (9001, "a" * 50000), (9002, "1 " * 5000), (9003, "a." * 9000 + "@")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_pii(rows, sorted(pii.extract(spark, df).collect(), key=lambda r: r["doc_id"]))
    t = table("documents")
    check_pii(sorted(zip(t["doc_id"], t["text"])), sorted(queries.op3_pii(spark, SF).collect(), key=lambda r: r["doc_id"]))


def test_pii_learns_contexts(spark, odd, empty):
    rng = random.Random(8)
    number = lambda: f"{rng.randrange(200, 999)}-555-{rng.randrange(1000, 9999)}"
    rows = [(i, f"please callme: +1 {number()} now") for i in range(60)] + [(100, "or callme: 415-555-0199 today"), (101, "order no. 77123456 is due"), (102, "415-555-0199")]
    got = {r["doc_id"]: r for r in pii.extract(spark, spark.createDataFrame(rows, "doc_id long, text string"), confidence=0.6).collect()}
    assert got[100]["spans"] == "context:11:23" and got[100]["n_context"] == 1
    assert got[101]["n_context"] == 0 and got[102]["n_context"] == 0
    assert pii.extract(spark, empty).count() == 0 and pii.extract(spark, odd).count() == len(ODD)


ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secret_spans(t):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def test_secrets_match_plain_expressions(spark, odd, empty):
    rng, parts = random.Random(4), ["pass", "word", "Token", "api", "_", "key", "=", ": ", '"', "'", " ", "abcd1234", "AKIA", "QWERTY12345678", "0123456789abcdef" * 2, "g", "é", ".", "secret:xyzxyzxyz"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 14)))) for i in range(1500)]
    t = table("documents")
    for pairs in (rows, list(zip(t["doc_id"], t["text"]))):
        got = {r["doc_id"]: r for r in secret_scan.scan(spark, spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
        for i, text in pairs:
            want = secret_spans(text)
            digest = hashlib.sha256(",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
            assert (got[i]["base_sha256"], got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == (digest, *(sum(x == k for _, x, _ in want) for k in range(3)))
    assert secret_scan.scan(spark, empty).count() == 0 and secret_scan.scan(spark, odd).count() == len(ODD)


def test_secrets_battery_tells_random_from_text(spark):
    rng, alphabet = random.Random(6), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = {i: "".join(rng.choices(alphabet, k=40)) for i in range(30)}
    text = "ordinary remarkable sentences containing considerable vocabulary throughout international conversations "
    rows = [(i, f"{text} {k} and so on") for i, k in keys.items()] + [(100 + i, text * 3 + "a1" * 12 + " aaaaaaaaaaaaaaaa1111111111111111") for i in range(100)]
    got = {r["doc_id"]: r["n_random"] for r in secret_scan.scan(spark, spark.createDataFrame(rows, "doc_id long, text string"), level=0.05).collect()}
    assert sum(got[i] for i in keys) >= 25 and not any(got[100 + i] for i in range(100))


def battery(token, alphabet):
    """The bin of the battery's verdict, by the tests' formulas."""
    x, k, n = [alphabet.index(c) for c in token], len(alphabet), len(token)
    f, chi = k - 1, sum((x.count(c) - n / k) ** 2 for c in range(k)) * k / n
    p = [0.5 * math.erfc(((chi / f) ** (1 / 3) - (1 - 2 / (9 * f))) / math.sqrt(2 / (9 * f)) / math.sqrt(2))]
    high = [c >= k / 2 for c in x]
    h, mean = sum(high), sum(x) / n
    if 0 < h < n:
        expected = 1 + 2 * h * (n - h) / n
        var = (expected - 1) * (expected - 2) / (n - 1)
        p.append(math.erfc(abs(1 + sum(a != b for a, b in zip(high, high[1:])) - expected) / math.sqrt(2 * var)) if var > 0 else 1)
    else:
        p.append(2.0 ** (1 - n))
    s = sum((c - mean) ** 2 for c in x)
    p.append(math.erfc(abs(sum((a - mean) * (b - mean) for a, b in zip(x, x[1:])) / s) * math.sqrt(n / 2)) if s else 2.0 ** (1 - n))
    return min(secret_scan.BINS - 1, int(-math.log2(max(min(1, 3 * min(p)), 2.0**-70))))


def test_secrets_battery_is_that_of_the_formulas():
    rng = random.Random(21)
    for e, (_, alphabet) in enumerate(secret_scan.ALPHABETS):
        tokens = ["".join(rng.choices(alphabet[: rng.choice([1, 2, 5, len(alphabet)])], k=rng.randint(16, 90))) for _ in range(200)]
        n = np.array([len(t) for t in tokens])
        x = secret_scan._NUMBER[e, np.frombuffer("".join(tokens).encode(), np.uint8)]
        got = secret_scan.Draws(x, len(alphabet)).bins(np.cumsum(n) - n, n)
        assert got.tolist() == [battery(t, alphabet) for t in tokens]


def test_secrets_null_is_all_of_ordinary_text():
    texts = ["Some words, été 12 and " + "x" * 20 + " more; " * 30, "", None, "a Bc\ndef " * 40, "q" * 15 + " " + "Z9" * 8 + " end"]
    data, offsets = textkernel.buffers(pa.array(texts))
    got = np.zeros(secret_scan.SHAPE, np.int64)
    secret_scan._ordinary(data, offsets, got)
    want = np.zeros_like(got)
    for t in texts:
        t = re.sub("[A-Za-z0-9+/_-]{16,}", "", t or "")
        views = {0: t, 1: t.lower(), 3: t.lower(), 4: t.upper(), 5: t, 6: re.sub(r"[ \n]", "-", t)}
        for e, view in views.items():
            alphabet = secret_scan.ALPHABETS[e][1]
            row = [c for c in view if c in alphabet]
            for c, n in enumerate(secret_scan.LENGTHS):
                for i in range(0, len(row) - n + 1, n):
                    want[e, c, battery("".join(row[i : i + n]), alphabet)] += 1
    assert (got == want).all() and want.sum() > 100


def test_secrets_candidates_have_any_characters():
    for t, e in (("12345678901234567", "decimal"), ("qwkjhgfdsazxcvbnmp", "lower"), ("QWKJHGFDSAZXCVBNMP", "base32"), ("0A1B2C3D4E5F6A7B8", "HEX"), ("abc/def-ghi_jkl+mno", "base64")):
        assert [(a, b, secret_scan.ALPHABETS[k][0]) for a, b, k in secret_scan.candidates(f"x {t}. y", [])] == [(2, 2 + len(t), e)]


def test_secrets_after_an_equals_sign_are_candidates():
    for before, key in (("auth=", "Zm9vYmFyQmF6UXV4MTIzNDU2Nzg5"), ("access_key=", "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY"), ("?sig==", "Zm9vYmFyQmF6UXV4MTIzNDU2Nzg5")):
        text = f"x {before}{key}== y"
        assert [text[a:b] for a, b, *_ in secret_scan.candidates(text, secret_scan.base_spans(text))] == [key]


# 4 ------------------------------------------------------------------------------------------------


def brute_groups(rows, size, percent):
    sets = []
    for _, t in rows:
        w = words(lower(t))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * (n := len(sets[a] & sets[b])) >= percent * (len(sets[a]) + len(sets[b]) - n) > 0]
    root, least = groups_of(len(rows), links), defaultdict(list)
    for i, r in enumerate(root):
        least[r].append(rows[i][0])
    return {rows[i][0]: (len(sets[i]), min(least[r])) for i, r in enumerate(root)}


@pytest.mark.parametrize("small", [32, 2])
def test_ngram_join_is_exact(spark, monkeypatch, small):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    rng = random.Random(9)
    base = [" ".join(rng.choices(["alpha", "Beta", "gamma", "delta", "x", "y", "z", "omega"], k=60)) for _ in range(12)]
    rows = []
    for k, b in enumerate(base):
        for _ in range(rng.randint(1, 14)):
            w = b.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(50)}"
            rows.append((len(rows) * 3 + k, " ".join(w)))
    rows += [(10_000 + i, t) for i, t in enumerate(["", None, "a", "A", "a b", "a  b", "a b c"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for size, percent in ((3, 90), (5, 80)):
        # Rules travel with the tasks; the module's constant is read where pairs are made.
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_groups(spark, df, size, percent).collect()}
        assert got == brute_groups(rows, size, percent)
    t = table("documents")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op4_ngram_jaccard_join(spark, SF).collect()}
    assert got == brute_groups(list(zip(t["doc_id"], t["text"])), 3, 90)


def test_ngram_join_agrees_with_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLE["op4_ngram_jaccard_join"]).fetchall())
    assert sorted(tuple(r) for r in queries.op4_ngram_jaccard_join(spark, SF).collect()) == want


def test_ngram_join_edges(spark, odd, empty):
    assert ngram_join.link_groups(spark, empty).count() == 0
    out = ngram_join.keep_one(spark, odd)
    ids = [r["doc_id"] for r in out.collect()]
    assert out.columns == odd.columns and sorted(x for x in ids if x) == [1, 2, 3, 4, 5, 6, 8] and None in ids


# 6 ------------------------------------------------------------------------------------------------


def check_pieces(rows, texts, tokenizer):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, t in texts.items():
        ids, at = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4"), 0
        for p in sorted(by[i], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(ids[at : at + p["length"]].tobytes()))
            at += p["length"]
        assert at == len(ids)
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and at & (at - 1) == 0, "a sequence that would be padded"


def test_packing(spark, odd, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = table("documents")
    check_pieces(queries.op6_packing(spark, SF).collect(), dict(zip(t["doc_id"], t["text"])), Tokenizer.from_file(path))
    assert packing.pack(spark, empty, path).count() == 0
    got = packing.pack(spark, odd.where("doc_id is not null and doc_id <> 6"), path).collect()
    check_pieces(got, {r[0]: r[1] for r in ODD if r[0] not in (None, 6)}, Tokenizer.from_file(path))
    assert packing.pack(spark, odd, path).where("doc_id is null").count() >= 1


def test_step_groups_are_closed_across_tasks(spark):
    docs, tokens = spark.read.parquet(f"{SF}/documents.parquet").repartition(7, "doc_id"), defaultdict(lambda: defaultdict(int))
    sizes = defaultdict(set)
    for r in packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json")).collect():
        tokens[r["tier"]][r["step_group"]] += r["length"]
        sizes[r["step_group"]].add(r["tier"])
    assert all(len(x) == 1 for x in sizes.values()) and len({r >> 32 for r in tokens[1024]}) == 1
    for groups in tokens.values():
        *whole, last = (groups[k] for k in sorted(groups))
        assert all(n == packing.STEP_TOKENS for n in whole) and 0 < last <= packing.STEP_TOKENS


def test_byte_encoder_agrees_with_the_tokenizers_library():
    e = packing.ByteEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert e.fast
    for t in ("", None, "a <|endoftext|> b", "café́ \U0001f600\r\n\t x", " " * 3000 + "x", "a" * 20000, "'S 'll 12½"):
        assert list(e.encode(t)) == e.tokenizer.encode(t or "", add_special_tokens=False).ids


# 7 ------------------------------------------------------------------------------------------------


def test_token_records_round_trip(spark, odd, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, t = Tokenizer.from_file(path), table("documents")
    start = 0
    got = sorted(queries.op7_token_records(spark, SF).collect(), key=lambda r: r["start"])
    for (i, text), r in zip(sorted(zip(t["doc_id"], t["text"])), got, strict=True):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    out = scratch.new_path(spark, "records")
    token_records.write(spark, odd, path, 2, out, shard_mb=0.01)
    # Records are read by the stored index alone.
    index = pq.read_table(out.removeprefix("file:") + "/index").to_pylist()
    index.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in index] == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8]
    for r in index:
        doc, ids = token_records.read_record(spark, out, r["shard"], r["offset"], r["bytes"])
        text = next(x[1] for x in ODD if x[0] == doc)
        assert doc == r["doc_id"] and list(ids) == tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (len(ids), zlib.crc32(ids.astype("<u4").tobytes())) == (r["n_tokens"], r["ids_crc32"])
    out = scratch.new_path(spark, "none")
    token_records.write(spark, empty, path, 2, out)
    assert token_records.index(spark, out).count() == 0


@pytest.mark.parametrize("doc_id", [7, None])
def test_token_records_of_one_doc_id_take_several_shards(spark, doc_id):
    rows = [(doc_id, "the same words in every row and a few more to fill it") for _ in range(3000)] + [(k, f"row {k}") for k in range(8, 108)]
    out = scratch.new_path(spark, "records")
    token_records.write(spark, spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"), 2, out, shard_mb=0.01)
    index = sorted(token_records.index(spark, out).collect(), key=lambda r: r["start"])
    assert len({r["shard"] for r in index if r["doc_id"] == doc_id}) > 3
    assert [r["doc_id"] for r in index] == [doc_id] * 3000 + list(range(8, 108))
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(index, index[1:]))


def test_frames_refuse_damage():
    data = token_records.frame(b"12345678ab") + b"\n"
    assert [b for _, b in token_records.frames(data)] == [b"12345678ab"]
    for i in range(len(data)):
        with pytest.raises(ValueError):
            list(token_records.frames(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :]))


def test_word_encoder_on_odd_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    e = token_records.WordEncoder(path, True)
    assert e.bare
    texts = ["a b C'S don't\x1c\x85x é ́a <|endoftext|>foo <|startoftext|> x", "", None, "İstanbul ΑΣ. 12345 ½ ﬁ  z", "日本語\t\r\n'll 'LL", "a\x00b ﻿x \U0001f600", "ÉTÉ!! (x) *** a--b c,d"]
    for t, ids in zip(texts * 2, e.encode(texts * 2), strict=True):
        assert list(ids) == e.tokenizer.encode(t or "", add_special_tokens=False).ids, t


# 8 ------------------------------------------------------------------------------------------------


def test_template_is_reversible():
    rng, parts = random.Random(1), ["\\", "#", "###", "</turn>", " ", "\n", ":", "a", "B", "### Assistant: ", " </turn>\n", "="]
    for _ in range(4000):
        turns = [(rng.choice(["user", "assistant", "", "".join(rng.choices(parts, k=3))]), "".join(rng.choices(parts, k=rng.randint(0, 8)))) for _ in range(rng.randint(1, 3))]
        window = "".join(chat_format.render(*t)[0] for t in turns)
        assert [(r, chat_format.unescape(window[a:b])) for r, a, b in chat_format.parse(window)] == turns


def test_chat_windows(spark):
    t = table("conversations")
    by = defaultdict(list)
    for c, n, role, text in sorted(zip(t["conv_id"], t["turn"], t["role"], t["text"])):
        by[c].append((role, text))
    by[-7] = [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]
    got = {r["conv_id"]: r for r in queries.op8_chat_formatting(spark, SF).collect()}
    assert got.keys() == by.keys()
    for c, turns in by.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_windows_keep_the_budget_and_repeat_the_system_turn(spark):
    turns = [(1, 0, "system", "be kind")] + [(1, k, "user" if k % 2 else "assistant", f"turn number {k} says this") for k in range(1, 60)] + [(2, 0, None, None), (None, 1, "user", "x"), (2, 0, "user", "big " * 500)]
    schema, path = "conv_id long, turn long, role string, text string", public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame(turns, schema).selectExpr("*", "1 AS window", "'x' AS loss", "true AS n_tokens")
    windows = chat_format.format_windows(spark, df, path, budget=100, history_budget=30).orderBy("conv_id", "window").collect()
    mine = [w for w in windows if w["conv_id"] == 1]
    assert len(mine) > 3 and all(w["n_tokens"] <= 100 and w["text"].startswith("### System: be kind </turn>\n") for w in mine)
    assert all(w["n_repeated"] > 1 for w in mine[1:])
    back = {r["conv_id"]: r for r in chat_format.read_back(spark, chat_format.format_windows(spark, df, path, 100, 30)).collect()}
    assert {c: r["n_turns"] for c, r in back.items()} == {1: 60, 2: 2, None: 1}
    assert back[1]["loss_chars"] == sum(len(x[3]) for x in turns if x[0] == 1 and x[2] == "assistant")
    assert chat_format.read_back(spark, chat_format.format_windows(spark, df.limit(0), path)).count() == 0
    count = lambda t: packing.encoder_of(path).encode(t).size
    for w in windows:
        written = [chat_format.render(r, w["text"][a:b])[0] for r, a, b in chat_format.parse(w["text"])]
        assert w["n_tokens"] == sum(map(count, written))
    # A system turn that doesn't fit beside a long turn is left out there alone; a very long turn stands whole.
    turns = [(1, 0, "system", "rule " * 40), (1, 1, "user", "a"), (1, 2, "assistant", "word " * 70), (1, 3, "user", "b"), (1, 4, "assistant", "long " * 3000), (1, 5, "user", "c")]
    windows = chat_format.format_windows(spark, spark.createDataFrame(turns, schema), path, budget=100, history_budget=0).orderBy("window").collect()
    assert [w["text"].startswith("### System") for w in windows] == [True, False, False, True]
    assert "long " * 3000 in windows[2]["text"]


# 9 ------------------------------------------------------------------------------------------------


def test_quality_rules_statistics_and_verdicts(spark, odd, empty):
    t = table("documents")
    texts = dict(zip(t["doc_id"], t["text"]))
    got = {r["doc_id"]: r for r in queries.op9_quality_rules(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        w = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        count, covered = Counter(windows), set()
        for k, x in enumerate(windows):
            if count[x] > 1:
                covered.update(range(k, k + 8))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(text.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and (not r["kept"] or not r["base_failed"])
    labels = table("labels")
    bad = [not got[i]["kept"] for i, q in zip(labels["doc_id"], labels["quality"]) if q == 0]
    good = [got[i]["kept"] for i, q in zip(labels["doc_id"], labels["quality"]) if q == 1]
    assert sum(bad) >= 0.8 * len(bad) and sum(good) >= 0.9 * len(good)
    assert quality_rules.assess(spark, empty).count() == 0 and quality_rules.keep_good(spark, empty).count() == 0
    assert quality_rules.assess(spark, odd).count() == len(ODD) and quality_rules.keep_good(spark, odd).columns == odd.columns


# 10 -----------------------------------------------------------------------------------------------


def test_quality_classifier_on_held_out_labels(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    labels = pq.read_table(f"{sf}/labels.parquet").to_pydict()
    got = {r["doc_id"]: r for r in queries.op10_quality_classifier(spark, sf).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in got.items())
    held = [(got[i]["predicted"], q) for i, q in zip(labels["doc_id"], labels["quality"]) if got[i]["held_out"]]
    assert sum(p == q for p, q in held) >= 0.9 * len(held)
    known = spark.createDataFrame([(4, 1), (5, None), (None, 0), (6, 1)], "doc_id long, quality int")
    assert quality_classifier.classify(spark, odd, known).count() == len(ODD)
    assert quality_classifier.classify(spark, empty, known.limit(0)).count() == 0


def test_features_do_not_depend_on_the_batch():
    texts = ["A b a\n\na b a", "", None, "x", " \n ", "café | <b> 12!", "w " * 50]
    whole = quality_classifier.features(pa.array(texts))
    assert np.allclose(whole, np.concatenate([quality_classifier.features(pa.array([t], pa.string())) for t in texts]))


# pipeline -----------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = scratch.save(spark, stage(spark, docs, SF), name)
        assert new.columns == documents.columns and 0 < new.count() <= docs.count()
        docs = new
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    benchmark = [decontaminate.normal(x) for x in table("benchmark")["text"]]
    assert not any(n in decontaminate.normal(t) for t in kept.values() for n in benchmark)
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p["doc_id"] for p in pieces} == set(kept)
