"""Personal data by patterns, and by contexts that they teach: bootstrapped extraction in column functions only.

Base. Emails, IPv4 addresses, card numbers and phone numbers are matches of fixed expressions, leftmost and not overlapping
per kind, that pass a check (parts, Luhn, number of digits). The expressions are written so that Java's matcher needs time
in proportion to the text: possessive, and begun only where a match can begin. Spark's functions give a match's text but
not its place, so places come from the lengths of the pieces between matches.

Bootstrap. Seeds are the base spans. Identifiers are runs: a token with a digit or an at sign, and the tokens of digits and
marks that follow it on its line after single spaces, so that `+1 415-555-0101` or a card in groups of four is one. Runs that
overlap a base span are seed instances, the others unknown ones. The word before a run and the word after it, each with the
run's shape (at sign, letters, or digits by their number), are lexical patterns; no word is no pattern. The graph of distinct
(pattern, instance) links is scored in turns: a pattern by the share of its instances' scores, damped for little support; an
instance that is no seed by its best pattern. After ROUNDS turns, patterns of at least `confidence`, met with at least SUPPORT
distinct seeds, report the other instances' occurrences of LEAST characters or more as `context` spans. Patterns and
instances are 64-bit hashes; all counts are aggregates over all documents.

Defined results: a null or empty text has no spans. Repeated rows each have theirs. A null doc_id stays null. An empty table
gives no rows. Spans are in code points, the end exclusive. Only doc_id and text are read, whatever else there is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import scratch

KINDS = ("email", "ip", "card", "phone", "context")
#: The base expressions. An email begins where its run of characters does, or where the last match ended.
EXPRESSIONS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Runs: a token with a digit or an at sign, then tokens of digits and marks on the same line.
TOKEN = r"(?<!\S)(?=[^0-9@\s]*+[0-9@])\S++(?:\x20(?=[(+]*+[0-9])[0-9().,+/-]++(?!\S))*+"
WHITE, QUOTES = " \t\n\x0b\x0c\r", "\"'([{<>}])"
MARKS = ".,;:!?\"'()[]{}<>|*#$%&="
ROUNDS, SUPPORT, DAMPING = 3, 5, 1.0
#: Characters of the shortest identifier that is reported by its context.
LEAST = 5
_SPANS = "array<struct<start:int,end:int,m:string>>"


def _matches(d: DataFrame, name: str, expression: str, gate: Column) -> DataFrame:
    """Adds _g_<name> (the pieces between matches, one more than these) and _m_<name> (the matches)."""
    return d.withColumns({f"_g_{name}": F.when(gate, F.split("_t", expression, -1)), f"_m_{name}": F.when(gate, F.regexp_extract_all("_t", F.lit(expression), F.lit(0)))})


def _steps(name: str) -> Column:
    """Each match with the length of the piece before it."""
    return F.transform(f"_m_{name}", lambda x, i: F.struct(F.length(F.get(F.col(f"_g_{name}"), i)).alias("g"), x.alias("m")))


def _placed(name: str) -> Column:
    """Spans of the steps in column _z_<name>: each begins after all pieces and matches before it. Appending copies what
    is there, so the n steps are placed in blocks of sqrt(n), and the blocks then: n to the power of 1.5 in all."""
    z = F.col(f"_z_{name}")
    block = F.ceil(F.sqrt(F.size(z))).cast("int")
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def add(a: Column, x: Column) -> Column:
        begin = a["at"] + x["g"]
        end = begin + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("m")))).alias("out"))

    def join(a: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda s: F.struct((s["start"] + a["at"]).alias("start"), (s["end"] + a["at"]).alias("end"), s["m"].alias("m")))
        return F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["out"], moved).alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), block - 1), lambda b: F.aggregate(F.slice(z, b * block + 1, block), start, add))
    return F.when(F.size(z) > 0, F.aggregate(blocks, start, join, lambda a: a["out"]))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _passes(name: str, m: Column) -> Column:
    if name == "ip":
        return F.forall(F.split(m, "\\."), lambda p: F.when(F.length(F.regexp_replace(p, "^0+", "")) <= 3, F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255).otherwise(F.lit(False)))
    if name == "card":
        return F.length(_digits(m)).between(12, 19) & _luhn(_digits(m))
    if name == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _checker(name: str):
    return lambda s: _passes(name, s["m"])


def _of_kind(k: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"))


def _written(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def base(docs: DataFrame) -> DataFrame:
    """doc_id, thash (of the text), the counts, spans (array of start, kind, end), and tokens with their contexts."""
    t = F.col("_t")
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    digits = t.rlike("[0-9]")
    gates = {"email": F.contains(t, F.lit("@")), "ip": digits & F.contains(t, F.lit(".")), "card": digits, "phone": digits & F.contains(t, F.lit("+"))}
    for name, expression in EXPRESSIONS.items():
        d = _matches(d, name, expression, gates[name])
    d = _matches(d, "token", TOKEN, digits | F.contains(t, F.lit("@")))
    d = d.withColumns({f"_z_{name}": _steps(name) for name in (*EXPRESSIONS, "token")})
    spans, counts = [], {}
    for k, name in enumerate(EXPRESSIONS):
        d = d.withColumn(f"_s_{name}", F.filter(_placed(name), _checker(name)))
        counts[f"n_{name}"] = F.coalesce(F.size(F.col(f"_s_{name}")), F.lit(0)).cast("long")
        spans.append(F.coalesce(F.transform(f"_s_{name}", _of_kind(k)), F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    d = d.withColumns({"_placed": _placed("token"), "spans": F.concat(*spans), **{n: F.greatest(c, F.lit(0)) for n, c in counts.items()}})
    g = F.col("_g_token")

    def token(s: Column, i: Column) -> Column:
        m = F.ltrim(s["m"], F.lit(MARKS))
        begin = s["start"] + F.length(s["m"]) - F.length(m)
        m = F.rtrim(m, F.lit(MARKS))
        digits = F.length(_digits(m))
        shape = F.when(F.contains(m, F.lit("@")), "@").when(m.rlike("[A-Za-z]"), "a").when(digits < 5, "9").when(digits < 9, "99").otherwise("999")
        # A gap's last white space is taken off first, so that the expression is tried at one place only.
        before = F.regexp_extract(F.rtrim(F.get(g, i), F.lit(WHITE)), r"(\S++)\z", 1)
        after = F.regexp_extract(F.get(g, i + 1), r"\A\s*+(\S++)", 1)
        pattern = lambda side, word: F.when(word != "", F.xxhash64(F.lit(side), shape, F.lower(F.rtrim(F.ltrim(word, F.lit(QUOTES)), F.lit(QUOTES)))))
        return F.struct(begin.alias("start"), (begin + F.length(m)).alias("end"), F.xxhash64(F.lower(m)).alias("instance"), pattern("L", before).alias("left"), pattern("R", after).alias("right"))

    d = d.withColumn("tokens", F.transform("_placed", token))
    return d.select("doc_id", F.xxhash64("_t").alias("thash"), *counts, "spans", "tokens")


def _discovered(spark: SparkSession, found: DataFrame, confidence: float) -> DataFrame:
    """(doc_id, thash, more): the context spans."""
    within = F.exists("spans", lambda s: (s["start"] < F.col("t.end")) & (F.col("t.start") < s["end"]))
    seen = found.where("tokens is not null").select("doc_id", "thash", "spans", F.explode("tokens").alias("t"))
    seen = seen.select("doc_id", "thash", "t.*", within.alias("seed"))
    seen = scratch.save(spark, seen, "pii-tokens")
    links = seen.select("instance", "seed", F.explode(F.array("left", "right")).alias("pattern")).where("pattern is not null")
    links = scratch.save(spark, links.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-graph")
    scores = links.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for k in range(ROUNDS):
        known = scratch.save(spark, scores, "pii-scores")
        scored = links.join(known, "instance")
        patterns = scored.groupBy("pattern").agg((F.sum("score") / (F.count("*") + DAMPING)).alias("p"), F.sum(F.col("seed").cast("int")).alias("support"))
        patterns = scratch.save(spark, patterns.where(f"support >= {SUPPORT}"), "pii-patterns")
        best = links.join(patterns, "pattern", "left").groupBy("instance").agg(F.greatest(F.max(F.col("seed").cast("double")), F.coalesce(F.max("p"), F.lit(0.0))).alias("score"))
        scores = best
    good = patterns.where(F.col("p") >= confidence).select(F.col("pattern").alias("left"))
    plain = seen.where(f"not seed and end - start >= {LEAST}")
    met = plain.join(good, "left", "left_semi").select("doc_id", "thash", "start", "end").union(plain.join(good.withColumnRenamed("left", "right"), "right", "left_semi").select("doc_id", "thash", "start", "end"))
    return met.groupBy("doc_id", "thash").agg(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end")).alias("more"))


def extract(spark: SparkSession, documents: DataFrame, confidence: float = 0.9) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_context of each document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = scratch.save(spark, base(docs), "pii-base")
    more = _discovered(spark, found, confidence).select(F.col("doc_id").alias("_d"), F.col("thash").alias("_h"), "more")
    met = found.join(more, found.doc_id.eqNullSafe(F.col("_d")) & (found.thash == F.col("_h")), "left")
    more = F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    return met.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(_written(F.col("spans")).cast("binary"), 256).alias("base_sha256"), _written(F.concat("spans", more)).alias("spans"), F.size(more).cast("long").alias("n_context"))
