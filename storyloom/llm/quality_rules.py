"""Quality rules as weak supervision: each rule votes good, bad or abstains; expectation-maximisation over the counts of
vote patterns estimates the rules' accuracies, and a document's posterior probability of being good decides.

Everything is built-in column functions. The counts of vote patterns have at most 3 ** len(RULES) rows whatever the
corpus holds; each EM step is one aggregate over them that returns one row of parameters to the driver.

Defined results: a null or empty text has no words, fails the base rule and isn't kept. Repeated rows, ties and null
doc_ids are scored row by row like any other. An empty table gives the starting model and no rows. Columns beside
doc_id and text are carried by keep_good() whatever their names, and ignored elsewhere."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import scratch

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def without(c: Column, chars: str) -> Column:
    """The text with each of these characters removed."""
    for x in chars:
        c = F.replace(c, F.lit(x), F.lit(""))
    return c


def occurrences(c: Column, ascii_text: str) -> Column:
    return (F.octet_length(c) - F.octet_length(F.replace(c, F.lit(ascii_text), F.lit("")))) / len(ascii_text)


def pairwise(name: str, step: int) -> Column:
    """Element i with element i + step, hashed together; past the end there is nothing to add."""
    return F.transform(name, lambda x, i: F.xxhash64(x, F.get(F.col(name), i + step)))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the statistics that the rules read. Each array that a later step reads twice is a column of its own, so that
    Catalyst computes it once."""
    t = F.col("_t")
    d = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    d = d.withColumn("_w", F.filter(F.split(t, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != ""))
    d = d.withColumn("_l", F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0))
    d = d.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(without(t, WHITE)).cast("long"),
        "n_symbols": sum((occurrences(t, s) for s in SYMBOLS), F.lit(0)).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_distinct": F.size(F.array_distinct("_w")).cast("long"),
        "n_exclaim": occurrences(t, "!").cast("long"),
        "n_shout": F.regexp_count(t, F.lit("[A-Z]{4,}")).cast("long"),
        "n_ends": F.regexp_count(t, F.lit("[.?!](?=\\s|$)")).cast("long"),
        "_h": F.transform("_w", lambda w: F.xxhash64(w)),
    }).drop("_t", "_l", "_w")
    d = d.withColumn("_h", pairwise("_h", 1)).withColumn("_h", pairwise("_h", 2)).withColumn("_h", pairwise("_h", 4))
    d = d.withColumn("_h", F.when(F.col("n_words") >= WINDOW, F.slice("_h", F.lit(1), F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int"))))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    d = d.withColumn("_s", F.when(twice, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_h")
    same = lambda x, other: F.coalesce(F.get(F.col("_s"), other)["h"] == x["h"], F.lit(False))
    d = d.withColumn("_p", F.sort_array(F.transform(F.filter("_s", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))).drop("_s")
    covers = F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_p"), i + 1) - p, F.lit(WINDOW))))
    return d.withColumn("n_repeat_words", F.coalesce(F.aggregate(covers, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("_p")


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def _per_word(name: str) -> Column:
    return F.col(name) / F.greatest(F.col("n_words"), F.lit(1))


def votes() -> dict[str, Column]:
    """The rules over statistics(): 1 good, -1 bad, 0 abstains."""
    n, long_enough = F.col("n_words"), F.col("n_words") >= 40
    return {
        "length": _vote(n < 20, n >= 60),
        "word_length": _vote((_per_word("word_chars") < 2) | (_per_word("word_chars") > 14), (_per_word("word_chars") > 3) & (_per_word("word_chars") < 9)),
        "symbols": _vote(_per_word("n_symbols") > 0.25, _per_word("n_symbols") < 0.05),
        "dup_lines": F.when(F.col("n_lines") < 3, 0).otherwise(_vote(F.col("n_dup_lines") > 0.3 * F.col("n_lines"), F.col("n_dup_lines") < 0.1 * F.col("n_lines"))),
        "repeats": _vote(_per_word("n_repeat_words") > 0.25, _per_word("n_repeat_words") < 0.1),
        "shouting": _vote(_per_word("n_shout") > 0.25, _per_word("n_shout") < 0.05),
        "exclaiming": _vote(_per_word("n_exclaim") > 0.25, _per_word("n_exclaim") < 0.05),
        "vocabulary": F.when(~long_enough, 0).otherwise(_vote(F.col("n_distinct") < 2 * F.sqrt(n), F.col("n_distinct") > 4 * F.sqrt(n))),
        "sentences": F.when(~long_enough, 0).otherwise(_vote(_per_word("n_ends") < 0.01, (_per_word("n_ends") > 0.02) & (_per_word("n_ends") < 0.5))),
    }


RULES = ("length", "word_length", "symbols", "dup_lines", "repeats", "shouting", "exclaiming", "vocabulary", "sentences")


#: Where EM starts: how often a rule that votes says bad on a good document, and on a bad one.
START = (0.002, 0.3)
#: What is known of such rules beforehand: they are written so as to misfire on at most this share of good documents,
#: and each kind of badness that they name is at least this share of all badness. Without these bounds the classes of
#: EM may settle on any correlation between statistics, such as that of short texts.
MISFIRE_MAX, CATCH_MIN = 0.002, 0.15


@dataclass
class RuleModel:
    """Share of good documents, and each rule's accuracy: how often it says bad, when it votes, by true class."""

    prior: float = 0.8
    on_good: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RULES, START[0]))
    on_bad: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RULES, START[1]))
    steps: int = 0

    def posterior(self) -> Column:
        """Probability that a document with votes in columns v_<rule> is good. A rule that abstains says nothing."""
        score = F.lit(math.log(self.prior / (1 - self.prior)))
        for r in RULES:
            g, b = self.on_good[r], self.on_bad[r]
            score = score + F.when(F.col(f"v_{r}") < 0, math.log(g / b)).when(F.col(f"v_{r}") > 0, math.log((1 - g) / (1 - b))).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def fit(spark: SparkSession, voted: DataFrame, steps: int = 15, settled: float = 1e-3) -> RuleModel:
    """EM over the counts of vote patterns, within the bounds above and a share of good documents of 0.05 to 0.9; added
    counts keep all odds finite."""
    patterns = scratch.save(spark, voted.groupBy(*(f"v_{r}" for r in RULES)).agg(F.count("*").alias("c")).coalesce(1), "vote-patterns")
    model = RuleModel()
    for step in range(steps):
        p, c = F.col("p"), F.col("c")
        sums = [F.sum(c).alias("n"), F.sum(c * p).alias("good")]
        sums += [F.sum(F.when(F.col(f"v_{r}") == v, c * w)).alias(f"{k}{v}_{r}") for r in RULES for v in (-1, 1) for k, w in (("g", p), ("b", 1 - p))]
        row = patterns.withColumn("p", model.posterior()).agg(*sums).first()
        if not row["n"]:
            break
        new = RuleModel(min(0.9, max(0.05, row["good"] / row["n"])), steps=step + 1)
        for r in RULES:
            g, b = ((x := (row[f"{k}-1_{r}"] or 0.0) + 20 * s) / (x + (row[f"{k}1_{r}"] or 0.0) + 20 * (1 - s)) for k, s in zip("gb", START, strict=True))
            new.on_good[r], new.on_bad[r] = min(g, MISFIRE_MAX), max(b, CATCH_MIN)
        moved = max(abs(x - y) for r in RULES for x, y in ((new.on_good[r], model.on_good[r]), (new.on_bad[r], model.on_bad[r])))
        model = new
        if moved < settled:
            break
    return model


def vote(docs: DataFrame, text: str = "text") -> DataFrame:
    """Statistics and votes of each row."""
    return statistics(docs, text).withColumns({f"v_{r}": c for r, c in votes().items()})


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def assess(spark: SparkSession, docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the statistics, base_failed, p_good (posterior) and kept of each row of docs (doc_id, text). Statistics
    and votes are written once and read by the model and by the result."""
    wanted = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    voted = scratch.save(spark, vote(docs.select("doc_id", "text")).select(*wanted, *(f"v_{r}" for r in RULES)), "votes")
    model = fit(spark, voted)
    return voted.select(*wanted, base_failed().alias("base_failed"), model.posterior().alias("p_good")).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def keep_good(spark: SparkSession, docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that are kept, with all their columns. They are written once with their votes, which takes far less than
    making the statistics again."""
    whole = docs.select(F.struct("*").alias("_doc")).withColumn("_text", F.col("_doc.text"))
    voted = vote(whole, "_text").select("_doc", base_failed().alias("_failed"), *(f"v_{r}" for r in RULES))
    voted = scratch.save(spark, voted, "voted-documents")
    model = fit(spark, voted)
    return voted.where(~F.col("_failed") & (model.posterior() >= threshold)).select("_doc.*")
