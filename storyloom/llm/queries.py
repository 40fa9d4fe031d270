"""The operators' queries over whole tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from storyloom.llm import chat_format, decontaminate, line_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, scratch, secret_scan, token_records
from storyloom.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents that repeats another, exactly or nearly, and the one that stays."""
    return line_dedup.find(spark, table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with each item."""
    return decontaminate.find(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, by patterns and by learned contexts."""
    return pii.extract(spark, table(spark, sf_dir, "documents"))


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return ngram_join.link_groups(spark, table(spark, sf_dir, "documents"), size=3, percent=90)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by patterns and by randomness."""
    return secret_scan.scan(spark, table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in full sequences of 1024 tokens and of shorter powers of two."""
    return packing.pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query
def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document in binary record files, read back."""
    return token_records.write_and_read(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings, formatted in windows and read back from them."""
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    windows = scratch.save(spark, chat_format.format_windows(spark, turns, public_tokenizers.path("byte_bpe_50k.json")), "windows")
    return chat_format.read_back(spark, windows)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules' votes weighed by EM, for every document."""
    return quality_rules.assess(spark, table(spark, sf_dir, "documents"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by trees trained on labels that aren't held out."""
    return quality_classifier.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Documents as words (A-Z in lower case), their distinct shingles, pairs that share enough of them, and what these reach.
ORACLE["op4_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(id, seen) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.id, e.b FROM r JOIN e ON r.seen = e.a)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id FROM s JOIN (SELECT id, min(seen) AS component_id FROM r GROUP BY id) c ON c.id = s.doc_id"""
