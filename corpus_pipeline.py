"""Corpus pipeline over documents: quality rules, line dedup, n-gram Jaccard join, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the columns
of documents. The similarity of the third stage is that of near-duplicates: five words, 0.8."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from storyloom.llm import decontaminate, line_dedup, ngram_join, packing, quality_rules, scratch
from storyloom.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    return quality_rules.keep_good(spark, docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and nearly equal lines one stays."""
    return line_dedup.drop_lines(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    return ngram_join.keep_one(spark, docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full training sequences."""
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_duplicates), ("decontamination", decontamination), ("packing", pack)]

#: SQL can express neither the EM-weighed rules nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
