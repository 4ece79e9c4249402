"""A training corpus from ``documents``.

Quality rules, exact duplicates, near duplicates, source mix, BPE: each stage
calls one operator of ``viewlog.llm`` on all that the stage before it kept. All
but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewlog.llm import bpe, exact_dedup, mixing, ngram_join, quality
from viewlog.llm.common import documents, tokenizer_path, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.8 on five-word shingles the one with the smallest id."""
    return ngram_join.keep_one(docs, words=5, threshold=(80, 100))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.repeat_taken(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard", near_stage),
    ("mixing", mix_stage),
    ("bpe", encode_stage),
]

#: None: token ids and their digests cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
