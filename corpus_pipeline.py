"""The corpus pipeline: language, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written and read again before the next one starts, so
that a lost executor costs at most a stage's open tasks. All but the last give the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import bpe, decontaminate, langid, ngram_join, rlz
from sieveline.llm._spark import Work


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (without a letter) go; a missing lang is filled."""
    return langid.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that with the least doc_id."""
    return ngram_join.one_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a window of 35 words that also starts elsewhere go from the texts; every row stays."""
    return rlz.remove(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and their digests."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language identification", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", tokens),
]

#: String kernels and byte-pair merges aren't SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, work.keep(stage(spark, docs, sf_dir), f"stage{k}")
        work.drop(before)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
