"""The corpus pipeline: stages over documents, each written as Parquet and reread by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontam, neardup, quality, substrings
from tidemark.llm.scratch import stored
from tidemark.llm.ship import ship

#: Words that a passage must share with an earlier document to be cut.
PASSAGE_WORDS = 50


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels, accepts."""
    ship(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group (five-word shingles, similarity 0.8)."""
    ship(spark)
    return neardup.keep_one(docs, width=5, share=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller doc_id has too."""
    ship(spark)
    return substrings.cut(docs, window=PASSAGE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of each document, decoded again and compared with its text."""
    ship(spark)
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.selectExpr("doc_id", "lang", "source", "cast(size(ids) as long) as n_tokens", "ids")


STAGES = [("quality", classify), ("near-dedup", dedup), ("substring-dedup", cut_repeats),
          ("decontamination", decontaminate), ("byte-bpe", tokenize)]

#: SQL cannot express the classifier, the merges and the components; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; the last stage's table, as written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
