"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontam, fingerprints, lattice_lm, lexical, merkle, neardup, pieces, preference, quality, sharding, substrings, token_files
from tidemark.llm.ship import ship
from tidemark.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = shipped
    return shipped


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_sharding(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir), 16)


@query
def op2_decontamination(spark, sf_dir):
    return decontam.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op3_substring_dedup(spark, sf_dir):
    return substrings.removal_digests(documents(spark, sf_dir), window=13)


@query
def op4_quality_classifier(spark, sf_dir):
    return quality.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op5_lattice_lm(spark, sf_dir):
    return lattice_lm.score_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_byte_bpe(spark, sf_dir):
    return bpe.encode_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                              public_tokenizers.PATTERN)


@query
def op7_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_edits(documents(spark, sf_dir))


@query
def op8_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(documents(spark, sf_dir), width=3, share=85)


@query
def op9_token_files(spark, sf_dir):
    path = scratch_dir(spark, "token-files")
    token_files.write(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path)


@query
def op10_preference_format(spark, sf_dir):
    return preference.preferences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op11_sentencepiece(spark, sf_dir):
    return pieces.encode_digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_lexical_search(spark, sf_dir):
    return lexical.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)


@query
def op13_merkle_manifest(spark, sf_dir):
    return merkle.verified(documents(spark, sf_dir))
