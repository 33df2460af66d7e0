"""Rendezvous hashing of record keys over weighted shards, and gapless numbers within groups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Hexadecimal digits of an md5 that make a number; 13 are 52 bits, exact in a double.
_DIGITS = 13


def uniform(text: Column) -> Column:
    """A number in (0, 1) that any engine can compute from the text: the first 52 bits of its md5."""
    whole = F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("double")
    return (whole + F.lit(0.5)) / F.lit(float(16**_DIGITS))


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard with the highest score -weight / ln(u(key, shard)); the lower number wins a tie.

    Only the key, the shard's number and its weight decide a score. So a shard that is added, or whose
    weight grows, takes keys into itself alone, and one that goes gives its own keys to all others.
    A null key counts as the empty text. Shards of weight 0 get nothing.
    """
    if not any(w > 0 for w in weights.values()):
        raise ValueError("no shard has a weight above 0")
    name = F.coalesce(key.cast("string"), F.lit(""))
    bids = [F.struct((F.lit(-float(w)) / F.log(uniform(F.concat(name, F.lit(f":{shard}"))))).alias("score"),
                     F.lit(-shard).alias("shard")) for shard, w in sorted(weights.items()) if w > 0]
    best = F.greatest(*bids) if len(bids) > 1 else bids[0]
    return (-best["shard"]).cast("int")


def shard(df: DataFrame, key: str, weights: Mapping[int, float], out: str = "shard") -> DataFrame:
    """df with the shard of each row: a narrow map without a shuffle; rows with one key share a shard.

    Nothing else of a row matters: null or very long texts, repeated rows and an empty table all do.
    An existing column of the name `out` is replaced.
    """
    return df.withColumn(out, rendezvous(F.col(key), weights))


def number_within(df: DataFrame, group: list[str], key: str, order: list[str], out: str,
                  digits: int = 3) -> DataFrame:
    """df with a gapless number from 0 within each group, in the order of a block and the columns `order`.

    The block is the first hexadecimal digits of the md5 of the key. Blocks are counted, the counts added up
    to offsets (at most 16**digits rows a group), and rows are numbered in their block alone, so that a
    group with a third of all rows is spread over all tasks. Rows equal in key and order are
    interchangeable; null keys count as the empty text.
    """
    block = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, digits)
    rows = df.withColumn("__block", block)
    keys = [*group, "__block"]
    before = Window.partitionBy(*group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(*keys).agg(F.count("*").alias("__n"))
               .select(*[F.col(k).alias(f"{k}__o") for k in keys],
                       F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = [F.col(k).eqNullSafe(F.col(f"{k}__o")) for k in keys]
    return (ranked.join(offsets, same)
            .withColumn(out, F.col("__offset") + F.col("__rank") - 1)
            .drop("__block", "__rank", "__offset", *[f"{k}__o" for k in keys]))


def shard_documents(docs: DataFrame, n_shards: int = 16, weights: Mapping[int, float] | None = None) -> DataFrame:
    """The placement of each document: size, checksum, shard, place in the shard, shard if there were one more.

    A null text has no bytes (size 1, checksum 0). Text stays where it is read; only ids and sizes move.
    """
    weights = dict(weights or {i: 1.0 for i in range(n_shards)})
    grown = {**weights, max(weights) + 1: 1.0}
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = docs.select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), grown).alias("grown_shard"))
    return (number_within(placed, ["shard"], "doc_id", ["doc_id", "text_crc32", "size"], "slot")
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
