"""Latest row per key, and exact samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def dedup_latest(df: DataFrame, keys: list[str], latest: list[Column | str]) -> DataFrame:
    """One row per key: the one with the greatest ``latest`` columns (NULLs count as oldest).

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the shuffle,
    so a key with very many copies never gathers in one task.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in latest]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(newest))
            .where(F.col("_rank") == 1).drop("_rank"))


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42, sorted_rows: int = 100_000) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), the same on every run: the smallest md5s.

    A row without a key is hashed by its content. A histogram of three digits of the hash (4,096
    counters) finds the digit group in which the n-th row lies; while that group has more than
    ``sorted_rows`` rows the next three digits cut it again. Groups below are taken whole and in
    parallel; only the last group is sorted for the rest. The answer does not depend on ``sorted_rows``.
    """
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null:"), F.xxhash64(*df.columns).cast("string")))
    hashed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), name)))
    prefix, before = "", 0
    for digits in range(3, 33, 3):
        group = F.substring("_h", 1, digits)
        counts = hashed.where(F.col("_h").startswith(prefix)).groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n"))
        edge = None
        for row in sorted(counts.collect()):  # at most 4,096 counters
            if before + row["n"] >= n:
                edge = row
                break
            before += row["n"]
        if edge is None:
            return df
        prefix, size = edge["g"], edge["n"]
        if size <= sorted_rows:
            break
    whole = hashed.where(F.substring("_h", 1, len(prefix)) < prefix)
    others = [c for c in df.columns if c != key]
    rest = hashed.where(F.col("_h").startswith(prefix)).orderBy("_h", key, *others).limit(n - before)
    return whole.unionByName(rest).drop("_h")


def fraction_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows; no shuffle."""
    return df.sample(False, fraction, seed)
