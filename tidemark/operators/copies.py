"""Rows that occur often: counted once, written out again by several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

COPY_CHUNK = 1_000_000    # copies of one row that one task may write out


def expand_copies(counted: DataFrame, n: str, out: str, chunk: int = COPY_CHUNK) -> DataFrame:
    """Write out every row ``n`` times, numbered 1..n in ``out``; a row with more than ``chunk``
    copies is written out by several tasks."""
    columns, c = counted.columns, F.col(n)
    one = F.lit(1).cast("bigint")
    few = counted.where(c <= chunk).select(*columns, F.explode(F.sequence(one, c)).alias(out))
    first = F.col("_part") * chunk + 1
    many = (counted.where(c > chunk)
            .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                      F.floor((c - 1) / chunk))))
            .repartition(*columns, "_part")
            .select(*columns, F.explode(
                F.sequence(first, F.least(first + chunk - 1, c))).alias(out)))
    return few.unionByName(many)
