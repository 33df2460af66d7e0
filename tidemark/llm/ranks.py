"""Gapless places of rows in a sort order, without a window over more than a summary of each range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.scratch import stored

#: monotonically_increasing_id() keeps the partition's number above this many bits.
_PLACE_BITS = 33


def placed(df: DataFrame, group: str | None, order: list[Column], name: str) -> DataFrame:
    """df, stored, with `place` (from 0 within the group, in the given order) and `places` (rows of the group).

    Rows are sorted by ranges of (group, order); rows that are equal there may lie in several ranges, so no value is too
    frequent. A group has one summary row for each range it reaches into; only these are added up in a window. df should be
    cheap to evaluate twice, as the ranges are found by a sample of it.
    """
    keys = ([F.col(group).asc_nulls_first()] if group else []) + order
    salted = df.withColumn("__salt", F.monotonically_increasing_id())
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = salted.repartitionByRange(n, *keys, F.col("__salt")).sortWithinPartitions(*keys, F.col("__salt"))
    rows = stored(ranged.drop("__salt").withColumn("__at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("__part", F.shiftright("__at", _PLACE_BITS))
    of = [group] if group else []
    ends = rows.groupBy(*of, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy(*of) if of else Window.partitionBy(F.lit(0))
    ahead = F.coalesce(F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.select(*[F.col(c).alias("__group") for c in of], F.col("__part").alias("__range"),
                       (ahead - F.col("__first")).alias("__shift"), F.sum("__n").over(whole).alias("places"))
    same = F.col("__part") == F.col("__range")
    if group:
        same &= F.col(group).eqNullSafe(F.col("__group"))
    return (rows.join(ends, same).withColumn("place", F.col("__at") + F.col("__shift"))
            .drop("__at", "__part", "__range", "__shift", "__group"))
