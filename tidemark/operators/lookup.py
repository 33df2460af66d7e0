"""Dimension lookups.

No join here carries a broadcast hint for a table whose size depends on the data, unless that size was
measured (``sent_if_small``, ``lookup_used``): Catalyst broadcasts a side whose size it has checked (``spark.sql.autoBroadcastJoinThreshold``, again at
run time under AQE) and otherwise shuffles both sides, splitting hot keys of the fact side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

NULL_SPREAD = 1024


def lookup(fact: DataFrame, dim: DataFrame, key: str, dim_key: str, row_id: str) -> DataFrame:
    """Left join of a fact to the one row of a dimension its key names; ``dim_key`` is dropped.

    The join has a second key part. It is 0 on both sides where the fact has a key. Rows without
    key cannot match and get a number drawn from their row id, so that a shuffle spreads them.
    It also keeps a dimension that is already partitioned by its key (say by the window that
    built it) from being joined as it stands: AQE splits a hot key only between two shuffles
    made for the join itself.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(row_id), F.lit(NULL_SPREAD)) + 1) \
              .otherwise(F.lit(0).cast("bigint"))
    left = fact.withColumn("_spread", spread)
    # One bucket: always 0, but not a constant that the optimizer would take out of the join.
    right = dim.withColumn("_one", F.pmod(F.xxhash64(dim_key), F.lit(1)))
    return (left.join(right.withColumnRenamed(dim_key, "_dim_key"),
                      (F.col(key) == F.col("_dim_key")) & (F.col("_spread") == F.col("_one")),
                      "left").drop("_dim_key", "_spread", "_one"))


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the rows' size in memory, measured over the data (one small job)."""
    fixed = 16
    variable = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            variable.append(F.coalesce(F.octet_length(field.name), F.lit(0)).cast("bigint"))
        fixed += 16
    size = F.lit(fixed)
    for v in variable:
        size = size + v
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]


#: Rows of a dimension, by measured_bytes, that are sent to all tasks.
SENT_BYTES = 48 << 20


def sent_if_small(df: DataFrame) -> DataFrame:
    """df, with a broadcast hint if its rows, measured by a job, are few. Catalyst's own estimate of a table that is computed
    is often too high, and what it learns at run time comes when the other side has been shuffled already."""
    return F.broadcast(df) if measured_bytes(df) <= SENT_BYTES else df


def lookup_used(fact: DataFrame, dim: DataFrame, key: str, dim_key: str, row_id: str) -> DataFrame:
    """:func:`lookup` that looks first which rows of the dimension the fact names: where these are few, they are sent to all tasks
    and the fact is not shuffled. Runs one job over the fact's key column."""
    used = dim.join(fact.select(F.col(key).alias(dim_key)).distinct(), dim_key, "left_semi")
    if measured_bytes(used) > SENT_BYTES:
        return lookup(fact, dim, key, dim_key, row_id)
    sent = F.broadcast(used.withColumnRenamed(dim_key, "_dim_key"))
    return fact.join(sent, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact keys that the dimension lacks, with the number of rows using each.

    The fact is reduced to its distinct keys (map-side combine) before it is shuffled for the
    anti join, so a hot key costs nothing.
    """
    used = (fact.where(F.col(fact_key).isNotNull())
            .groupBy(F.col(fact_key).alias("orphan_key"))
            .agg(F.count(F.lit(1)).alias("fact_rows")))
    known = dim.select(F.col(dim_key).alias("orphan_key"))
    return used.join(known, "orphan_key", "left_anti")


def broken_references(fact: DataFrame, references: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """(relation, orphan_key, fact_rows): keys of the fact that the table they point to lacks, for all its foreign keys.

    ``references``: name, (column of the fact, table, its key column). The fact is read once, whatever the number of keys: each
    row yields one pair (relation, key) a reference, the pairs are counted with a combine in every map task, and what is
    left is anti-joined with the keys of all tables together. NULL keys point nowhere and are not broken.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("relation"), F.col(column).cast("string").alias("orphan_key"))
                      for name, (column, _, _) in references.items()])
    used = (fact.select(F.inline(pairs)).where(F.col("orphan_key").isNotNull())
            .groupBy("relation", "orphan_key").agg(F.count(F.lit(1)).alias("fact_rows")))
    known = [table.select(F.lit(name).alias("relation"), F.col(key).cast("string").alias("orphan_key")) for name, (_, table, key) in references.items()]
    return used.join(reduce(DataFrame.unionByName, known), ["relation", "orphan_key"], "left_anti")
