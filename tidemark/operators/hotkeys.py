"""Splitting of hot groups.

A window over ``partitionBy(key)`` puts all rows of one key into one task. The helpers here
find the keys that hold more than an average task's share of the rows and cut each of them along
time into slices of about equal numbers of rows, so that a window over ``(key, slice)`` does the work
and only one summary row per slice has to be looked at across slices. The answer does not depend
on which keys are called hot or how they are cut: any choice is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import instant_micros
from tidemark.operators.copies import expand_copies

SLICE = "_slice"
_STEP = 32                # bounds that are compared at once when a row's slice is looked up


def hot_keys(df: DataFrame, key: str, ts: str, floor: int | None = None) -> DataFrame | None:
    """Keys with more than ``floor`` rows and their ``_bounds``: ascending instants in microseconds at which
    their slices begin. None if there is no such key. Runs one job, two where a key is hot.

    By default the floor is the table's rows divided by the shuffle partitions: what a task has anyway. So there are
    fewer hot keys than partitions and at most some four slices for each partition, whatever the size of the table. Counts
    and quantiles combine on the map side. Bounds follow the rows, not the time: a burst is cut as often as it is large.
    Rows without instant are not cut, nor are different rows at the same microsecond.
    """
    keyed = df.select(key, ts).where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    sizes = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = sizes.agg(F.sum("_rows").alias("all"), F.max("_rows").alias("most")).first()
    if floor is None:
        floor = -(-(seen["all"] or 0) // parts)
    if (seen["most"] or 0) <= floor:
        return None
    n = 4 * parts
    found = (keyed.join(sizes.where(F.col("_rows") > floor), key)
             .groupBy(key, "_rows").agg(F.percentile_approx(instant_micros(ts), [i / n for i in range(n + 1)], 4 * n).alias("_all")))
    # A key needs four slices for each task's share that it holds: every _nth of the quantiles.
    nth = F.greatest(F.floor(F.lit(n) * max(floor, 1) / (4 * F.col("_rows"))), F.lit(1)).cast("int")
    bounds = F.array_sort(F.array_distinct(F.filter("_all", lambda x, i: i % F.col("_nth") == 0)))
    rows = found.withColumn("_nth", nth).select(key, bounds.alias("_bounds"))
    # Fewer rows than partitions, unless a caller asks for a lower floor; kept, so that every use sees the same bounds.
    return df.sparkSession.createDataFrame(rows.collect(), rows.schema)


def _slice_of(at: Column, bounds: Column) -> Column:
    """How many bounds lie at or before ``at``: first by every _STEP-th of them, then within that stretch."""
    coarse = F.size(F.filter(bounds, lambda b, i: (i % _STEP == 0) & (b <= at)))
    begin = F.greatest(coarse - 1, F.lit(0)) * _STEP
    return begin + F.size(F.filter(F.slice(bounds, begin + 1, F.lit(_STEP)), lambda b: b <= at))


def with_slice(df: DataFrame, key: str, ts: str, hot: DataFrame, how: str = "left") -> DataFrame:
    """Add ``_slice``: the number of the slice for rows of hot keys, NULL for all others
    (which ``how="inner"`` leaves out)."""
    return (df.join(F.broadcast(hot), key, how)  # fewer keys than partitions, some four bounds a partition in all
            .withColumn(SLICE, F.when(F.col("_bounds").isNotNull(), _slice_of(instant_micros(ts), F.col("_bounds"))))
            .drop("_bounds"))


def carried_in(sliced: DataFrame, key: str, states: dict[str, Column]) -> DataFrame:
    """(key, _slice, states): for each slice the maximum of each state over all earlier slices of its key.

    One row a slice; where a state should be the last value in time, let it be a struct that begins with the instant.
    """
    each = sliced.groupBy(key, SLICE).agg(*[F.max(c).alias(f"_{n}") for n, c in states.items()])
    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return each.select(key, SLICE, *[F.max(f"_{n}").over(earlier).alias(n) for n in states])


def with_next(df: DataFrame, key: str, ts: str, out: str, ties: list[str] | None = None,
              hot_rows: int | None = None) -> DataFrame:
    """``lead(ts) over (partition by key order by ts)`` that survives hot keys.

    Hot keys go their own way: copies of a row are counted, the remaining rows are windowed per
    slice with a marker row at the end of each slice that holds the first instant of the next,
    and the copies are written out again. NULL instants sort last. Building runs a job that looks for hot keys.
    """
    order = [F.col(ts).asc_nulls_last()]
    order += [F.col(c).asc_nulls_last() for c in (ties or [])]
    per_key = F.lead(ts).over(Window.partitionBy(key).orderBy(*order))
    hot = hot_keys(df, key, ts, hot_rows)
    if hot is None:
        return df.withColumn(out, per_key)
    # NULL instants close the history of their key and carry none on: apart from hot rows.
    timed = df.where(F.col(ts).isNotNull())
    cold = df.join(F.broadcast(hot.select(key)), key, "left_anti").withColumn(out, per_key)
    untimed = (df.where(F.col(ts).isNull()).join(F.broadcast(hot.select(key)), key, "left_semi")
               .withColumn(out, F.col(ts)))

    distinct = (with_slice(timed, key, ts, hot, "inner").groupBy(*df.columns, SLICE)
                .agg(F.count(F.lit(1)).alias("_copies")))
    firsts = distinct.groupBy(key, SLICE).agg(F.min(ts).alias("_first"))
    across = Window.partitionBy(key).orderBy(SLICE)
    marks = (firsts.withColumn(ts, F.lead("_first").over(across)).drop("_first")
             .where(F.col(ts).isNotNull()).withColumn("_copies", F.lit(0).cast("bigint")))
    within = Window.partitionBy(key, SLICE).orderBy(*order)
    chained = (distinct.unionByName(marks, allowMissingColumns=True)
               .withColumn(out, F.lead(ts).over(within)).where(F.col("_copies") > 0).drop(SLICE))
    copies = expand_copies(chained, "_copies", "_copy")
    # All copies but the last are followed by a copy of themselves.
    hot_rows_ = copies.withColumn(
        out, F.when(F.col("_copy") < F.col("_copies"), F.col(ts)).otherwise(F.col(out))
    ).select(*df.columns, out)
    return (cold.select(*df.columns, out).unionByName(untimed.select(*df.columns, out))
            .unionByName(hot_rows_))
