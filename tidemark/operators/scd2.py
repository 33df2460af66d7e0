"""Slowly changing (type 2) history: build, current, as-of, as-of join, overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.contracts import OPEN_END
from tidemark.functions import instant_micros, is_open, ntz, surrogate_key
from tidemark.operators.hotkeys import SLICE, carried_in, hot_keys, with_next, with_slice
from tidemark.operators.ranges import starts_inside

FEW = 32                  # rows of a key that are held against each other: fewer than the blocks that a row lies in


def scd2(versions: DataFrame, key: str, ts: str, surrogate: str = "customer_key",
         natural: str = "customer_natural_key", hot_rows: int | None = None) -> DataFrame:
    """Turn versions into validity intervals ``[valid_from, valid_to)``.

    ``valid_to`` is the next version's instant, or the open-end sentinel for the version in
    force. Versions tying on ``ts`` are ordered by their attributes, so a rerun gives the same
    rows; all but the last of them get an empty interval.
    """
    ties = [c for c in versions.columns if c not in (key, ts)]
    chained = with_next(versions, key, ts, "_next", ties, hot_rows)
    attributes = [c for c in versions.columns if c not in (key, ts)]
    return chained.select(
        surrogate_key(key, ts).alias(surrogate),
        F.col(key).alias(natural),
        *attributes,
        F.col(ts).alias("valid_from"),
        F.coalesce(F.col("_next"), ntz(OPEN_END)).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def scd2_current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def scd2_as_of(dim: DataFrame, instant: str) -> DataFrame:
    """Versions in force at one instant; intervals are half open, an open end may be NULL."""
    at = ntz(instant)
    return dim.where((F.col("valid_from") <= at)
                     & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def scd2_asof_join(fact: DataFrame, dim: DataFrame, key: str, ts: str, take: list[str],
                   dim_key: str = "customer_natural_key", strategy: str = "merge",
                   hot_rows: int | None = None) -> DataFrame:
    """Add to every fact row the attributes ``take`` of the version in force at its instant.

    In force is, of the versions whose interval covers the instant, the one that starts last; of
    several the one that ends last, then the greatest attributes. So a fact row stays one row, on a
    damaged history too, and both strategies give the same rows at any size.

    ``merge``: facts and versions are sorted together per key and the last version seen is carried
    forward: linear however many versions a key has, hot keys are cut along time. ``search``: an
    equi-join on the key with the interval as condition, which Catalyst may broadcast; for histories
    with few versions per key.
    """
    history = dim.select(F.col(dim_key).alias("_k"), "valid_from",
                         F.coalesce("valid_to", ntz(OPEN_END)).alias("valid_to"), *take).where(F.col("_k").isNotNull())
    if strategy == "search":
        instants = (fact.select(F.col(key).alias("_k"), F.col(ts).alias("_t"))
                    .where(F.col("_k").isNotNull() & F.col("_t").isNotNull()).distinct())
        same = (F.col(key) == F.col("_k")) & (F.col(ts) == F.col("_t"))
        return fact.join(_covering(instants, history, take), same, "left").drop("_k", "_t")
    if strategy == "merge":
        return _merge_asof(fact, history, key, ts, take, hot_rows)
    raise ValueError(f"strategy must be merge or search, not {strategy!r}")


def _covering(instants: DataFrame, history: DataFrame, take: list[str]) -> DataFrame:
    """The version in force for each (key, instant), by comparing it with all versions of its key."""
    versions = history.withColumnRenamed("_k", "_vk")
    inside = (F.col("_t") >= F.col("valid_from")) & (F.col("_t") < F.col("valid_to"))
    best = F.max(F.struct("valid_from", "valid_to", F.struct(*take).alias("take"))).alias("_best")
    return (instants.join(versions, (F.col("_k") == F.col("_vk")) & inside).groupBy("_k", "_t").agg(best)
            .select("_k", "_t", *[F.col(f"_best.take.{c}").alias(c) for c in take]))


def _merge_asof(fact: DataFrame, history: DataFrame, key: str, ts: str, take: list[str], hot_rows: int | None) -> DataFrame:
    """The fact rows with the version in force, by one pass over both in order of time.

    Fact rows travel through the window themselves: each side is shuffled once, and nothing is joined back. The version that
    started last is the answer where it covers the instant. Where it has ended already, an earlier one may still be in force,
    but only if the latest end of all versions so far lies beyond the instant; those few rows are searched.
    """
    version, row = F.struct("valid_to", *take), F.struct(*[F.col(c) for c in fact.columns])
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    kind = history.schema["_k"].dataType
    starts = history.select("_k", F.col("valid_from").alias("_t"), F.lit(1).alias("_kind"), version.alias("_version"), F.col("valid_to").alias("_end"))
    facts = fact.where(usable).select(F.col(key).cast(kind).alias("_k"), F.col(ts).alias("_t"), F.lit(2).alias("_kind"), row.alias("_row"))
    events = starts.unionByName(facts, allowMissingColumns=True)
    groups = ["_k"]
    hot = hot_keys(events, "_k", "_t", hot_rows)
    if hot is not None:
        groups = ["_k", SLICE]
        events = with_slice(events, "_k", "_t", hot)
        begun = F.when(F.col("_kind") == 1, F.struct("_t", "_version"))
        before = carried_in(events.where(F.col(SLICE).isNotNull()), "_k", {"_last": begun, "_end": F.col("_end")})
        events = events.unionByName(before.where(F.col("_last").isNotNull()).select(
            "_k", SLICE, "_last._t", "_last._version", "_end", F.lit(1).alias("_kind")), allowMissingColumns=True)
    upto = (Window.partitionBy(*groups).orderBy("_t", "_kind", F.col("_version"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = (events.withColumn("_state", F.last("_version", ignorenulls=True).over(upto)).withColumn("_until", F.max("_end").over(upto))
            .where(F.col("_kind") == 2))
    covered = F.coalesce(F.col("_t") < F.col("_state.valid_to"), F.lit(False))
    open_ = F.coalesce(~covered & (F.col("_t") < F.col("_until")), F.lit(False))
    done = seen.where(~open_).select("_row.*", *[F.when(covered, F.col(f"_state.{c}")).alias(c) for c in take])
    left = seen.where(open_).select("_k", "_t", "_row")
    found = _covering(left.select("_k", "_t").distinct(), history, take).withColumnsRenamed({"_k": "_fk", "_t": "_ft"})
    searched = left.join(found, (F.col("_k") == F.col("_fk")) & (F.col("_t") == F.col("_ft")), "left").select("_row.*", *take)
    without = fact.where(~usable).select("*", *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in take])
    return done.unionByName(searched).unionByName(without)


def scd2_overlapping(dim: DataFrame, key: str = "customer_natural_key", surrogate: str = "customer_key",
                     hot_rows: int | None = None) -> DataFrame:
    """Versions that begin before an earlier one of their key has ended, with that end; empty when healthy.

    The latest end so far is carried along each key in order of time: a row for each version at most, however many
    overlap. :func:`scd2_overlaps` lists the pairs.
    """
    rows = dim.select(key, surrogate, "valid_from", F.coalesce("valid_to", ntz(OPEN_END)).alias("valid_to")).where(F.col(key).isNotNull())
    groups, hot = [key], hot_keys(rows, key, "valid_from", hot_rows)
    rows = rows.withColumn("_real", F.lit(1))
    if hot is not None:
        groups = [key, SLICE]
        rows = with_slice(rows, key, "valid_from", hot)
        before = carried_in(rows.where(F.col(SLICE).isNotNull()), key, {"valid_to": F.col("valid_to")})
        rows = rows.unionByName(before.where(F.col("valid_to").isNotNull()).withColumn("_real", F.lit(0)), allowMissingColumns=True)
    # The row that stands for earlier slices has no start and sorts first.
    earlier = (Window.partitionBy(*groups).orderBy("_real", F.col("valid_from").asc_nulls_first(), "valid_to", surrogate)
               .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("covered_until", F.max("valid_to").over(earlier))
            .where((F.col("_real") == 1) & (F.col("covered_until") > F.col("valid_from")))
            .select(key, surrogate, "valid_from", "valid_to", "covered_until"))


def scd2_overlaps(dim: DataFrame, key: str = "customer_natural_key",
                  surrogate: str = "customer_key", hot_rows: int | None = None) -> DataFrame:
    """Pairs of rows of one key whose intervals overlap, in both orders; empty when healthy.

    Rows are told apart by identity, not by surrogate key, so a version loaded twice is
    reported too: equal rows are counted, and ``pairs`` says how many row pairs a line stands
    for. Only keys in which some interval runs into its successor reach the pair search: rows of a key with few of them are
    held against each other, those of larger keys meet in time blocks (a row is in up to 60, all of which are shuffled).
    """
    rows = (dim.select(key, surrogate, "valid_from",
                       F.coalesce("valid_to", ntz(OPEN_END)).alias("valid_to"))
            .groupBy(key, surrogate, "valid_from", "valid_to")
            .agg(F.count(F.lit(1)).alias("copies")))
    chained = with_next(rows, key, "valid_from", "_next", ["valid_to", surrogate], hot_rows)
    runs_into = F.col("_next") < F.col("valid_to")
    twice = (F.col("copies") > 1) & (F.col("valid_from") < F.col("valid_to"))
    suspect = (chained.groupBy(key).agg(F.max(F.coalesce(runs_into | twice, F.lit(False))).alias("_hit"), F.count(F.lit(1)).alias("_n"))
               .where("_hit").drop("_hit"))
    checked = rows.join(suspect, key).select(
        key, "_n", instant_micros("valid_from").alias("_start"), instant_micros("valid_to").alias("_stop"),
        F.struct("valid_from", "valid_to", surrogate, "copies").alias("_row"))

    few = checked.where(F.col("_n") <= FEW)
    inside = (F.col("_start") <= F.col("_at")) & (F.col("_at") < F.col("_stop"))
    met = (few.select(key, "_start", "_stop", F.col("_row").alias("outer"))
           .join(few.select(key, F.col("_start").alias("_at"), F.col("_row").alias("inner")), key).where(inside))
    pairs = met.select(key, "outer", "inner").unionByName(
        starts_inside(checked.where(F.col("_n") > FEW), key, "_start", "_stop", "_row"))
    a, b = "outer", "inner"
    overlap = ((F.col(f"{a}.valid_from") < F.col(f"{b}.valid_to"))
               & (F.col(f"{a}.valid_to") > F.col(f"{b}.valid_from")))
    # Intervals starting together find each other both ways: keep one direction.
    once = ((F.col(f"{a}.valid_from") < F.col(f"{b}.valid_from"))
            | (F.struct(f"{a}.valid_to", f"{a}.{surrogate}")
               <= F.struct(f"{b}.valid_to", f"{b}.{surrogate}")))
    same = F.col(a) == F.col(b)
    copies = F.when(same, F.col(f"{a}.copies") * (F.col(f"{a}.copies") - 1)) \
              .otherwise(F.col(f"{a}.copies") * F.col(f"{b}.copies"))
    listed = pairs.where(overlap & once).withColumn("pairs", copies).where(F.col("pairs") > 0)
    ways = F.when(same, F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")))).otherwise(
        F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")),
                F.struct(F.col(b).alias("x"), F.col(a).alias("y"))))
    return (listed.select(key, "pairs", F.inline(ways))
            .select(key, F.col("x.valid_from").alias("a_valid_from"),
                    F.col("x.valid_to").alias("a_valid_to"),
                    F.col("y.valid_from").alias("b_valid_from"),
                    F.col("y.valid_to").alias("b_valid_to"), "pairs"))


def multi_version_keys(versions: DataFrame, key: str) -> DataFrame:
    """Keys with more than one version."""
    return (versions.groupBy(key).agg(F.count(F.lit(1)).alias("versions"))
            .where(F.col("versions") > 1))


__all__ = ["is_open", "multi_version_keys", "scd2", "scd2_as_of", "scd2_asof_join",
           "scd2_current", "scd2_overlapping", "scd2_overlaps"]
