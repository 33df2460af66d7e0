"""Interval self-join without trying all pairs of a group.

Every instant on the microsecond line belongs to one block of each power-of-two size, and every
interval is covered by at most two blocks per size. Joining starts to covers on
``(key, size, block)`` therefore yields exactly the pairs in which one interval starts inside
the other, however many rows share the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 2^59 microseconds span 18,000 years; the shift keeps instants before 1970 non-negative.
LEVELS = 59
SHIFT = 62_135_596_800_000_000  # microseconds from 0001-01-01 to 1970-01-01


def _blocks_of(instant: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda level: F.struct(
        level.alias("level"), F.call_function("shiftright", instant, level).alias("block")))


def _cover(start: Column, stop: Column) -> Column:
    """Blocks that tile [start, stop)."""
    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        low = F.call_function("shiftright", start + size - 1, level)
        high = F.call_function("shiftright", stop, level)
        odd = lambda c: c.bitwiseAND(F.lit(1)) == 1
        pick = lambda use, block: F.when((low < high) & use, F.struct(
            level.alias("level"), block.alias("block")))
        return F.array(pick(odd(low), low), pick(odd(high), high - 1))
    tiles = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))
    return F.filter(tiles, lambda t: t.isNotNull())


def starts_inside(df: DataFrame, key: str, start: str, stop: str, row: str) -> DataFrame:
    """Pairs ``outer``/``inner`` of row structs (column ``row``) with equal key where
    ``outer.start <= inner.start < outer.stop``; start and stop are bigint microseconds."""
    begin, end = F.col(start) + F.lit(SHIFT), F.col(stop) + F.lit(SHIFT)
    covers = df.select(key, F.col(row).alias("outer"), F.inline(_cover(begin, end)))
    points = df.select(key, F.col(row).alias("inner"), F.inline(_blocks_of(begin)))
    return covers.join(points, [key, "level", "block"]).select(key, "outer", "inner")
