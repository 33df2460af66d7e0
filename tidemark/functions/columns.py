"""Column helpers. Everything here is a built-in expression; nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.contracts import OPEN_END, STEP_ZERO

__all__ = [
    "MONEY", "as_column", "batch_label", "clean_code", "clean_email", "content_hash",
    "instant_micros", "is_open", "ntz", "parse_money", "percent", "stable_bucket",
    "step_instant", "surrogate_key", "text_key", "typed_null", "whole_years",
]

MONEY = "decimal(18,2)"
NULL_TEXT = "_null_"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_code(c: Column | str) -> Column:
    """Trimmed upper-case code."""
    return F.upper(F.trim(as_column(c)))


def clean_email(c: Column | str) -> Column:
    return F.lower(F.trim(as_column(c)))


def parse_money(c: Column | str) -> Column:
    """``"$-77.00"`` to decimal(18,2); malformed text raises under ANSI."""
    return F.replace(as_column(c), F.lit("$"), F.lit("")).cast(MONEY)


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def ntz(text: str) -> Column:
    """Timestamp literal without zone."""
    return F.lit(text).cast("timestamp_ntz")


def text_key(c: Column | str) -> Column:
    """md5 of the value's text: key of a dimension with a single natural key."""
    return F.md5(as_column(c).cast("string"))


def _joined_text(columns: tuple[Column | str, ...]) -> Column:
    parts: list[Column] = []
    for c in columns:
        if parts:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(as_column(c).cast("string"), F.lit(NULL_TEXT)))
    return F.concat(*parts)


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the columns' text; NULL takes part as a marker, so (a, NULL) and (NULL, a) differ."""
    return F.md5(_joined_text(columns))


def content_hash(*columns: Column | str) -> Column:
    """Identity of a row that has no key of its own; equal content gives an equal hash on every run."""
    return F.md5(_joined_text(columns))


def stable_bucket(c: Column | str, buckets: int) -> Column:
    """1..buckets from the first 32 bits of md5; the same in every engine and on every run."""
    prefix = F.substring(F.md5(as_column(c).cast("string")), 1, 8)
    return F.conv(prefix, 16, 10).cast("bigint") % F.lit(buckets) + F.lit(1)


def step_instant(step: Column | str, zero: str = STEP_ZERO) -> Column:
    """Instant of an hourly step counter."""
    return ntz(zero) + F.make_dt_interval(F.lit(0), as_column(step).cast("int"))


def whole_years(start: Column | str, as_of: str) -> Column:
    """Completed 365-day years between a date and ``as_of``."""
    days = F.datediff(F.lit(as_of).cast("date"), as_column(start))
    return F.floor(days / F.lit(365)).cast("int")


def batch_label(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), "yyyyMMdd_HHmmss")


def is_open(valid_to: Column | str) -> Column:
    """True for a version without successor, whichever way the open end is written."""
    c = as_column(valid_to)
    return c.isNull() | (c == ntz(OPEN_END))


def instant_micros(c: Column | str) -> Column:
    """Microseconds on the zone-free time line (no session zone involved)."""
    t = as_column(c).cast("timestamp_ntz")
    day = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (F.hour(t) * 60 + F.minute(t)).cast("bigint")
    seconds = (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint")
    return day * F.lit(86_400_000_000) + minutes * F.lit(60_000_000) + seconds


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole rounded; NULL when there is nothing to divide by."""
    return F.when(whole > 0, F.round(part.cast("double") * 100.0 / whole.cast("double"), digits))
