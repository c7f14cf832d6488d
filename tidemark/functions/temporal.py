"""Event-time windows, surrogate date keys and time zones."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the Julian day number of 1970-01-01.
JULIAN_DAY_OF_EPOCH = 2440588


def tumble(column: Column | str, *, size: str) -> Column:
    return F.window(column, size)


def hop(column: Column | str, *, size: str, slide: str) -> Column:
    """Overlapping windows. Keyword-only: SQL dialects disagree on the order of the two."""
    return F.window(column, size, slide)


def compact_date_key(date: Column) -> Column:
    """2024-01-31 -> 20240131"""
    return F.date_format(date, "yyyyMMdd").cast("int")


def date_of_compact_key(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def julian_date_key(date: Column) -> Column:
    return F.unix_date(date.cast("date")) + F.lit(JULIAN_DAY_OF_EPOCH)


def date_of_julian_key(key: Column) -> Column:
    return F.date_from_unix_date(key.cast("int") - F.lit(JULIAN_DAY_OF_EPOCH))


def julian_key_of(key: Column) -> Column:
    """Bring either kind of date key to the Julian kind, which is what date dimensions use.

    Compact keys of four-digit years start at 10,000,101; Julian keys reach that only in the
    year 22,667, so the two ranges cannot meet in real data.
    """
    return F.when(key >= F.lit(10_000_101), julian_date_key(date_of_compact_key(key))).otherwise(key)


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def to_zone(local: Column, source: str, target: str) -> Column:
    """Move a zone-less wall-clock time from one zone to another."""
    return F.convert_timezone(F.lit(source), F.lit(target), local.cast("timestamp_ntz"))


def hours_between(earlier: Column, later: Column) -> Column:
    """Whole hours, cut towards zero."""
    return F.timestamp_diff("HOUR", earlier, later)


def whole_hour_shift(left: Column, right: Column, tolerance_seconds: int = 60) -> Column:
    """How many whole hours two clocks are apart, or NULL if not near a whole number of hours."""
    seconds = F.timestamp_diff("SECOND", right, left)
    hours = F.round(seconds / F.lit(3600.0)).cast("bigint")
    return F.when(F.abs(seconds - hours * 3600) <= F.lit(tolerance_seconds), hours)


def change_time(op_ts: Column, updated_at: Column, load_time: Column) -> Column:
    """Time of a change. Snapshot rows carry the epoch as change time, which means unknown."""
    known = F.when(op_ts > F.timestamp_seconds(F.lit(0)), op_ts)
    return F.coalesce(known, updated_at, load_time)
