"""Durations and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000

# Calendar grains and the text form of their label.
GRAIN_FORMATS = {"day": "yyyy-MM-dd", "week": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


def _micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))


def hours_between(end: Column, start: Column) -> Column:
    return (_micros(end) - _micros(start)) / F.lit(float(MICROS_PER_HOUR))


def days_between(end: Column, start: Column) -> Column:
    return (_micros(end) - _micros(start)) / F.lit(float(MICROS_PER_DAY))


def period(time: Column, grain: str = "month") -> Column:
    """Text label of the calendar period that holds ``time``."""
    if grain not in GRAIN_FORMATS:
        raise ValueError(f"unknown grain {grain!r}; use one of {sorted(GRAIN_FORMATS)}")
    start = F.date_trunc("week", time) if grain == "week" else time
    return F.date_format(start, GRAIN_FORMATS[grain])


def lenient_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Parse a timestamp; text that does not parse gives NULL."""
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
