"""Epoch numbers as formatted text, in the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_FORMAT = "yyyyMM"
DAY_FORMAT = "yyyy-MM-dd"


def format_epoch_seconds(seconds: Column, pattern: str) -> Column:
    """``seconds`` may be text, as in log records."""
    return F.date_format(F.timestamp_seconds(seconds.cast("long")), pattern)


def format_epoch_millis(millis: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_millis(millis.cast("long")), pattern)


# Units of durations, in microseconds.
_UNITS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def duration_micros(duration: str) -> int:
    """The length of a duration of one unit, such as ``30 seconds`` or ``1 DAY``."""
    number, _, unit = duration.strip().lower().partition(" ")
    unit = unit.strip().removesuffix("s")
    if not number.isdigit() or unit not in _UNITS:
        raise ValueError(f"not a duration of days, hours, minutes, seconds or milliseconds: {duration}")
    return int(number) * _UNITS[unit]
