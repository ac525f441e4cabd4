"""Time arithmetic. Event times are ``timestamp`` under a UTC session."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Venue interval codes and their length in seconds.
INTERVAL_SECONDS = {
    "1m": 60, "3m": 180, "5m": 300, "15m": 900, "30m": 1_800,
    "1h": 3_600, "2h": 7_200, "4h": 14_400, "6h": 21_600, "8h": 28_800, "12h": 43_200,
    "1d": 86_400, "3d": 259_200, "1w": 604_800,
}


def interval_seconds(code: str) -> int:
    if code not in INTERVAL_SECONDS:
        raise ValueError(f"unknown interval {code!r}")
    return INTERVAL_SECONDS[code]


def bucket_id(ts: Column, seconds: int) -> Column:
    """Number of the ``seconds``-long bucket since the epoch (floor, so also right before 1970)."""
    micros = F.unix_micros(ts)
    width = F.lit(seconds * 1_000_000)
    return ((micros - F.pmod(micros, width)) / width).cast("bigint")


def bar_floor(ts: Column, seconds: int = 60) -> Column:
    """Start of the bar that contains ``ts``."""
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))


def plus_seconds(ts: Column, seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(seconds * 1_000_000))


def millis_between(start: Column, end: Column) -> Column:
    """Whole-millisecond difference, each end truncated to its millisecond."""
    return F.unix_millis(end) - F.unix_millis(start)


def minutes_between(start: Column, end: Column) -> Column:
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000)).cast("bigint")


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed whole days between two timestamps."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(86_400_000_000)).cast("int")


# The last millisecond of year 9999, the greatest time that a record may carry.
MAX_EPOCH_MILLIS = 253_402_300_799_999


def epoch_millis(value: Column) -> Column:
    """Timestamp from epoch milliseconds; null for null and for times out of range."""
    return F.when(value.between(0, MAX_EPOCH_MILLIS), F.timestamp_millis(value))


def out_of_range(value: Column) -> Column:
    """Whether epoch milliseconds are given and have no timestamp."""
    return ~value.between(0, MAX_EPOCH_MILLIS)


def built_at(as_of: datetime | None = None) -> Column:
    """Build time of a table: one moment for all rows, given or that of the query."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
