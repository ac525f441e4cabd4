"""Which minutes of a day an instrument has, as a bitmap of 1,440 bits.

One row of 180 bytes a day replaces a row per minute: bitmaps of two sources or of
two batches merge by OR, coverage is the number of set bits, and gaps are runs of
zeros. No table of all minutes is made to compare with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock
from tickhouse.operators.ordered import neighbours

MINUTES = 1_440
#: Bytes of a day; bit n of byte b is minute 8 b + n.
_BYTES = MINUTES // 8
#: The bits of a hexadecimal digit, lowest first.
_NIBBLES = [f"{n:04b}"[::-1] for n in range(16)]


def minute_presence(rows: DataFrame, keys: Sequence[str], t: str) -> DataFrame:
    """(keys, day, minutes): the minutes that have a row. Bits are set on the map side,
    so a busy instrument is one row a day and task. Rows without a time have no minute."""
    day = F.to_date(F.col(t)).alias("day")
    minute = clock.bucket_id(F.col(t), 60) - clock.bucket_id(F.date_trunc("day", t), 60)
    bits = F.bitmap_construct_agg(minute)
    return rows.dropna(subset=[t]).groupBy(*keys, day).agg(bits.substr(1, _BYTES).alias("minutes"))


def merge(presence: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of the same day as one."""
    return presence.groupBy(*keys, "day").agg(
        F.bitmap_or_agg("minutes").substr(1, _BYTES).alias("minutes"))


def _bits(minutes: Column) -> Column:
    """The bitmap as 1,440 characters, first minute first."""
    digits = F.split(F.regexp_replace(F.hex(minutes), "(.)(.)", "$2$1"), "")
    table = F.array(*[F.lit(x) for x in _NIBBLES])
    return F.array_join(F.transform(
        digits, lambda d: F.get(table, F.conv(d, 16, 10).cast("int"))), "")


def _borders(bits: Column, ends: bool) -> Column:
    """Minutes where runs of zeros begin, or the minutes behind their ends."""
    at = F.sequence(F.lit(0), F.lit(MINUTES if ends else MINUTES - 1))

    def bit(n: Column) -> Column:
        # Beyond both ends of the day stands a set bit.
        return F.substring(F.concat(F.lit("1"), bits, F.lit("1")), n + 2, F.lit(1))

    if ends:
        return F.filter(at, lambda n: (bit(n) == "1") & (bit(n - 1) == "0"))
    return F.filter(at, lambda n: (bit(n) == "0") & (bit(n - 1) == "1"))


def gaps(presence: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, day, from_minute, to_minute) of every run of missing minutes of a day that
    has any row; ``to_minute`` is the minute behind it."""
    runs = presence.withColumn("__bits", _bits(F.col("minutes"))).select(
        *keys, "day",
        F.explode(F.arrays_zip(_borders(F.col("__bits"), False).alias("a"),
                               _borders(F.col("__bits"), True).alias("b"))).alias("run"))
    return runs.select(*keys, "day", F.col("run.a").alias("from_minute"),
                       F.col("run.b").alias("to_minute"))


def coverage(presence: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per day: minutes present, their share, gaps, the longest one, and how many whole
    days are missing before the instrument's next day."""
    bits = F.col("__bits")
    starts, ends = _borders(bits, False), _borders(bits, True)
    lengths = F.zip_with(ends, starts, lambda b, a: b - a)
    counted = presence.withColumn("__bits", _bits(F.col("minutes"))).select(
        *keys, "day", F.bitmap_count("minutes").alias("minutes_present"),
        F.size(starts).cast("bigint").alias("gaps"),
        F.coalesce(F.array_max(lengths), F.lit(0)).cast("bigint").alias("longest_gap"))
    ahead = neighbours(
        counted, keys, ["day"], clock.bucket_id(F.col("day").cast("timestamp"), 1_000 * 86_400),
        lead={"__next": "day"})
    return ahead.select(
        *keys, "day", "minutes_present",
        (F.col("minutes_present") / F.lit(MINUTES)).alias("minute_coverage_ratio"),
        "gaps", "longest_gap",
        F.coalesce(F.date_diff("__next", "day") - 1, F.lit(0)).cast("bigint").alias("days_missing"))


def backfill_plan(presence: DataFrame, keys: Sequence[str], max_minutes: int = 1_000) -> DataFrame:
    """Requests that fill every gap: (keys, starts_at, ends_at, minutes), none longer than
    ``max_minutes``; a run of missing days is tiled as a whole."""
    days = neighbours(
        presence.select(*keys, "day"), keys, ["day"],
        clock.bucket_id(F.col("day").cast("timestamp"), 1_000 * 86_400), lead={"__next": "day"})
    midnight = clock.bucket_id(F.col("day").cast("timestamp"), 60)
    whole = days.filter(F.date_diff("__next", "day") > 1).select(
        *keys, (midnight + MINUTES).alias("a"),
        clock.bucket_id(F.col("__next").cast("timestamp"), 60).alias("b"))
    parts = gaps(presence, keys).select(
        *keys, (midnight + F.col("from_minute")).alias("a"),
        (midnight + F.col("to_minute")).alias("b"))
    start = F.explode(F.sequence("a", F.col("b") - 1, F.lit(max_minutes).cast("bigint")))
    tiles = whole.unionByName(parts).select(*keys, "b", start.alias("a"))
    end = F.least("b", F.col("a") + max_minutes)
    return tiles.select(
        *keys, F.timestamp_seconds(F.col("a") * 60).alias("starts_at"),
        F.timestamp_seconds(end * 60).alias("ends_at"), (end - F.col("a")).alias("minutes"))
