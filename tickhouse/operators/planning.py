"""Completeness of a bar series and the backfill that would close its gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock
from tickhouse.operators.ordered import neighbours

MAX_BARS_PER_REQUEST = 1_000


def expected_bars(start: Column, end: Column, seconds: int) -> Column:
    """Bars in the half-open window ``[start, end)``."""
    return F.floor(
        (F.unix_micros(end) - F.unix_micros(start)) / F.lit(seconds * 1_000_000)
    ).cast("bigint")


def request_chunks(
    windows: DataFrame, seconds: int, max_bars: int = MAX_BARS_PER_REQUEST
) -> DataFrame:
    """Tile each window (``start``, ``end``) into chunks of at most ``max_bars`` bars.

    Half-open chunks share their edges, so they neither overlap nor leave a gap.
    """
    step = seconds * max_bars * 1_000_000
    first, stop = F.unix_micros("start"), F.unix_micros("end")
    cursor = F.explode(F.sequence(first, stop - 1, F.lit(step).cast("bigint")))
    rest = [c for c in windows.columns if c not in ("start", "end")]
    return (
        windows.filter(F.col("end") > F.col("start"))
        .withColumn("__at", cursor)
        .select(
            *rest,
            F.timestamp_micros("__at").alias("start"),
            F.timestamp_micros(F.least(F.col("__at") + step, stop)).alias("end"),
        )
        .withColumn("expected_bars", expected_bars(F.col("start"), F.col("end"), seconds))
    )


def day_windows(symbols: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """The symbol x day grid of backfill partitions, both days inclusive."""
    days = F.explode(F.sequence(first_day, last_day, F.expr("INTERVAL 1 DAY")))
    grid = symbols.withColumn("trading_date", days)
    start = F.col("trading_date").cast("timestamp")
    return grid.withColumns({"start": start, "end": clock.plus_seconds(start, 86_400)})


def missing_ranges(
    present: DataFrame,
    spans: DataFrame,
    seconds: int,
    keys: Sequence[str] = ("symbol",),
    max_bars: int = MAX_BARS_PER_REQUEST,
) -> DataFrame:
    """Maximal runs of missing bars per key, tiled into requests.

    ``spans`` gives each key's expected window (keys, ``start``, ``end``), both on
    bar boundaries. Rather than build every expected bar and anti-join, the
    present bars are walked in order and the holes between them read off, with
    the window's edges as sentinels: the work follows the data, not the grid.
    """
    width = seconds * 1_000_000
    inside = (
        present.select(*keys, "bar_start")
        .join(spans, list(keys))
        .filter((F.col("bar_start") >= F.col("start")) & (F.col("bar_start") < F.col("end")))
        .select(*keys, "bar_start")
        .distinct()
    )
    # The sentinel before the window stands for "covered up to start".
    before = spans.select(
        *keys, F.timestamp_micros(F.unix_micros("start") - width).alias("bar_start")
    )
    walked = neighbours(
        inside.unionByName(before),
        keys,
        ["bar_start"],
        clock.bucket_id(F.col("bar_start"), seconds * 10_080),
        lead={"__next": "bar_start"},
    ).join(spans.select(*keys, F.col("end").alias("__stop")), list(keys))
    begin = F.timestamp_micros(F.unix_micros("bar_start") + width)
    holes = walked.select(
        *keys, begin.alias("start"), F.coalesce("__next", "__stop").alias("end")
    ).filter(F.col("end") > F.col("start"))
    return request_chunks(holes, seconds, max_bars)


def completeness(
    present: DataFrame, windows: DataFrame, seconds: int, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Bars found against bars expected, per window (keys, ``trading_date``, ``start``, ``end``)."""
    found = present.groupBy(*keys, F.to_date("bar_start").alias("trading_date")).agg(
        F.count_distinct("bar_start").alias("present_bars")
    )
    out = windows.join(found, [*keys, "trading_date"], "left").withColumns(
        {
            "present_bars": F.coalesce("present_bars", F.lit(0)),
            "expected_bars": expected_bars(F.col("start"), F.col("end"), seconds),
        }
    )
    return out.withColumns(
        {
            "missing_bars": F.col("expected_bars") - F.col("present_bars"),
            "coverage_ratio": F.round(
                F.col("present_bars") / F.nullif(F.col("expected_bars"), F.lit(0)), 6
            ),
        }
    )
