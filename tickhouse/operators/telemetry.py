"""Delivery measures computed from the data itself."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock

# Upper bounds of the lag buckets in seconds, and the silence limit.
LAG_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)
MAX_SILENCE_SECONDS = 120


def lag_seconds(lag_ms: Column) -> Column:
    """Lag for a histogram: a clock that runs behind counts as zero."""
    return F.greatest(lag_ms, F.lit(0)).cast("double") / 1_000


def lag_histogram(df: DataFrame, lag_ms: str, by: Sequence[str]) -> DataFrame:
    """Cumulative counts per bucket, with an infinite last bucket, one row per (by, bucket).

    All buckets of a group come from one aggregate and are unpivoted afterwards,
    so the rows are not multiplied before the shuffle.
    """
    lag = lag_seconds(F.col(lag_ms))
    counts = [F.sum(F.when(lag <= b, 1).otherwise(0)).alias(f"__{i}")
              for i, b in enumerate(LAG_BUCKETS)]
    grouped = df.groupBy(*by).agg(*counts, F.count(lag_ms).alias("__all"))
    cells = [F.struct(F.lit(str(b)).alias("le"), F.col(f"__{i}").alias("observations"))
             for i, b in enumerate(LAG_BUCKETS)]
    cells.append(F.struct(F.lit("+Inf").alias("le"), F.col("__all").alias("observations")))
    return grouped.select(*by, F.inline(F.array(*cells)))


def quantile(value: str, share: float, exact: bool) -> Column:
    """Aggregate: the least value that ``share`` of the rows do not exceed.

    The default is a sketch, exact for groups of up to its accuracy. ``exact``
    counts the distinct values of a group, which suits whole milliseconds.
    """
    if exact:
        return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY {value})").cast("bigint")
    return F.percentile_approx(value, share, 10_000)


def lag_percentiles(
    df: DataFrame, lag_ms: str, by: Sequence[str], exact: bool = False
) -> DataFrame:
    q = F.array(*[quantile(lag_ms, share, exact) for share in (0.5, 0.95, 0.99)])
    return df.groupBy(*by).agg(
        F.count(lag_ms).alias("observations"), F.max(lag_ms).alias("max_lag_ms"), q.alias("__q")
    ).select(
        *by, "observations", "max_lag_ms",
        *[F.col("__q")[i].alias(n) for i, n in enumerate(("p50_lag_ms", "p95_lag_ms", "p99_lag_ms"))],
    )


def message_rates(df: DataFrame, t: str, by: Sequence[str], window: str = "1 hour") -> DataFrame:
    """Messages and messages per second per time window; batch or streaming."""
    grouped = df.groupBy(F.window(t, window), *by).agg(F.count(F.lit(1)).alias("messages"))
    start, end = F.col("window.start"), F.col("window.end")
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000
    return grouped.select(
        start.alias("window_start"), *by, "messages",
        (F.col("messages") / seconds).alias("messages_per_second"),
    )


def table_status(df: DataFrame, t: str, by: Sequence[str]) -> DataFrame:
    """Row count and latest time per group: what an operator looks at first."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(t).alias("earliest"), F.max(t).alias("latest")
    )


def silence(
    df: DataFrame,
    t: str,
    by: Sequence[str],
    as_of: datetime,
    previous: DataFrame | None = None,
    limit_seconds: int = MAX_SILENCE_SECONDS,
) -> DataFrame:
    """Seconds since the last message per group (at least one column), and if it has stalled.

    Stalled: silent longer than the limit, or - given the ``previous`` marks (by,
    ``high_water``) of an earlier check - a high-water mark that has not moved.
    """
    marks = df.groupBy(*by).agg(F.max(t).alias("high_water"))
    quiet = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("high_water")) / 1_000_000
    out = marks.withColumn("seconds_since_last", quiet)
    stalled = F.col("seconds_since_last") > limit_seconds
    if previous is not None:
        earlier = previous.select(*by, F.col("high_water").alias("__was"))
        out = out.join(earlier, list(by), "left")
        stalled = stalled | F.coalesce(F.col("__was") == F.col("high_water"), F.lit(False))
    return out.withColumn("is_stalled", stalled).drop("__was")
