"""Prevailing time of each quote and the per-bar liquidity metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock, money
from tickhouse.functions.money import BPS
from tickhouse.operators.ordered import neighbours

QUOTE_KEYS = ("exchange_id", "symbol")


def with_durations(
    quotes: DataFrame,
    keys: Sequence[str] = QUOTE_KEYS,
    t: str = "event_time",
    id_col: str = "update_id",
    chunk_seconds: int = 3_600,
    id_chunk: int = 1_000_000,
) -> DataFrame:
    """Add ``next_event_time``, ``prevailing_ms`` and ``book_updates_between``.

    The successor is taken in (time, id) order, the book churn in id order, so
    the two passes cut a symbol differently: by hour and by id range. An id
    range holds at most ``id_chunk`` rows, whatever the symbol's rate.
    """
    timed = neighbours(
        quotes,
        keys,
        [t, id_col],
        clock.bucket_id(F.col(t), chunk_seconds),
        lead={"next_event_time": t},
    )
    churned = neighbours(
        timed,
        keys,
        [id_col],
        F.floor(F.col(id_col) / F.lit(id_chunk)),
        lag={"__prev_id": id_col},
        edges_from=quotes,
    )
    gap = F.col(id_col) - F.col("__prev_id") - 1
    return churned.withColumns(
        {
            "prevailing_ms": clock.millis_between(F.col(t), F.col("next_event_time")),
            "book_updates_between": F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)),
            "bar_start_1m": clock.bar_floor(F.col(t), 60),
        }
    ).drop("__prev_id")


def split_over_bars(quotes: DataFrame, seconds: int, t: str = "event_time") -> DataFrame:
    """Clip each quote's prevailing time to the bars it covers, one row per bar.

    A carried-over part keeps the quote's prices but not its churn, which
    belongs to the bar the update arrived in.
    """
    first = clock.bucket_id(F.col(t), seconds)
    final = clock.bucket_id(F.timestamp_micros(F.unix_micros("next_event_time") - 1), seconds)
    bar = F.col("__bar")
    width = seconds * 1_000_000
    begin = F.timestamp_micros(F.greatest(F.unix_micros(t), bar * width))
    end = F.timestamp_micros(F.least(F.unix_micros("next_event_time"), (bar + 1) * width))
    return (
        quotes.withColumn("__bar", F.explode(F.sequence(first, F.greatest(first, final))))
        .withColumns(
            {
                "prevailing_ms": clock.millis_between(begin, end),
                "book_updates_between": F.when(bar == first, F.col("book_updates_between"))
                .otherwise(0),
                t: begin,
            }
        )
        .drop("__bar")
    )


def quote_metrics(
    quotes: DataFrame,
    seconds: int = 60,
    keys: Sequence[str] = QUOTE_KEYS,
    t: str = "event_time",
    exact_quantiles: bool = False,
    split_at_bar_end: bool = False,
    discrete_median: bool = False,
) -> DataFrame:
    """Spread, depth and coverage per bar, from quotes with durations.

    The time-weighted spread divides by all covered time; a quote without a
    spread adds to the denominator only. By default a quote's whole prevailing
    time counts in the bar it arrived in; ``split_at_bar_end`` clips it instead.

    The median is a sketch, exact for bars of up to its accuracy. With
    ``discrete_median`` it is the least spread that half of the quotes do not
    exceed, whatever their number; ``exact_quantiles`` interpolates between two.
    Both count the distinct spreads of a bar.
    """
    held = quotes.filter(F.col("prevailing_ms").isNotNull() & (F.col("prevailing_ms") >= 0))
    if split_at_bar_end:
        held = split_over_bars(held, seconds, t)
    ms = F.col("prevailing_ms")
    spread = F.col("spread_bps")
    if discrete_median:
        median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY spread_bps)")
    elif exact_quantiles:
        median = F.percentile(spread, 0.5)
    else:
        median = F.percentile_approx(spread, 0.5, 10_000)
    depth = F.col("bid_quantity").cast("decimal(28,12)") + F.col("ask_quantity").cast(
        "decimal(28,12)"
    )
    count = F.count(F.lit(1))
    return (
        held.groupBy(*keys, clock.bar_floor(F.col(t), seconds).alias("bar_start"))
        .agg(
            count.alias("quote_count"),
            F.sum(ms).alias("covered_ms"),
            money.mean(spread).alias("mean_spread_bps"),
            money.weighted_mean(spread, ms).alias("time_weighted_spread_bps"),
            F.min(spread).alias("min_spread_bps"),
            F.max(spread).alias("max_spread_bps"),
            median.cast(BPS).alias("median_spread_bps"),
            money.mean(depth).alias("mean_touch_depth"),
            money.mean(F.col("touch_imbalance")).alias("mean_touch_imbalance"),
            F.max_by("mid_price", F.struct(t, "update_id")).alias("closing_mid_price"),
            F.sum("book_updates_between").alias("book_updates_skipped"),
        )
        .withColumn(
            "quote_coverage_ratio",
            F.least(
                money.ratio(F.col("covered_ms"), F.lit(seconds * 1_000)), F.lit(1).cast(BPS)
            ),
        )
    )
