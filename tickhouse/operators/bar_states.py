"""Candles as partial aggregates that can be stored and merged.

A state has one row per (keys, bar): sums, extremes, counts, and the first and last
price beside the number that orders them. States of any two sets of trades merge
into the state of both, in any order, so a batch of trades, however late, changes
its bars without the earlier trades being read again, and minute states merge into
those of any longer interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock
from tickhouse.operators.bars import BAR_KEYS, trade_order, with_bar_ratios

_FIRST, _LAST = "__first_order", "__last_order"


def _measures(t: str) -> dict[str, tuple[str, Column, set[str]]]:
    """Name: how it merges, what it is of one trade, and the columns that it reads."""
    one, buys = F.lit(1).cast("bigint"), F.col("is_buyer_aggressor")
    q, n, lag = F.col("quantity"), F.col("notional"), F.col("ingestion_lag_ms")
    return {
        _FIRST: ("min", trade_order(t), {"trade_id"}),
        _LAST: ("max", trade_order(t), {"trade_id"}),
        "open_price": ("first", F.col("price"), {"price", "trade_id"}),
        "close_price": ("last", F.col("price"), {"price", "trade_id"}),
        "high_price": ("max", F.col("price"), {"price"}),
        "low_price": ("min", F.col("price"), {"price"}),
        "base_volume": ("sum", q, {"quantity"}),
        "quote_volume": ("sum", n, {"notional"}),
        "trade_count": ("sum", one, set()),
        "taker_buy_base_volume": (
            "sum", F.when(buys, q).otherwise(0), {"is_buyer_aggressor", "quantity"}),
        "taker_buy_quote_volume": (
            "sum", F.when(buys, n).otherwise(0), {"is_buyer_aggressor", "notional"}),
        "largest_trade_size": ("max", q, {"quantity"}),
        "first_trade_time": ("min", F.col(t), set()),
        "last_trade_time": ("max", F.col(t), set()),
        "first_trade_id": ("min", F.col("trade_id"), {"trade_id"}),
        "last_trade_id": ("max", F.col("trade_id"), {"trade_id"}),
        "__lag_sum": ("sum", lag.cast("bigint"), {"ingestion_lag_ms"}),
        "__lag_count": (
            "sum", F.when(lag.isNotNull(), one).otherwise(0), {"ingestion_lag_ms"}),
        "max_ingestion_lag_ms": ("max", lag, {"ingestion_lag_ms"}),
        "duplicated_trade_count": (
            "sum", F.when(F.col("_duplicate_count") > 1, one).otherwise(0), {"_duplicate_count"}),
        "built_from_data_as_of": ("max", F.col("lake_ingested_at"), {"lake_ingested_at"}),
    }


def _aggregated(name: str, how: str, value: Column, first: Column, last: Column) -> Column:
    """Every one keeps a number or a time, so the aggregates stay a hash table."""
    return {
        "sum": lambda: F.sum(value), "min": lambda: F.min(value), "max": lambda: F.max(value),
        "first": lambda: F.min_by(value, first), "last": lambda: F.max_by(value, last),
    }[how]().alias(name)


def fold(
    trades: DataFrame, seconds: int = 60, keys: Sequence[str] = BAR_KEYS, t: str = "event_time"
) -> DataFrame:
    """States of a set of trades, each of which counts: replays are taken out before.

    Measures whose columns the trades lack are left out. Rows without a time or an id
    have no place in a bar and are left out too.
    """
    have, order = set(trades.columns), trade_order(t)
    start = clock.bar_floor(F.col(t), seconds).alias("bar_start")
    return trades.dropna(subset=[t, "trade_id"]).groupBy(*keys, start).agg(*[
        _aggregated(name, how, value, order, order)
        for name, (how, value, reads) in _measures(t).items() if reads <= have
    ])


def merge(states: DataFrame, keys: Sequence[str] = BAR_KEYS, seconds: int | None = None) -> DataFrame:
    """States of the same bars as one; with ``seconds``, of the longer bars they lie in."""
    start = F.col("bar_start") if seconds is None else clock.bar_floor(F.col("bar_start"), seconds)
    # Decimal sums grow by ten digits each time unless told not to.
    kept = {f.name: f.dataType for f in states.schema}
    merged = states.groupBy(*keys, start.alias("bar_start")).agg(*[
        _aggregated(name, how, F.col(name), F.col(_FIRST), F.col(_LAST))
        for name, (how, _, _) in _measures("bar_start").items() if name in kept
    ])
    return merged.select(*[F.col(c).cast(kept[c]).alias(c) for c in states.columns])


def finish(states: DataFrame, seconds: int = 60) -> DataFrame:
    """Candles of merged states: the columns of ``aggregate_bars``."""
    out = states.withColumn("bar_end", clock.plus_seconds(F.col("bar_start"), seconds))
    if "__lag_sum" in states.columns:
        out = out.withColumn("mean_ingestion_lag_ms", F.when(
            F.col("__lag_count") > 0, F.col("__lag_sum").cast("double") / F.col("__lag_count")))
    return with_bar_ratios(out.drop(_FIRST, _LAST, "__lag_sum", "__lag_count"))
