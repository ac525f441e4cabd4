"""Silver tables: deduplicated entities built from landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickhouse.operators import Stage, keep_lazy, staging
from tickhouse.operators import bars as bar_ops
from tickhouse.operators import quotes as quote_ops
from tickhouse.operators.dedup import dedup
from tickhouse.operators.intervals import rebound_intervals

TRADE_KEYS = ("exchange_id", "symbol", "trade_id")
QUOTE_KEYS = ("exchange_id", "symbol", "update_id")
KLINE_KEYS = ("exchange_id", "symbol", "bar_interval", "bar_start")
FX_KEYS = ("rate_source", "currency_pair")
ARRIVAL = ("lake_ingested_at", "kafka_offset")


def trades(landed: DataFrame, stage: Stage | None = None) -> DataFrame:
    """One row per real trade, first observation kept, copies counted.

    With ``stage`` only trades that were landed twice are brought together; pass it
    where ``landed`` is a stored table.
    """
    return staging.assign_bars(
        dedup(staging.stage_trades(landed), TRADE_KEYS, ARRIVAL, stage=stage))


def quotes(landed: DataFrame, stage: Stage = keep_lazy) -> DataFrame:
    """One row per quote with the time it prevailed."""
    deduplicated = dedup(staging.stage_quotes(landed), QUOTE_KEYS, ARRIVAL, count_col=None)
    return quote_ops.with_durations(stage(deduplicated))


def venue_klines(landed: DataFrame) -> DataFrame:
    """Closed venue candles, one per natural key (the latest landed copy)."""
    return dedup(
        staging.stage_klines(landed), KLINE_KEYS, ("lake_ingested_at",), keep="last", count_col=None
    )


def fx_rates(landed: DataFrame, stage: Stage = keep_lazy) -> DataFrame:
    """Reference rates as a non-overlapping interval series per source and pair."""
    return rebound_intervals(staging.stage_fx(landed), FX_KEYS, stage=stage)


def ohlcv(
    silver_trades: DataFrame,
    seconds: int = 60,
    previous: DataFrame | None = None,
    stage: Stage = keep_lazy,
) -> DataFrame:
    return bar_ops.bars(silver_trades, seconds, previous=previous, stage=stage)


def quote_metrics(silver_quotes: DataFrame, seconds: int = 60, **options) -> DataFrame:
    return quote_ops.quote_metrics(silver_quotes, seconds, **options)
