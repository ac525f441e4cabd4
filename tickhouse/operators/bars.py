"""Candles of any interval from the trade tape."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock, money
from tickhouse.operators import Stage, keep_lazy
from tickhouse.operators.ordered import neighbours

BAR_KEYS = ("exchange_id", "symbol")


def aggregate_bars(
    trades: DataFrame, seconds: int = 60, keys: Sequence[str] = BAR_KEYS, t: str = "event_time",
    sparse: bool = False,
) -> DataFrame:
    """One row per (keys, bar). Every measure combines on the map side; wide decimal
    sums are the cost here, so each quantity is summed once.

    Open and close order by (time, trade id), so two trades in one millisecond
    resolve the same way on every run.

    ``sparse`` is for bars of a trade or two: partial candles would be as many as the
    trades and twice as wide, so the trades themselves are brought together.
    """
    start = clock.bar_floor(F.col(t), seconds).alias("bar_start")
    if sparse:
        # By the last key alone: a constant among the keys would leave the planner unable to
        # tell that rows of a bar are together, and it would shuffle again.
        trades = trades.withColumn("bar_start", start).repartition(keys[-1], "bar_start")
        start = F.col("bar_start")
    grouped = trades.groupBy(*keys, start).agg(*[column for column, _ in bar_measures(t)])
    ended = grouped.withColumn("bar_end", clock.plus_seconds(F.col("bar_start"), seconds))
    return with_bar_ratios(ended)


def trade_order(t: str = "event_time") -> Column:
    """Time, then id, as one number in place of a struct, which would cost a sort on both
    sides of a shuffle: microseconds, then 19 digits for any non-negative 64-bit id."""
    return (
        F.unix_micros(t).cast("decimal(19,0)") * F.lit(Decimal(10**19)).cast("decimal(20,0)")
        + F.col("trade_id").cast("decimal(19,0)")
    ).cast("decimal(38,0)")


def bar_measures(t: str = "event_time") -> list[tuple[Column, set[str]]]:
    """The aggregates of a candle, each with the columns that it reads."""
    by = trade_order(t)
    taker_buy = F.col("is_buyer_aggressor")
    zero = F.lit(0)
    q, n = F.col("quantity"), F.col("notional")
    repeated = F.when(F.col("_duplicate_count") > 1, 1).otherwise(0)
    named = {
        "open_price": (F.min_by("price", by), {"price", "trade_id"}),
        "high_price": (F.max("price"), {"price"}),
        "low_price": (F.min("price"), {"price"}),
        "close_price": (F.max_by("price", by), {"price", "trade_id"}),
        "base_volume": (F.sum(q), {"quantity"}),
        "quote_volume": (F.sum(n), {"notional"}),
        "trade_count": (F.count(F.lit(1)), set()),
        "taker_buy_base_volume": (
            F.sum(F.when(taker_buy, q).otherwise(zero)), {"is_buyer_aggressor", "quantity"}),
        "taker_buy_quote_volume": (
            F.sum(F.when(taker_buy, n).otherwise(zero)), {"is_buyer_aggressor", "notional"}),
        "largest_trade_size": (F.max(q), {"quantity"}),
        "first_trade_time": (F.min(t), set()),
        "last_trade_time": (F.max(t), set()),
        "first_trade_id": (F.min("trade_id"), {"trade_id"}),
        "last_trade_id": (F.max("trade_id"), {"trade_id"}),
        "mean_ingestion_lag_ms": (F.avg("ingestion_lag_ms"), {"ingestion_lag_ms"}),
        "max_ingestion_lag_ms": (F.max("ingestion_lag_ms"), {"ingestion_lag_ms"}),
        "duplicated_trade_count": (F.sum(repeated), {"_duplicate_count"}),
        "built_from_data_as_of": (F.max("lake_ingested_at"), {"lake_ingested_at"}),
    }
    return [(column.alias(name), reads) for name, (column, reads) in named.items()]


def with_bar_ratios(bars: DataFrame) -> DataFrame:
    """Averages and ratios of a candle. Notional is price x quantity, and every trade
    has one of two takers, so VWAP and flow imbalance follow from sums already taken."""
    base = F.col("base_volume")
    return bars.withColumns(
        {
            "vwap": money.quotient(F.col("quote_volume"), base),
            "order_flow_imbalance": F.round(
                money.divide(2 * F.col("taker_buy_base_volume") - base, base), 10
            ),
            "mean_trade_size": F.round(money.divide(base, F.col("trade_count")), 10),
            "taker_buy_ratio": money.ratio(F.col("taker_buy_base_volume"), base),
            "range_bps": money.ratio(
                (F.col("high_price") - F.col("low_price")).cast("double") * 20_000,
                F.col("high_price").cast("double") + F.col("low_price").cast("double"),
            ),
        }
    )


def with_log_returns(
    bars: DataFrame,
    keys: Sequence[str] = BAR_KEYS,
    chunk_seconds: int = 7 * 86_400,
    previous: DataFrame | None = None,
) -> DataFrame:
    """``ln(close / previous close)`` per key.

    ``previous`` holds the last bar of each key before the rebuilt window
    (keys, bar_start, close_price); without it an incremental run would give the
    first bar of its window a null return.
    """
    cols = bars.columns
    work = bars
    if previous is not None:
        seed = previous.select(*keys, "bar_start", "close_price").withColumn("__seed", F.lit(True))
        work = bars.unionByName(seed, allowMissingColumns=True)
    work = neighbours(
        work,
        keys,
        ["bar_start"],
        clock.bucket_id(F.col("bar_start"), chunk_seconds),
        lag={"__prev_close": "close_price"},
    )
    if previous is not None:
        work = work.filter(F.col("__seed").isNull())
    # ln(x) is taken on a positive quotient only; a zero close yields null.
    quotient = money.divide(F.col("close_price"), F.col("__prev_close"))
    return work.select(*cols, F.when(quotient > 0, F.ln(quotient)).alias("log_return"))


def bars(
    trades: DataFrame,
    seconds: int = 60,
    keys: Sequence[str] = BAR_KEYS,
    t: str = "event_time",
    previous: DataFrame | None = None,
    stage: Stage = keep_lazy,
) -> DataFrame:
    """Candles with log returns. Chunks hold about ten thousand bars per key."""
    aggregated = stage(aggregate_bars(trades, seconds, keys, t))
    return with_log_returns(aggregated, keys, seconds * 10_080, previous)
