"""Registered queries over trades, quotes, rates and the gold tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.catalogue.present import present
from tickhouse.functions import clock
from tickhouse.functions.money import MONEY
from tickhouse.operators import bars as bar_ops
from tickhouse.operators import intervals, scd, staging
from tickhouse.operators import quotes as quote_ops
from tickhouse.operators.dedup import dedup
from tickhouse.operators.sequence import observe_sequence
from tickhouse.plans import gold, serving, silver
from tickhouse.session import configure
from tickhouse.sources.sample_tables import SampleTables
from tickhouse.sources.staged import stage

HOUR = 3_600
AS_OF = date(2024, 1, 31)
# A customer's symbol is observed a few times a year, so chunks are long.
_SPARSE = 1_000 * 86_400
# A symbol of that tape trades every few days.
_QUARTER = 90 * 86_400


def tables(spark: SparkSession, path: str) -> SampleTables:
    return SampleTables(configure(spark), path)


# -- deduplication ---------------------------------------------------------------------


def dedup_trades(spark, path) -> DataFrame:
    out = silver.trades(tables(spark, path).landed_trades(), stage)
    return present(
        out, "exchange_id", "symbol", "trade_id", "price", "quantity", "notional",
        "signed_quantity", "event_time", "producer_ingested_at", "lake_ingested_at",
        "kafka_offset", "ingestion_lag_ms", "bar_start_1m", "bar_start_5m", "_duplicate_count",
    )


def dedup_lineitem(spark, path) -> DataFrame:
    items = tables(spark, path).read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice",
    )
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    out = dedup(items, ("l_orderkey", "l_linenumber"), order, keep="last", count_col="copies")
    return present(out)


def duplicate_rate(spark, path) -> DataFrame:
    trades = silver.trades(tables(spark, path).landed_trades())
    rate = trades.groupBy("exchange_id", "symbol").agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum(F.when(F.col("_duplicate_count") > 1, 1).otherwise(0)).alias("replayed_trades"),
        F.sum("_duplicate_count").alias("landed_rows"),
    )
    return present(
        rate.withColumn(
            "duplicate_ratio", gold.ratio(F.col("replayed_trades"), F.col("trades"))
        )
    )


# -- staging ---------------------------------------------------------------------------


def stage_trades(spark, path) -> DataFrame:
    return present(
        staging.assign_bars(staging.stage_trades(tables(spark, path).landed_trades())).drop(
            "kafka_topic", "kafka_partition", "producer_id"
        )
    )


def stage_quotes(spark, path) -> DataFrame:
    return present(
        staging.stage_quotes(tables(spark, path).landed_quotes()).drop(
            "kafka_partition", "producer_id", "schema_version", "producer_ingested_at"
        )
    )


def stage_klines(spark, path) -> DataFrame:
    return present(
        staging.stage_klines(tables(spark, path).landed_klines()).drop(
            "producer_id", "producer_ingested_at", "lake_ingested_at"
        )
    )


def stage_fx(spark, path) -> DataFrame:
    return present(
        staging.stage_fx(tables(spark, path).landed_fx()).drop(
            "producer_ingested_at", "lake_ingested_at"
        )
    )


# -- candles ---------------------------------------------------------------------------


def _bars(spark, path, seconds) -> DataFrame:
    return silver.ohlcv(silver.trades(tables(spark, path).landed_trades()), seconds, stage=stage)


def bars_1m(spark, path) -> DataFrame:
    return present(_bars(spark, path, 60))


def bars_5m(spark, path) -> DataFrame:
    return present(_bars(spark, path, 300))


def bars_1h(spark, path) -> DataFrame:
    return present(_bars(spark, path, HOUR))


def bars_1w(spark, path) -> DataFrame:
    return present(_bars(spark, path, clock.interval_seconds("1w")))


def bars_lineitem_daily(spark, path) -> DataFrame:
    daily = bar_ops.aggregate_bars(tables(spark, path).tape(), 86_400, sparse=True)
    # (order, line) repeats on this tape, so the first and last print of a bar are not unique,
    # and there are no returns to look for.
    return present(daily.drop("open_price", "close_price"))


# -- quotes ----------------------------------------------------------------------------


def quote_durations(spark, path) -> DataFrame:
    out = silver.quotes(tables(spark, path).landed_quotes(), stage)
    return present(
        out, "exchange_id", "symbol", "update_id", "spread_bps", "mid_price", "event_time",
        "next_event_time", "prevailing_ms", "book_updates_between", "bar_start_1m",
    )


def quote_metrics_1h(spark, path) -> DataFrame:
    quotes = silver.quotes(tables(spark, path).landed_quotes(), stage)
    return present(silver.quote_metrics(quotes, HOUR, discrete_median=True))


def quote_metrics_1h_clipped(spark, path) -> DataFrame:
    metrics = quote_ops.quote_metrics(
        silver.quotes(tables(spark, path).landed_quotes(), stage), HOUR, split_at_bar_end=True
    )
    return present(
        metrics, "exchange_id", "symbol", "bar_start", "quote_count", "covered_ms",
        "time_weighted_spread_bps", "book_updates_skipped", "quote_coverage_ratio",
    )


# -- validity intervals ----------------------------------------------------------------


def _order_rates(spark, path) -> DataFrame:
    return intervals.rebound_intervals(
        tables(spark, path).publications(), ["currency_pair"], order=("publication_id",),
        stage=stage,
    )


def fx_intervals(spark, path) -> DataFrame:
    return present(_order_rates(spark, path))


def fx_intervals_events(spark, path) -> DataFrame:
    return present(
        silver.fx_rates(tables(spark, path).landed_fx(), stage), "rate_source", "currency_pair", "rate",
        "valid_from", "valid_to", "source_valid_to", "validity_days", "was_rebounded",
    )


_FX_COLS = ("trade_id", "symbol", "event_time", "currency_pair", "notional", "rate", "valid_from")


def fx_range_join(spark, path) -> DataFrame:
    """As-of form: the rate is carried forward along each pair's timeline."""
    joined = intervals.asof_join(
        tables(spark, path).tape(), _order_rates(spark, path), "event_time", "valid_from",
        "valid_to", on=("currency_pair",),
    )
    return present(joined, *_FX_COLS)


def fx_range_join_bucketed(spark, path) -> DataFrame:
    """Equi-join form on (pair, day)."""
    joined = intervals.interval_join(
        tables(spark, path).tape(), _order_rates(spark, path), "event_time", "valid_from",
        "valid_to", on=("currency_pair",), open_ends=False,
    )
    return present(joined, *_FX_COLS)


# -- gold ------------------------------------------------------------------------------


def _fact(spark, path, seconds=HOUR) -> DataFrame:
    t = tables(spark, path)
    return gold.market_fact(
        silver.ohlcv(silver.trades(t.landed_trades()), seconds, stage=stage),
        silver.quote_metrics(
            silver.quotes(t.landed_quotes(), stage), seconds, discrete_median=True
        ),
        silver.fx_rates(t.landed_fx(), stage),
    )


def _daily(spark, path) -> DataFrame:
    return gold.symbol_daily(_fact(spark, path), bar_minutes=60)


def _reconciled(spark, path) -> DataFrame:
    return gold.reconcile(
        _bars(spark, path, HOUR), silver.venue_klines(tables(spark, path).landed_klines())
    )


def _daily_and_health(spark, path) -> tuple[DataFrame, DataFrame]:
    """The gold chain, each table written once and read by what follows it."""
    t = tables(spark, path).with_events_stored(stage)
    trades = stage(silver.trades(t.landed_trades(), stage))
    bars = stage(silver.ohlcv(trades, HOUR, stage=stage))
    metrics = silver.quote_metrics(
        silver.quotes(t.landed_quotes(), stage), HOUR, discrete_median=True
    )
    fact = gold.market_fact(bars, metrics, silver.fx_rates(t.landed_fx(), stage))
    daily = stage(gold.symbol_daily(fact, bar_minutes=60))
    reconciled = gold.reconcile(bars, silver.venue_klines(t.landed_klines()))
    return daily, gold.instrument_day_health(daily, reconciled, trades)


def market_fact(spark, path) -> DataFrame:
    return present(_fact(spark, path))


def market_fact_1m(spark, path) -> DataFrame:
    return present(
        _fact(spark, path, 60), "exchange_id", "symbol", "bar_start", "close_price", "vwap",
        "trade_count", "log_return", "time_weighted_spread_bps", "quote_coverage_ratio",
        "usdcop_rate", "close_price_cop", "quote_volume_cop", "is_quote_gap",
        "is_low_quote_coverage",
    )


def symbol_daily(spark, path) -> DataFrame:
    return present(_daily(spark, path))


def realised_volatility(spark, path) -> DataFrame:
    from tickhouse.functions.money import annualised_volatility

    vol = (
        _bars(spark, path, HOUR)
        .groupBy("exchange_id", "symbol")
        .agg(
            F.stddev_samp("log_return").alias("return_stddev"),
            annualised_volatility(F.col("log_return"), 60).alias("realised_volatility_annualised"),
        )
    )
    return present(vol)


def turnover_rank(spark, path) -> DataFrame:
    return present(
        _daily(spark, path), "trading_date", "exchange_id", "symbol", "quote_volume",
        "turnover_rank",
    )


def kline_reconciliation(spark, path) -> DataFrame:
    return present(_reconciled(spark, path))


def reconciliation_daily(spark, path) -> DataFrame:
    return present(gold.reconciliation_daily(_reconciled(spark, path)))


def delivery_daily(spark, path) -> DataFrame:
    return present(gold.delivery_daily(
        silver.trades(tables(spark, path).landed_trades()), exact=True))


def instrument_day_health(spark, path) -> DataFrame:
    return present(_daily_and_health(spark, path)[1])


def liquidity_ranking(spark, path) -> DataFrame:
    return present(gold.liquidity_ranking(*_daily_and_health(spark, path), AS_OF))


def dim_instrument(spark, path) -> DataFrame:
    t = tables(spark, path)
    return present(gold.dim_instrument(t.reference(), t.part_tape()))


# -- history, as-of and sequence -------------------------------------------------------


def instrument_scd2(spark, path) -> DataFrame:
    return present(
        scd.scd2(
            tables(spark, path).observations(), tie_break=("observation_id",),
            close_deletes=False, chunk_seconds=_SPARSE, stage=stage,
        )
    )


def instrument_scd2_deletes(spark, path) -> DataFrame:
    return present(
        scd.scd2(tables(spark, path).quarterly_observations(), tie_break=("observation_id",),
                 stage=stage)
    )


def tick_asof(spark, path) -> DataFrame:
    """The tick size in force when each trade printed, and whether the price is on that grid."""
    t = tables(spark, path)
    history = scd.scd2(
        t.observations(), tie_break=("observation_id",), close_deletes=False,
        chunk_seconds=_SPARSE, stage=stage,
    )
    filters = stage(history.select("symbol", "tick_size", "valid_from", "valid_to"))
    joined = intervals.asof_join(
        t.tape(), filters, "event_time", "valid_from", "valid_to", on=("symbol",),
        chunk_seconds=_QUARTER, sparse=True,
    )
    # Both have 18 decimals, which a remainder keeps.
    off = F.pmod(F.col("price").cast(MONEY), F.col("tick_size").cast(MONEY))
    return present(
        joined.withColumn("is_off_grid", off != 0), "trade_id", "symbol", "event_time", "price",
        "tick_size", "valid_from", "is_off_grid",
    )


def sequence_observations(spark, path) -> DataFrame:
    """Book update ids in arrival order; a day is one connection."""
    e = tables(spark, path).events()
    arrived = e.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("kafka_offset"),
        F.to_date("ts").alias("session"),
        (F.col("event_id") * 7 - F.when(F.col("k") < 10, 500).otherwise(0)).alias("update_id"),
    )
    return present(observe_sequence(arrived, session="session"))


# -- serving ---------------------------------------------------------------------------


def serve_instruments(spark, path) -> DataFrame:
    t = tables(spark, path)
    dim = gold.dim_instrument(t.reference(), t.part_tape())
    return present(serving.instruments(dim, tracked_only=True))


def serve_candles(spark, path) -> DataFrame:
    page = serving.candles(
        _fact(spark, path), "click", "2024-01-05T00:00:00Z", "2024-01-12T00:00:00Z", limit=500
    )
    return present(page.rows)


def serve_liquidity(spark, path) -> DataFrame:
    ranking = gold.liquidity_ranking(*_daily_and_health(spark, path), AS_OF)
    return present(serving.liquidity(ranking, window_days=30, limit=50))


def serve_quality(spark, path) -> DataFrame:
    return present(serving.quality(_daily_and_health(spark, path)[1], AS_OF, symbol="view", days=30))


QUERIES = {
    f.__name__: f
    for f in (
        dedup_trades, dedup_lineitem, duplicate_rate,
        stage_trades, stage_quotes, stage_klines, stage_fx,
        bars_1m, bars_5m, bars_1h, bars_1w, bars_lineitem_daily,
        quote_durations, quote_metrics_1h, quote_metrics_1h_clipped,
        fx_intervals, fx_intervals_events, fx_range_join, fx_range_join_bucketed,
        market_fact, market_fact_1m, symbol_daily, realised_volatility, turnover_rank,
        kline_reconciliation, reconciliation_daily, delivery_daily, instrument_day_health,
        liquidity_ranking, dim_instrument,
        instrument_scd2, instrument_scd2_deletes, tick_asof, sequence_observations,
        serve_instruments, serve_candles, serve_liquidity, serve_quality,
    )
}
