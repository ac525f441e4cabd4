"""Registered queries over raw messages, quality checks, planning and telemetry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.catalogue.market import HOUR, _bars, _reconciled, tables
from tickhouse.catalogue.present import present
from tickhouse.functions import clock
from tickhouse.operators import ingest, intervals, planning, quality, staging, telemetry
from tickhouse.operators.dedup import grain_violations
from tickhouse.plans import gold, silver
from tickhouse.sources.staged import stage

AS_OF = datetime(2024, 1, 31)


# -- normalisation ---------------------------------------------------------------------


def parse_trades(spark, path) -> DataFrame:
    routed = ingest.route_frames(tables(spark, path).raw_trades())
    return present(
        ingest.normalise_trades(routed).valid, "exchange", "symbol", "trade_id", "price",
        "quantity", "quote_quantity", "buyer_is_maker", "trade_time", "event_time", "ingested_at",
    )


def parse_quotes(spark, path) -> DataFrame:
    routed = ingest.route_frames(tables(spark, path).raw_quotes())
    return present(
        ingest.normalise_quotes(routed).valid, "exchange", "symbol", "update_id", "bid_price",
        "bid_quantity", "ask_price", "ask_quantity", "event_time",
    )


def parse_klines(spark, path) -> DataFrame:
    out = ingest.normalise_klines(tables(spark, path).raw_klines()).valid
    return present(out.drop("schema_version", "ingested_at", "producer_id", "raw_payload"))


def parse_fx(spark, path) -> DataFrame:
    out = ingest.normalise_fx(tables(spark, path).raw_fx()).valid
    return present(out.drop("schema_version", "producer_id", "raw_payload"))


def parse_filters(spark, path) -> DataFrame:
    return present(ingest.instrument_observations(tables(spark, path).raw_instruments()))


def dead_letters(spark, path) -> DataFrame:
    """Every rejected message of the four feeds, by topic and error class."""
    t = tables(spark, path)
    trades, quotes = (ingest.route_frames(r) for r in (t.raw_trades(), t.raw_quotes()))
    rejected = (
        ingest.malformed_frames(trades)
        .unionByName(ingest.normalise_trades(trades).dead_letters)
        .unionByName(ingest.normalise_quotes(quotes).dead_letters)
        .unionByName(ingest.normalise_klines(t.raw_klines()).dead_letters)
        .unionByName(ingest.normalise_fx(t.raw_fx()).dead_letters)
    )
    return present(
        rejected.groupBy("origin_topic", "error_type", "error_message").agg(
            F.count(F.lit(1)).alias("messages"),
            F.count("origin_stream").alias("with_stream"),
            F.max("failed_at").alias("last_failed_at"),
        )
    )


def frame_routes(spark, path) -> DataFrame:
    t = tables(spark, path)
    frames = t.raw_trades().unionByName(t.raw_quotes())
    routed = ingest.route_frames(frames)
    return present(routed.groupBy("route").agg(F.count(F.lit(1)).alias("frames")))


# -- quality ---------------------------------------------------------------------------


def dq_constraints(spark, path) -> DataFrame:
    t = tables(spark, path)
    landed = t.landed_trades()
    trade_checks = [
        quality.not_null("trade_id"),
        quality.not_null("symbol"),
        quality.accepted_values("symbol", ["click", "view", "purchase", "signup"],
                                severity="warn", error_above=100),
        quality.in_range("price", 0, strictly=True),
        quality.in_range("quantity", 0, strictly=True),
        quality.in_range("ingestion_lag_ms", -10_000, 4_000, severity="warn"),
    ]
    bars = stage(_bars(spark, path, HOUR))
    open_, close = F.col("open_price"), F.col("close_price")
    bar_checks = [
        quality.holds("high is the top", F.col("high_price") >= F.greatest(open_, close)),
        quality.holds("low is the bottom", F.col("low_price") <= F.least(open_, close)),
        quality.holds("taker within total",
                      F.col("taker_buy_base_volume") <= F.col("base_volume")),
        quality.holds("vwap inside bar", F.col("vwap").between(F.col("low_price"),
                                                               F.col("high_price"))),
        quality.in_range("order_flow_imbalance", -1, 1),
        quality.in_range("taker_buy_ratio", 0, 1),
        quality.in_range("trade_count", 1),
        quality.not_null("log_return", error_above=5),
    ]
    staged = staging.stage_trades(landed)
    reference = staged.filter("price > 400").select("symbol")
    out = (
        quality.run_checks(staged, trade_checks, "landed_trades")
        .unionByName(quality.run_checks(bars, bar_checks, "bars"))
        .unionByName(quality.check_unique(staged, silver.TRADE_KEYS, "landed_trades"))
        .unionByName(quality.check_unique(bars, ("exchange_id", "symbol", "bar_start"), "bars"))
        .unionByName(
            quality.check_relationship(staged, "symbol", reference, "symbol", "landed_trades",
                                       severity="warn")
        )
        .unionByName(quality.check_row_count(bars, "bars"))
    )
    return present(out)


def dq_grain(spark, path) -> DataFrame:
    items = tables(spark, path).read("lineitem")
    return present(grain_violations(items, ("l_orderkey", "l_linenumber")))


def dq_contiguity(spark, path) -> DataFrame:
    bars = stage(_bars(spark, path, 300).select("exchange_id", "symbol", "bar_start"))
    return present(quality.bar_gaps(bars, max_gap_minutes=30))


def dq_overlap(spark, path) -> DataFrame:
    """Overlaps in the publications as issued, one per pair and day."""
    t = tables(spark, path)
    latest = t.publications().groupBy("currency_pair", "valid_from").agg(
        F.max("valid_to").alias("valid_to")
    )
    found = intervals.overlapping(latest, ["currency_pair"], "valid_from", "valid_to")
    return present(found)


def dq_gaps(spark, path) -> DataFrame:
    """Days without a rate if each publication held for one day only."""
    t = tables(spark, path)
    daily = t.publications().groupBy("currency_pair", "valid_from").agg(
        F.max(clock.plus_seconds(F.col("valid_from"), 86_400)).alias("valid_to")
    )
    return present(intervals.gaps(daily, ["currency_pair"], "valid_from", "valid_to"))


def dq_tick_grid(spark, path) -> DataFrame:
    """Trades off their instrument's grid, with a supplier-wide tick in place of a venue's."""
    t = tables(spark, path)
    nation = F.col("s_nationkey").cast("decimal(4,0)") + 1
    grid = t.read("supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
        (nation * F.lit("0.01").cast("decimal(3,2)")).alias("tick_size"),
    )
    return present(quality.off_tick(t.tape(), grid))


def dq_join_multiplication(spark, path) -> DataFrame:
    """Candles against a fact joined to rates that were never re-bounded, so they overlap."""
    t = tables(spark, path)
    bars = stage(_bars(spark, path, HOUR))
    raw = staging.stage_fx(t.landed_fx()).select("rate", "valid_from", "valid_to")
    multiplied = intervals.interval_join(
        bars, raw, "bar_start", "valid_from", "valid_to", how="inner", open_ends=False)
    return present(
        quality.join_multiplication(bars, multiplied, ("exchange_id", "symbol", "bar_start"))
    )


def dq_relationships(spark, path) -> DataFrame:
    t = tables(spark, path)
    lines = t.part_tape().groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"))
    return present(quality.orphans(lines, "symbol", t.reference(), "symbol"))


def dq_failing_rows(spark, path) -> DataFrame:
    trades = staging.stage_trades(tables(spark, path).landed_trades())
    check = quality.in_range("ingestion_lag_ms", -10_000, 4_000, severity="warn")
    return present(
        quality.failing_rows(trades, check), "symbol", "trade_id", "ingestion_lag_ms",
        "lake_ingested_at", "_check_name",
    )


def freshness(spark, path) -> DataFrame:
    t = tables(spark, path)
    trades = staging.stage_trades(t.landed_trades())
    orders = t.publications()
    fx = staging.stage_fx(t.landed_fx())
    return present(
        quality.freshness(trades, "event_time", AS_OF, "trades")
        .unionByName(quality.freshness(fx, "valid_from", AS_OF, "fx", 172_800, 432_000))
        .unionByName(quality.freshness(orders, "valid_from", AS_OF, "orders", 172_800, 432_000))
    )


def volume_baseline(spark, path) -> DataFrame:
    return present(quality.volume_baseline(tables(spark, path).events(), AS_OF, t="ts"))


def reconciliation_pass(spark, path) -> DataFrame:
    return present(quality.reconciliation_pass(_reconciled(spark, path), AS_OF))


def tracked_present(spark, path) -> DataFrame:
    t = tables(spark, path)
    return present(quality.instrument_anomalies(gold.dim_instrument(t.reference(), t.part_tape())))


# -- planning --------------------------------------------------------------------------


def _span(bars: DataFrame) -> DataFrame:
    """From each symbol's first bar to the day after its last."""
    last = clock.bar_floor(F.max("bar_start"), 86_400)
    return bars.groupBy("symbol").agg(
        clock.bar_floor(F.min("bar_start"), 86_400).alias("start"),
        clock.plus_seconds(last, 86_400).alias("end"),
    )


def _present_bars(spark, path) -> DataFrame:
    e = tables(spark, path).events()
    return stage(
        e.select(F.col("event_type").alias("symbol"),
                 clock.bar_floor(F.col("ts"), 300).alias("bar_start")).distinct()
    )


def completeness_plan(spark, path) -> DataFrame:
    """Five-minute bars missing from the tape, as requests of at most 20 bars."""
    bars = _present_bars(spark, path)
    return present(planning.missing_ranges(bars, _span(bars), 300, max_bars=20))


def completeness_daily(spark, path) -> DataFrame:
    bars = _present_bars(spark, path)
    spans = _span(bars)
    days = planning.day_windows(
        spans.select("symbol", "start", "end"), F.to_date("start"),
        F.date_sub(F.to_date("end"), 1),
    )
    return present(planning.completeness(bars, days, 300))


# -- telemetry -------------------------------------------------------------------------


def lag_histogram(spark, path) -> DataFrame:
    trades = staging.stage_trades(tables(spark, path).landed_trades())
    return present(telemetry.lag_histogram(trades, "ingestion_lag_ms", ["symbol"]))


def lag_percentiles(spark, path) -> DataFrame:
    trades = staging.stage_trades(tables(spark, path).landed_trades())
    return present(telemetry.lag_percentiles(trades, "ingestion_lag_ms", ["symbol"], exact=True))


def message_rates(spark, path) -> DataFrame:
    e = tables(spark, path).events()
    return present(telemetry.message_rates(e, "ts", ["event_type"]))


def table_status(spark, path) -> DataFrame:
    return present(
        telemetry.table_status(tables(spark, path).landed_trades(), "trade_time", ["symbol"])
    )


def stall_check(spark, path) -> DataFrame:
    """Silence per symbol at the as-of time, against the marks of half an hour earlier."""
    e = tables(spark, path).events()
    earlier = e.filter(F.col("ts") < F.lit(datetime(2024, 1, 30, 23, 30))).groupBy(
        "event_type"
    ).agg(F.max("ts").alias("high_water"))
    return present(telemetry.silence(e, "ts", ["event_type"], AS_OF, previous=earlier,
                                     limit_seconds=2_000))


QUERIES = {
    f.__name__: f
    for f in (
        parse_trades, parse_quotes, parse_klines, parse_fx, parse_filters, dead_letters,
        frame_routes,
        dq_constraints, dq_grain, dq_contiguity, dq_overlap, dq_gaps, dq_tick_grid,
        dq_join_multiplication, dq_relationships, dq_failing_rows,
        freshness, volume_baseline, reconciliation_pass, tracked_present,
        completeness_plan, completeness_daily,
        lag_histogram, lag_percentiles, message_rates, table_status, stall_check,
    )
}
