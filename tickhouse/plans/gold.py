"""Gold facts, dimensions and marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions import money
from tickhouse.functions.money import divide, ratio
from tickhouse.operators.intervals import interval_join
from tickhouse.operators.telemetry import quantile

MINUTES_PER_DAY = 1_440

# Reconciliation tolerances and verdict thresholds.
PRICE_TOLERANCE = 0.0001
VOLUME_TOLERANCE = 0.005
COUNT_TOLERANCE = 2
MIN_COVERAGE = 0.90
MAX_MISSED_MINUTES = 5
MIN_PASS_RATIO = 0.98
MAX_P99_LAG_MS = 30_000
MAX_QUOTE_GAPS = 120
LOW_QUOTE_COVERAGE = 0.95
RANKING_WINDOWS = (1, 7, 30)


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def market_fact(
    bars: DataFrame,
    quote_metrics: DataFrame,
    fx: DataFrame,
    pair: str = "USDCOP",
    rate_source: str | None = None,
) -> DataFrame:
    """What traded, what was quoted, and its value in local currency, per bar.

    Both joins are left joins from the trade side: a bar without a quote is a
    quiet book, not missing data. Bars and quote metrics are grouped by the same
    keys they join on, so that join reuses their shuffles.
    """
    rates = fx.filter(F.col("currency_pair") == pair)
    if rate_source is not None:
        rates = rates.filter(F.col("rate_source") == rate_source)
    rates = rates.select(F.col("rate").alias("usdcop_rate"), "valid_from", "valid_to")
    quote_cols = (
        "time_weighted_spread_bps", "mean_spread_bps", "median_spread_bps", "mean_touch_depth",
        "mean_touch_imbalance", "quote_count", "quote_coverage_ratio", "book_updates_skipped",
    )
    keys = ["exchange_id", "symbol", "bar_start"]
    joined = interval_join(
        bars.join(quote_metrics.select(*keys, *quote_cols), keys, "left"),
        rates,
        "bar_start",
        "valid_from",
        "valid_to",
        open_ends=False,
    )
    rate = F.col("usdcop_rate")
    return joined.select(
        "exchange_id", "symbol", "bar_start", "bar_end",
        "open_price", "high_price", "low_price", "close_price", "vwap",
        "base_volume", "quote_volume", "trade_count", "log_return", "range_bps",
        "order_flow_imbalance", "taker_buy_ratio", "taker_buy_base_volume",
        "largest_trade_size", "mean_trade_size",
        *quote_cols,
        "usdcop_rate",
        money.convert(F.col("close_price"), rate).alias("close_price_cop"),
        money.convert(F.col("quote_volume"), rate).alias("quote_volume_cop"),
        "max_ingestion_lag_ms", "duplicated_trade_count",
        F.col("quote_count").isNull().alias("is_quote_gap"),
        (F.coalesce("quote_coverage_ratio", F.lit(0)) < LOW_QUOTE_COVERAGE).alias(
            "is_low_quote_coverage"
        ),
    )


def symbol_daily(
    fact: DataFrame, bar_minutes: int = 1, keys: Sequence[str] = ("exchange_id", "symbol")
) -> DataFrame:
    """Roll minute bars up to one row per instrument and day.

    ``bar_minutes`` is the length of the fact's bars. ``turnover_rank`` sorts
    one row per instrument within a day.
    """
    minute = F.col("bar_start")
    spread = F.col("time_weighted_spread_bps")
    base = F.col("base_volume")
    weighted = fact.withColumn("__weighted", money.multiply(F.col("vwap"), base))
    daily = (
        weighted.groupBy(*keys, F.to_date("bar_start").alias("trading_date"))
        .agg(
            F.min_by("open_price", minute).alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", minute).alias("close_price"),
            F.sum(base).alias("base_volume"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trade_count").alias("trade_count"),
            money.quotient(F.sum("__weighted"), F.sum(base)).alias("daily_vwap"),
            money.mean(spread).alias("mean_spread_bps"),
            F.percentile_approx(spread, 0.5, 10_000).alias("median_spread_bps"),
            money.mean(F.col("mean_touch_depth")).alias("mean_touch_depth"),
            F.count(spread).alias("minutes_with_quotes"),
            F.count(F.lit(1)).alias("minutes_with_trades"),
            money.mean(F.col("order_flow_imbalance"), 10).alias("mean_order_flow_imbalance"),
            F.sum("taker_buy_base_volume").alias("taker_buy_base_volume"),
            money.annualised_volatility(F.col("log_return"), bar_minutes).alias(
                "realised_volatility_annualised"
            ),
            F.stddev_samp("log_return").alias("minute_return_stddev"),
            F.max("range_bps").alias("max_minute_range_bps"),
            F.max("usdcop_rate").alias("usdcop_rate"),
            _count_if(F.col("is_quote_gap")).alias("quote_gap_minutes"),
            F.sum("book_updates_skipped").alias("book_updates_skipped"),
            F.max("max_ingestion_lag_ms").alias("max_ingestion_lag_ms"),
            F.sum("quote_volume_cop").alias("quote_volume_cop_from_minutes"),
        )
        .withColumns(
            {
                "minute_coverage_ratio": ratio(
                    F.col("minutes_with_trades"), F.lit(MINUTES_PER_DAY // bar_minutes)
                ),
                "daily_return": F.round(
                    divide(F.col("close_price") - F.col("open_price"), F.col("open_price")), 10
                ),
                "quote_volume_cop": money.convert(
                    F.col("quote_volume"), F.col("usdcop_rate")
                ).cast("decimal(38,4)"),
            }
        )
    )
    in_day = Window.partitionBy("trading_date").orderBy(
        F.col("quote_volume").desc_nulls_last(), *keys[::-1]
    )
    return daily.withColumn("turnover_rank", F.row_number().over(in_day).cast("bigint"))


def reconcile(ours: DataFrame, venue: DataFrame, since=None) -> DataFrame:
    """Our candles against the venue's own, bar by bar.

    ``since`` cuts both sides at the same bar, so an incremental run never
    mistakes an old venue bar for one we missed.
    """
    keys = ["exchange_id", "symbol", "bar_start"]
    measures = ("close_price", "base_volume", "trade_count")
    if since is not None:
        ours = ours.filter(F.col("bar_start") >= F.lit(since))
        venue = venue.filter(F.col("bar_start") >= F.lit(since))
    left = ours.select(*keys, *[F.col(m).alias(f"our_{m}") for m in measures],
                       F.lit(True).alias("__ours"))
    right = venue.select(*keys, *[F.col(m).alias(f"venue_{m}") for m in measures],
                         F.lit(True).alias("__venue"))
    both = left.join(right, keys, "full_outer")

    def rel_diff(measure: str) -> Column:
        mine, theirs = F.col(f"our_{measure}"), F.col(f"venue_{measure}")
        return F.round(divide(F.abs(mine - theirs), theirs), 10)

    both = both.withColumns(
        {
            "close_price_rel_diff": rel_diff("close_price"),
            "volume_rel_diff": rel_diff("base_volume"),
            "trade_count_diff": F.col("our_trade_count") - F.col("venue_trade_count"),
            "match_status": F.when(F.col("__ours").isNull(), "missing_from_ours")
            .when(F.col("__venue").isNull(), "missing_from_venue")
            .otherwise("matched"),
        }
    ).drop("__ours", "__venue")
    status = (
        F.when(F.col("match_status") != "matched", "unmatched")
        .when(F.coalesce("close_price_rel_diff", F.lit(0.0)) > PRICE_TOLERANCE, "price_divergence")
        .when(F.coalesce("volume_rel_diff", F.lit(0.0)) > VOLUME_TOLERANCE, "volume_divergence")
        .when(F.abs(F.coalesce("trade_count_diff", F.lit(0))) > COUNT_TOLERANCE, "count_divergence")
        .otherwise("ok")
    )
    return both.withColumn("reconciliation_status", status)


def reconciliation_daily(reconciled: DataFrame, keys: Sequence[str] = ("exchange_id", "symbol")):
    status = F.col("reconciliation_status")
    return reconciled.groupBy(*keys, F.to_date("bar_start").alias("trading_date")).agg(
        F.count(F.lit(1)).alias("reconciled_minutes"),
        _count_if(status == "ok").alias("matched_minutes"),
        _count_if(status == "volume_divergence").alias("volume_divergence_minutes"),
        _count_if(F.col("match_status") == "missing_from_ours").alias("minutes_we_missed"),
        F.max("volume_rel_diff").alias("worst_volume_rel_diff"),
    )


def delivery_daily(
    trades: DataFrame, keys: Sequence[str] = ("exchange_id", "symbol"), exact: bool = False
) -> DataFrame:
    """Replays and ingestion lag per instrument and day; ``exact`` as for ``quantile``."""
    lag = F.col("ingestion_lag_ms")
    return trades.groupBy(*keys, F.to_date("event_time").alias("trading_date")).agg(
        F.count(F.lit(1)).alias("trades"),
        _count_if(F.col("_duplicate_count") > 1).alias("replayed_trades"),
        F.avg(lag).alias("mean_ingestion_lag_ms"),
        quantile("ingestion_lag_ms", 0.99, exact).alias("p99_ingestion_lag_ms"),
    )


def instrument_day_health(
    daily: DataFrame, reconciled: DataFrame, trades: DataFrame,
    keys: Sequence[str] = ("exchange_id", "symbol"),
) -> DataFrame:
    """One quality verdict per instrument and day; the first rule that applies wins.

    The lag that decides a verdict is exact: a sketch would be off on busy days.
    """
    by = [*keys, "trading_date"]
    joined = (
        daily.select(
            *by, "minutes_with_trades", "minute_coverage_ratio", "quote_gap_minutes",
            "book_updates_skipped", "max_ingestion_lag_ms",
        )
        .join(reconciliation_daily(reconciled, keys), by, "left")
        .join(delivery_daily(trades, keys, exact=True), by, "left")
    )
    pass_ratio = ratio(F.col("matched_minutes"), F.col("reconciled_minutes"))
    verdict = (
        F.when(F.col("minute_coverage_ratio") < MIN_COVERAGE, "incomplete")
        .when(F.coalesce("minutes_we_missed", F.lit(0)) > MAX_MISSED_MINUTES, "incomplete")
        .when(F.coalesce("reconciliation_pass_ratio", F.lit(1)) < MIN_PASS_RATIO, "divergent")
        .when(F.coalesce("p99_ingestion_lag_ms", F.lit(0)) > MAX_P99_LAG_MS, "delayed")
        .when(F.col("quote_gap_minutes") > MAX_QUOTE_GAPS, "degraded_liquidity_view")
        .otherwise("good")
    )
    return joined.withColumns(
        {
            "reconciliation_pass_ratio": pass_ratio,
            "duplicate_ratio": ratio(F.col("replayed_trades"), F.col("trades")),
        }
    ).withColumn("quality_verdict", verdict)


def liquidity_ranking(
    daily: DataFrame,
    health: DataFrame,
    as_of: date,
    windows: Sequence[int] = RANKING_WINDOWS,
    keys: Sequence[str] = ("exchange_id", "symbol"),
) -> DataFrame:
    """Trailing-window league table over instrument-days with a good verdict.

    Each day is copied into the windows it falls in, so the marts are read once
    for all windows. A window of N days reaches back to ``as_of - N`` inclusive.
    """
    good = health.filter(F.col("quality_verdict") == "good").select(*keys, "trading_date")
    today = F.lit(as_of)
    recent = daily.filter(F.col("trading_date") >= F.date_sub(today, max(windows))).join(
        good, [*keys, "trading_date"], "left_semi"
    )
    exploded = recent.withColumn(
        "window_days", F.explode(F.array(*[F.lit(int(w)) for w in windows]))
    ).filter(F.col("trading_date") >= F.date_sub(today, F.col("window_days")))
    trailing = exploded.groupBy("window_days", *keys).agg(
        F.sum("quote_volume").alias("quote_volume"),
        money.mean(F.col("mean_spread_bps")).alias("mean_spread_bps"),
        money.mean(F.col("mean_touch_depth")).alias("mean_touch_depth"),
        money.quantize(F.avg("realised_volatility_annualised")).alias("realised_volatility"),
        F.sum("trade_count").alias("trade_count"),
        F.count(F.lit(1)).alias("days_observed"),
    )
    scored = trailing.withColumn(
        "liquidity_score", money.quantize(divide(F.col("quote_volume"), F.col("mean_spread_bps")))
    )
    in_window = Window.partitionBy("window_days")

    def rank_by(order: Column) -> Column:
        return F.rank().over(in_window.orderBy(order)).cast("bigint")

    return scored.withColumns(
        {
            "turnover_rank": rank_by(F.col("quote_volume").desc_nulls_last()),
            "tightness_rank": rank_by(F.col("mean_spread_bps").asc_nulls_last()),
            "liquidity_rank": rank_by(F.col("liquidity_score").desc_nulls_last()),
        }
    )


def observed_instruments(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(
        F.min("event_time").alias("first_trade_seen_at"),
        F.max("event_time").alias("last_trade_seen_at"),
        F.count(F.lit(1)).alias("lifetime_trade_count"),
        F.sum("notional").alias("lifetime_notional"),
    )


def dim_instrument(reference: DataFrame, trades: DataFrame) -> DataFrame:
    """Instruments we intend to carry against instruments that arrived."""
    declared = reference.withColumn("__declared", F.lit(True))
    seen = observed_instruments(trades).withColumn("__seen", F.lit(True))
    joined = declared.join(seen, "symbol", "full_outer")
    status = (
        F.when(F.col("__declared").isNull(), "unexpected_in_lake")
        .when(F.col("__seen").isNull() & F.col("is_tracked"), "tracked_but_absent")
        .when(F.col("__seen").isNull(), "reference_only")
        .otherwise("ok")
    )
    return joined.withColumns(
        {
            "coverage_status": status,
            "is_tracked": F.coalesce("is_tracked", F.lit(False)),
            "lifetime_trade_count": F.coalesce("lifetime_trade_count", F.lit(0)),
            "lifetime_notional": F.coalesce("lifetime_notional", F.lit(0)),
        }
    ).drop("__declared", "__seen")
