from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickhouse.catalogue import market
from tickhouse.plans import gold, serving
from tickhouse.sources.staged import stage

T0 = datetime(2024, 1, 1)
KEYS = "exchange_id string, symbol string, bar_start timestamp"


def bars(spark, data):
    """(minute, close, volume, count)"""
    return spark.createDataFrame(
        [("x", "S", T0 + timedelta(minutes=m), Decimal(c), Decimal(v), n) for m, c, v, n in data],
        f"{KEYS}, close_price decimal(38,18), base_volume decimal(38,18), trade_count long")


def test_all_reconciliation_statuses(spark):
    ours = bars(spark, [(0, "100", "10", 5), (1, "100", "10", 5), (2, "100", "10", 5),
                        (3, "100", "10", 5), (4, "100", "10", 5)])
    venue = bars(spark, [(0, "100", "10", 7), (1, "100.02", "10", 5), (2, "100", "10.1", 5),
                         (3, "100", "10", 8), (5, "100", "10", 5)])
    got = {r["bar_start"].minute: (r["match_status"], r["reconciliation_status"])
           for r in rows(gold.reconcile(ours, venue))}
    assert got == {0: ("matched", "ok"), 1: ("matched", "price_divergence"),
                   2: ("matched", "volume_divergence"), 3: ("matched", "count_divergence"),
                   4: ("missing_from_venue", "unmatched"), 5: ("missing_from_ours", "unmatched")}
    recent = gold.reconcile(ours, venue, since=T0 + timedelta(minutes=4))
    assert {r["bar_start"].minute for r in rows(recent)} == {4, 5}


def health_inputs(spark, coverage, missed, ok, total, lag, gaps):
    daily = spark.createDataFrame(
        [("x", "S", T0.date(), 1440, Decimal(coverage), gaps, 0, 0)],
        "exchange_id string, symbol string, trading_date date, minutes_with_trades long,"
        " minute_coverage_ratio decimal(18,6), quote_gap_minutes long, book_updates_skipped long,"
        " max_ingestion_lag_ms long")
    data = [("ok", "matched")] * ok + [("unmatched", "missing_from_ours")] * missed
    data += [("volume_divergence", "matched")] * (total - ok - missed)
    recon = spark.createDataFrame(
        [("x", "S", T0, s, m, 0.1) for s, m in data],
        f"{KEYS}, reconciliation_status string, match_status string, volume_rel_diff double")
    trades = spark.createDataFrame(
        [("x", "S", T0, lag, 2 if i else 1) for i in range(2)],
        "exchange_id string, symbol string, event_time timestamp, ingestion_lag_ms long,"
        " _duplicate_count long")
    return daily, recon, trades


@pytest.mark.parametrize(("case", "verdict"), [
    (("0.89", 0, 10, 10, 0, 0), "incomplete"),
    (("1", 6, 994, 1000, 0, 0), "incomplete"),
    (("1", 0, 9, 10, 99_999, 0), "divergent"),
    (("1", 0, 10, 10, 30_001, 999), "delayed"),
    (("1", 0, 10, 10, 30_000, 121), "degraded_liquidity_view"),
    (("0.90", 5, 995, 1000, 30_000, 120), "good"),
    (("1", 0, 0, 0, 0, 0), "good"),
])
def test_verdicts_apply_in_order(spark, case, verdict):
    got = rows(gold.instrument_day_health(*health_inputs(spark, *case)))[0]
    assert got["quality_verdict"] == verdict and got["duplicate_ratio"] == Decimal("0.5")


def busy_health(spark):
    """Verdict of a day with more trades than a quantile sketch keeps apart."""
    daily, recon, _ = health_inputs(spark, "1", 0, 10, 10, 0, 0)
    trades = spark.range(200_000, numPartitions=4).select(
        F.lit("x").alias("exchange_id"), F.lit("S").alias("symbol"), F.lit(T0).alias("event_time"),
        (F.col("id") * 7_919 % 200_000).alias("ingestion_lag_ms"),
        F.lit(1).cast("bigint").alias("_duplicate_count"))
    return gold.instrument_day_health(daily, recon, trades)


def test_busy_day_has_the_exact_lag(spark):
    assert rows(busy_health(spark))[0]["p99_ingestion_lag_ms"] == 197_999


def test_served_quality_has_the_exact_lag(spark):
    served = rows(serving.quality(busy_health(spark), T0.date(), symbol="S"))
    assert [(r["trading_date"], r["p99_ingestion_lag_ms"]) for r in served] == [(T0.date(), 197_999)]


def test_ranking_windows_and_null_order(spark):
    as_of = date(2024, 1, 31)
    data = [("A", 0, "100", "2"), ("A", 7, "100", "4"), ("B", 0, "300", None), ("C", 0, "50", "1"),
            ("D", 1, "900", "1"), ("E", 31, "1", "1")]
    daily = spark.createDataFrame(
        [("x", s, as_of - timedelta(days=d), Decimal(v), None if p is None else Decimal(p),
          Decimal(1), 0.5, 3) for s, d, v, p in data],
        "exchange_id string, symbol string, trading_date date, quote_volume decimal(38,18),"
        " mean_spread_bps decimal(18,6), mean_touch_depth decimal(18,6),"
        " realised_volatility_annualised double, trade_count long")
    health = daily.select("exchange_id", "symbol", "trading_date",
                          F.when(F.col("symbol") == "D", "delayed").otherwise("good")
                          .alias("quality_verdict"))
    got = rows(gold.liquidity_ranking(daily, health, as_of), "window_days", "symbol")
    one = {r["symbol"]: r for r in got if r["window_days"] == 1}
    assert set(one) == {"A", "B", "C"}
    assert [one[s]["turnover_rank"] for s in "ABC"] == [2, 1, 3]
    assert [one[s]["tightness_rank"] for s in "ABC"] == [2, 3, 1]
    assert [one[s]["liquidity_rank"] for s in "ABC"] == [1, 3, 1]
    week = {r["symbol"]: r for r in got if r["window_days"] == 7}
    assert week["A"]["quote_volume"] == 200 and week["A"]["mean_spread_bps"] == 3
    page = serving.liquidity(gold.liquidity_ranking(daily, health, as_of), 7, limit=2)
    assert [r["symbol"] for r in page.collect()] == ["A", "C"]


def test_market_fact_keeps_every_bar(spark):
    full = bars(spark, [(0, "10", "1", 1), (1, "10", "1", 1), (2, "10", "1", 1)])
    for c in ("open_price", "high_price", "low_price", "vwap", "quote_volume", "log_return",
              "range_bps", "order_flow_imbalance", "taker_buy_ratio", "taker_buy_base_volume",
              "largest_trade_size", "mean_trade_size"):
        full = full.withColumn(c, F.lit(2).cast("decimal(38,18)"))
    full = full.withColumns({"bar_end": F.col("bar_start"), "max_ingestion_lag_ms": F.lit(0),
                             "duplicated_trade_count": F.lit(0)})
    metrics = spark.createDataFrame(
        [("x", "S", T0, Decimal(1), Decimal(1), Decimal(1), Decimal(1), Decimal(0), 4, Decimal("0.9"), 0)],
        f"{KEYS}, time_weighted_spread_bps decimal(18,6), mean_spread_bps decimal(18,6),"
        " median_spread_bps decimal(18,6), mean_touch_depth decimal(18,6),"
        " mean_touch_imbalance decimal(18,6), quote_count long, quote_coverage_ratio decimal(18,6),"
        " book_updates_skipped long")
    fx = spark.createDataFrame(
        [("USDCOP", "a", Decimal(4000), T0 + timedelta(minutes=1), T0 + timedelta(days=1)),
         ("EURCOP", "a", Decimal(9), T0, T0 + timedelta(days=1)),
         ("USDCOP", "b", Decimal(5), T0, T0 + timedelta(days=1))],
        "currency_pair string, rate_source string, rate decimal(38,18), valid_from timestamp,"
        " valid_to timestamp")
    got = rows(gold.market_fact(full, metrics, fx, rate_source="a"), "bar_start")
    assert [r["usdcop_rate"] for r in got] == [None, 4000, 4000]
    assert [r["is_quote_gap"] for r in got] == [False, True, True]
    assert all(r["is_low_quote_coverage"] for r in got)
    assert got[1]["close_price_cop"] == 40_000 and got[1]["quote_volume_cop"] == 8_000


def test_dim_statuses(spark):
    ref = spark.createDataFrame([("A", True), ("B", True), ("C", False)],
                                "symbol string, is_tracked boolean")
    seen = spark.createDataFrame([("A", T0, Decimal(2)), ("Z", T0, Decimal(3))],
                                 "symbol string, event_time timestamp, notional decimal(38,18)")
    got = {r["symbol"]: (r["coverage_status"], r["is_tracked"], r["lifetime_trade_count"])
           for r in rows(gold.dim_instrument(ref, seen))}
    assert got == {"A": ("ok", True, 1), "B": ("tracked_but_absent", True, 0),
                   "C": ("reference_only", False, 0), "Z": ("unexpected_in_lake", False, 1)}


def candle_fact(spark, n):
    fact = bars(spark, [(m, "1", "1", 1) for m in range(n)])
    for c in serving.CANDLE_COLS:
        if c not in fact.columns:
            fact = fact.withColumn(c, F.lit(1))
    return fact


def test_candle_window_is_half_open_and_signals_truncation(spark):
    fact = candle_fact(spark, 10)
    page = serving.candles(fact, "S", "2024-01-01T00:02:00", "2024-01-01T00:05:00Z", limit=3)
    assert [r["bar_start"].minute for r in page.rows.collect()] == [2, 3, 4]
    assert not page.truncated()
    assert serving.candles(fact, "S", "2024-01-01T00:02:00", "2024-01-01T00:05:00", 2).truncated()
    default = serving.candles(fact, "s", now=datetime(2024, 1, 1, 0, 4), upper=True)
    assert default.rows.count() == 4
    with pytest.raises(serving.NotFound):
        serving.candles(fact, "Q", "2024-01-01", "2024-01-02").require()


@pytest.mark.parametrize(("start", "end", "limit"), [
    ("2024-01-02", "2024-01-01", 1), ("2024-01-01", "2024-02-02", 1),
    ("2024-01-01", "2024-01-02", 0), ("2024-01-01", "2024-01-02", 10_001)])
def test_candle_requests_are_checked(spark, start, end, limit):
    with pytest.raises(serving.RequestError):
        serving.candles(candle_fact(spark, 1), "S", start, end, limit)


def test_other_requests_are_checked(spark):
    with pytest.raises(serving.RequestError):
        serving.liquidity(spark.range(1), window_days=2)
    with pytest.raises(serving.RequestError):
        serving.quality(spark.range(1), date(2024, 1, 1), days=91)


def test_the_gold_chain_parses_the_events_once_over_all_cores(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(market, "stage", lambda df: staged.append(stage(df)) or staged[-1])
    market.instrument_day_health(spark, "/root/testdata/sf0.001")
    assert "props" in staged[0].columns or "k" in staged[0].columns
    assert len(staged[0].inputFiles()) >= spark.sparkContext.defaultParallelism
