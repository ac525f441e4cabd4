"""Dedup, candles, quotes, sequences."""

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickhouse.catalogue import market, registry
from tickhouse.catalogue.present import present
from tickhouse.operators import bars as bar_ops
from tickhouse.operators import quotes as quote_ops
from tickhouse.operators.dedup import dedup, grain_violations
from tickhouse.operators.sequence import observe_sequence
from tickhouse.sources.staged import stage

T0 = datetime(2024, 1, 1)


def trades(spark, data):
    """(seconds, trade_id, price, size, buyer_is_maker)"""
    df = spark.createDataFrame(
        [("x", "S", i, Decimal(p), Decimal(q), m, T0 + timedelta(seconds=s), 5, 1, T0)
         for s, i, p, q, m in data],
        "exchange_id string, symbol string, trade_id long, price decimal(38,18),"
        " quantity decimal(38,18), buyer_is_maker boolean, event_time timestamp,"
        " ingestion_lag_ms long, _duplicate_count long, lake_ingested_at timestamp",
    )
    return df.withColumns({"notional": (F.col("price").cast("decimal(18,4)")
                                        * F.col("quantity").cast("decimal(18,4)")),
                           "is_buyer_aggressor": ~F.col("buyer_is_maker")})


def test_dedup_keeps_the_first_copy_and_counts_all(spark):
    df = spark.createDataFrame(
        [("a", 1, 30, "late"), ("a", 1, 10, "first"), ("a", 1, 20, "mid"), ("b", 1, 5, "only")],
        "s string, id long, at long, tag string",
    )
    got = rows(dedup(df, ["s", "id"], ["at"]), "s")
    assert [(r["tag"], r["_duplicate_count"]) for r in got] == [("first", 3), ("only", 1)]
    assert rows(dedup(df, ["s", "id"], ["at"], keep="last"), "s")[0]["tag"] == "late"
    assert rows(grain_violations(df, ["s", "id"])) == [{"s": "a", "id": 1, "row_count": 3}]


def test_a_replay_storm_on_one_key_is_folded_before_the_shuffle(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), "id", (F.col("id") % 7).alias("v"))
    out = dedup(df, ["k"], ["id"])
    assert rows(out) == [{"k": "hot", "id": 0, "v": 0, "_duplicate_count": 20_000}]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_two_trades_in_one_millisecond_order_by_id(spark):
    df = trades(spark, [(1, 2, "11", "1", True), (1, 1, "10", "1", False), (30, 3, "12", "2", False)])
    bar = rows(bar_ops.bars(df, 60))[0]
    assert (bar["open_price"], bar["close_price"], bar["trade_count"]) == (10, 12, 3)
    assert bar["vwap"] == Decimal("11.25") and bar["order_flow_imbalance"] == 0.5
    assert bar["taker_buy_base_volume"] == 3 and bar["log_return"] is None
    same_ms = rows(bar_ops.bars(df.filter("trade_id < 3"), 60))[0]
    assert (same_ms["open_price"], same_ms["close_price"]) == (10, 11)


def test_one_price_bar_has_vwap_inside_its_range(spark):
    bar = rows(bar_ops.bars(trades(spark, [(0, 1, "12.31", "3", True)]), 60))[0]
    assert bar["vwap"] == bar["low_price"] == bar["high_price"]
    assert bar["range_bps"] == 0 and bar["order_flow_imbalance"] == -1


def test_log_return_crosses_chunks_and_takes_a_seed(spark):
    df = trades(spark, [(0, 1, "10", "1", True), (86_400 * 30, 2, "20", "1", True)])
    got = rows(bar_ops.with_log_returns(bar_ops.aggregate_bars(df, 60), chunk_seconds=600),
               "bar_start")
    assert got[0]["log_return"] is None and abs(got[1]["log_return"] - np.log(2)) < 1e-12
    previous = bar_ops.aggregate_bars(df.filter("trade_id = 1"), 60)
    seeded = rows(bar_ops.bars(df.filter("trade_id = 2"), 60, previous=previous))
    assert len(seeded) == 1 and abs(seeded[0]["log_return"] - np.log(2)) < 1e-12


def quotes(spark, data):
    """(milliseconds, update_id, spread_bps)"""
    return spark.createDataFrame(
        [("x", "S", i, T0 + timedelta(milliseconds=ms), None if b is None else Decimal(b),
          Decimal(1), Decimal(2), Decimal(1), Decimal("-0.5")) for ms, i, b in data],
        "exchange_id string, symbol string, update_id long, event_time timestamp,"
        " spread_bps decimal(18,6), mid_price decimal(38,18), bid_quantity decimal(38,18),"
        " ask_quantity decimal(38,18), touch_imbalance decimal(18,6)",
    )


def test_a_burst_of_tight_quotes_does_not_hide_the_wide_one(spark):
    data = [(i, 10 + i, "1") for i in range(10)] + [(10, 30, "9"), (50_010, 31, "1")]
    got = rows(quote_ops.quote_metrics(quote_ops.with_durations(quotes(spark, data))))[0]
    assert got["quote_count"] == 11 and got["covered_ms"] == 50_010
    assert got["mean_spread_bps"] == Decimal("1.727273")
    assert got["time_weighted_spread_bps"] == Decimal("8.998400")
    assert got["book_updates_skipped"] == 10
    assert got["quote_coverage_ratio"] == Decimal("0.833500")


def test_a_quote_without_spread_counts_as_time_only(spark):
    df = quote_ops.with_durations(quotes(spark, [(0, 1, "4"), (100, 2, None), (400, 3, "1")]))
    got = rows(quote_ops.quote_metrics(df))[0]
    assert got["time_weighted_spread_bps"] == 1 and got["mean_spread_bps"] == 4


def test_prevailing_time_is_capped_or_split_at_the_bar_end(spark):
    df = quote_ops.with_durations(quotes(spark, [(30_000, 1, "4"), (150_000, 2, "1")]))
    whole = rows(quote_ops.quote_metrics(df))
    assert len(whole) == 1 and whole[0]["covered_ms"] == 120_000
    assert whole[0]["quote_coverage_ratio"] == 1
    split = rows(quote_ops.quote_metrics(df, split_at_bar_end=True), "bar_start")
    assert [r["covered_ms"] for r in split] == [30_000, 60_000, 30_000]


def test_exact_and_sketched_median_agree_on_small_bars(spark):
    df = quote_ops.with_durations(quotes(spark, [(i, i, str(i)) for i in range(1, 8)]))
    exact = rows(quote_ops.quote_metrics(df, exact_quantiles=True))[0]["median_spread_bps"]
    sketch = rows(quote_ops.quote_metrics(df))[0]["median_spread_bps"]
    assert exact == Decimal("3.5") and sketch == 3


def test_discrete_median_of_a_busy_bar(spark):
    n = 60_000
    spreads = [(i * 7_919 % n) ** 2 for i in range(n)]
    df = spark.createDataFrame(
        list(enumerate(spreads)), "update_id long, s long"
    ).selectExpr(
        "'V' exchange_id", "'S' symbol", "update_id", "timestamp_seconds(0) event_time",
        "cast(1 as bigint) prevailing_ms", "cast(0 as bigint) book_updates_between",
        "cast(s / 1000000 as decimal(18,6)) spread_bps", "cast(1 as decimal(38,18)) mid_price",
        "cast(1 as decimal(38,18)) bid_quantity", "cast(1 as decimal(38,18)) ask_quantity",
        "cast(0 as decimal(18,6)) touch_imbalance")
    got = rows(quote_ops.quote_metrics(df, 3_600, discrete_median=True))
    assert [r["median_spread_bps"] for r in got] == [Decimal((n // 2 - 1) ** 2).scaleb(-6)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no sample tables")
@pytest.mark.parametrize("name", ["quote_metrics_1h", "market_fact"])
def test_registered_medians_are_no_sketch(spark, name):
    df = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert "approx" not in df._jdf.queryExecution().toString()


def arrivals(spark, ids, session="s"):
    return spark.createDataFrame(
        [("A", session, i, u) for i, u in enumerate(ids)],
        "symbol string, session string, kafka_offset long, update_id long",
    )


def test_sequence_regression_never_lowers_the_mark(spark):
    got = rows(observe_sequence(arrivals(spark, [100, 98, 100, 101, 130])), "kafka_offset")
    assert [r["first_seen"] for r in got] == [True, False, False, False, False]
    assert [r["regressed"] for r in got] == [False, True, True, False, False]
    assert [r["span"] for r in got] == [0, 0, 0, 0, 28]


def test_a_new_session_starts_over(spark):
    both = arrivals(spark, [5, 6], "a").unionByName(arrivals(spark, [1, 2], "b"))
    got = observe_sequence(both, session="session")
    assert got.filter("first_seen").count() == 2 and got.filter("regressed").count() == 0


# -- dedup of what repeats -------------------------------------------------------------


def _landed(spark, kinds="t timestamp, n long"):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        key = rng.choice((None, "a", "b")), i % 120
        copies = 40 if i == 7 else rng.choice((1, 1, 1, 2))
        for c in range(copies):
            rows.append((*key, f"row {i}.{c}", rng.choice((None, T0, T0 + timedelta(days=i))),
                         rng.choice((None, -(2**63), -1, 0, i, 2**63 - 1))))
    return spark.createDataFrame(rows, f"k string, id int, text string, {kinds}").repartition(5)


@pytest.mark.parametrize("keep", ["first", "last"])
@pytest.mark.parametrize("order", [("t", "n"), ("n",), ("t",), ("text",), ("n", "t")])
def test_only_repeats_are_brought_together(spark, keep, order):
    df = _landed(spark)
    whole = dedup(df, ("k", "id"), order, keep)
    apart = dedup(df, ("k", "id"), order, keep, stage=stage)
    assert apart.columns == whole.columns
    read = lambda d: {(r.k, r.id): (r._duplicate_count, *(r[c] for c in order))
                      for r in d.collect()}
    assert apart.count() == whole.count()
    assert read(apart) == read(whole)
    texts = {tuple(r) for r in df.select("k", "id", "text", "t", "n").collect()}
    assert {tuple(r)[:5] for r in apart.collect()} <= texts


def test_a_storm_of_copies_on_one_key(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"),
        F.lit("x").alias("text"))
    got = dedup(df, ("k",), ("n",), stage=stage)
    top = got.orderBy(F.desc("_duplicate_count")).first()
    assert (top.k, top.n, top._duplicate_count) == (1, 1, 150_000)
    assert got.count() == 50_001
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan


def test_dedup_of_nothing_and_without_a_count(spark):
    df = _landed(spark)
    assert dedup(df.limit(0), ("k", "id"), ("t", "n"), stage=stage).count() == 0
    assert dedup(df, ("k", "id"), ("t", "n"), count_col=None, stage=stage).columns == df.columns


def test_sparse_bars_are_shuffled_once_and_alike(spark, monkeypatch):
    def refused(df):
        raise AssertionError("nothing is to be stored")
    monkeypatch.setattr(market, "stage", refused)
    sf = "/root/testdata/sf0.001"
    got = market.bars_lineitem_daily(spark, sf)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    tape = market.tables(spark, sf).tape()
    dense = bar_ops.aggregate_bars(tape, 86_400).drop("open_price", "close_price")
    assert sorted(map(str, present(dense).collect())) == sorted(map(str, got.collect()))
