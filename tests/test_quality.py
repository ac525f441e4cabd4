import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickhouse.operators import planning, quality, telemetry

T0 = datetime(2024, 1, 1)


def bars(spark, minutes, symbol="S"):
    return spark.createDataFrame([("x", symbol, T0 + timedelta(minutes=m)) for m in minutes],
                                 "exchange_id string, symbol string, bar_start timestamp")


def test_a_gap_of_five_minutes_is_tolerated_and_six_is_not(spark):
    assert quality.bar_gaps(bars(spark, [0, 5])).count() == 0
    got = rows(quality.bar_gaps(bars(spark, [0, 6, 7])))
    assert [(r["gap_after"], r["gap_minutes"]) for r in got] == [(T0, 6)]


def test_checks_share_one_scan_and_respect_severity(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (5, "z"), (-1, None)], "v int, s string")
    checks = [quality.not_null("v"), quality.accepted_values("s", ["a", "b"], severity="warn"),
              quality.in_range("v", 0, 5), quality.in_range("v", 0, 5, strictly=True, error_above=5),
              quality.holds("positive", F.col("v") > -5)]
    got = {r["check_name"] + str(i): (r["failing_rows"], r["status"])
           for i, r in enumerate(rows(quality.run_checks(df, checks, "t")))}
    assert list(got.values()) == [(1, "error"), (1, "warn"), (1, "error"), (2, "warn"), (0, "pass")]
    plan = quality.run_checks(df, checks, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert quality.failing_rows(df, checks[0]).count() == 1


def test_unique_relationship_and_row_count(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(quality.check_unique(df, ["s"], "t"))[0]["failing_rows"] == 1
    rel = rows(quality.check_relationship(df, "s", parent, "k", "t"))[0]
    assert (rel["failing_rows"], rel["total_rows"], rel["status"]) == (1, 4, "error")
    assert rows(quality.orphans(df, "s", parent, "k")) == [{"s": "b"}]
    assert rows(quality.check_row_count(df.limit(0), "t"))[0]["status"] == "warn"


def test_tick_grid_is_exact(spark):
    trades = spark.createDataFrame(
        [("S", 1, Decimal("64250.10"), T0), ("S", 2, Decimal("64250.105"), T0),
         ("U", 3, Decimal("0.5"), T0)],
        "symbol string, trade_id long, price decimal(38,18), event_time timestamp")
    ref = spark.createDataFrame([("S", Decimal("0.01"))], "symbol string, tick_size decimal(38,18)")
    assert [r["trade_id"] for r in rows(quality.off_tick(trades, ref))] == [2]


def test_join_multiplication_counts(spark):
    silver, fact = bars(spark, [0, 1, 2]), bars(spark, [0, 1, 1, 3])
    got = {r["bar_start"].minute: (r["rows_expected"], r["rows_found"], r["surplus"])
           for r in rows(quality.join_multiplication(silver, fact, ("symbol", "bar_start")))}
    assert got == {1: (1, 2, 1), 2: (1, 0, -1), 3: (0, 1, 1)}


@pytest.mark.parametrize(("age", "status"), [(900, "pass"), (901, "warn"), (3601, "error")])
def test_freshness(spark, age, status):
    df = spark.createDataFrame([(T0,)], "t timestamp")
    got = rows(quality.freshness(df, "t", T0 + timedelta(seconds=age), "x"))[0]
    assert (got["age_seconds"], got["status"]) == (age, status)
    assert rows(quality.freshness(df.limit(0), "t", T0, "x"))[0]["status"] == "error"


def test_volume_baseline_judges_the_last_complete_hour(spark):
    data = []
    for d, n in ((0, 10), (1, 30), (2, 20), (3, 200)):
        data += [(T0 + timedelta(days=d, hours=9, seconds=i),) for i in range(n)]
    data.append((T0 + timedelta(days=3, hours=10),))
    df = spark.createDataFrame(data, "event_time timestamp")
    got = rows(quality.volume_baseline(df, T0 + timedelta(days=3, hours=10, minutes=5)))[0]
    assert (got["trades"], got["baseline_median"], got["passed"]) == (200, 20, True)
    short = df.filter(F.col("event_time") >= F.lit(T0 + timedelta(days=3)))
    alone = rows(quality.volume_baseline(short, T0 + timedelta(days=4)))[0]
    assert alone["baseline_median"] is None and alone["passed"]


def test_reconciliation_and_quarantine_checks(spark):
    df = spark.createDataFrame([(T0, "ok", 0.0)] * 97 + [(T0, "unmatched", 0.5)] * 3,
                               "bar_start timestamp, reconciliation_status string, volume_rel_diff double")
    got = rows(quality.reconciliation_pass(df, T0))[0]
    assert got["pass_ratio"] == Decimal("0.97") and not got["passed"]
    assert rows(quality.reconciliation_pass(df, T0 + timedelta(days=9)))[0]["passed"]
    q = spark.createDataFrame([(T0,)], "_ingested_at timestamp")
    assert not rows(quality.quarantine_empty(q, T0))[0]["passed"]
    assert rows(quality.quarantine_empty(q, T0 + timedelta(days=2)))[0]["passed"]


def test_chunks_tile_the_window(spark):
    end = T0 + timedelta(minutes=2_500)
    window = spark.createDataFrame([("S", T0, end)], "symbol string, start timestamp, end timestamp")
    got = rows(planning.request_chunks(window, 60), "start")
    assert [r["expected_bars"] for r in got] == [1000, 1000, 500]
    assert got[0]["start"] == T0 and got[-1]["end"] == end
    assert all(a["end"] == b["start"] for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("seed", range(3))
def test_missing_ranges_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    have = sorted(rng.sample(range(100), 60))
    present = bars(spark, have + [500]).unionByName(bars(spark, [0], "EMPTY"))
    spans = spark.createDataFrame(
        [("S", T0, T0 + timedelta(minutes=100)),
         ("EMPTY", T0 + timedelta(minutes=10), T0 + timedelta(minutes=40))],
        "symbol string, start timestamp, end timestamp")
    got = set()
    for r in rows(planning.missing_ranges(present, spans, 60, max_bars=7)):
        first = int((r["start"] - T0).total_seconds() // 60)
        assert r["expected_bars"] <= 7
        got |= {(r["symbol"], first + i) for i in range(r["expected_bars"])}
    expected = {("S", m) for m in range(100) if m not in have} | {("EMPTY", m) for m in range(10, 40)}
    assert got == expected


def test_completeness_grid(spark):
    windows = planning.day_windows(
        spark.createDataFrame([("S",)], "symbol string"), F.lit("2024-01-01").cast("date"),
        F.lit("2024-01-02").cast("date"))
    got = rows(planning.completeness(bars(spark, range(720)), windows, 60), "trading_date")
    assert [(r["expected_bars"], r["present_bars"], r["coverage_ratio"]) for r in got] == [
        (1440, 720, 0.5), (1440, 0, 0.0)]


def test_lag_measures(spark):
    df = spark.createDataFrame([("S", lag) for lag in (-50, 5, 6, 70_000)], "symbol string, lag long")
    got = {r["le"]: r["observations"] for r in rows(telemetry.lag_histogram(df, "lag", ["symbol"]))}
    assert (got["0.005"], got["0.01"], got["60.0"], got["+Inf"], len(got)) == (2, 3, 3, 4, 14)
    p = rows(telemetry.lag_percentiles(df, "lag", ["symbol"]))[0]
    assert (p["p50_lag_ms"], p["p99_lag_ms"]) == (5, 70_000)


def test_silence_and_unmoved_mark(spark):
    df = spark.createDataFrame([("A", T0), ("B", T0 + timedelta(minutes=9))], "s string, t timestamp")
    as_of = T0 + timedelta(minutes=10)
    got = {r["s"]: r["is_stalled"] for r in rows(telemetry.silence(df, "t", ["s"], as_of))}
    assert got == {"A": True, "B": False}
    marks = spark.createDataFrame([("B", T0 + timedelta(minutes=9))], "s string, high_water timestamp")
    again = {r["s"]: r["is_stalled"] for r in rows(
        telemetry.silence(df, "t", ["s"], as_of, previous=marks))}
    assert again == {"A": True, "B": True}
