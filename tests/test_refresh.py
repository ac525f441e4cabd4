"""Changed bars, late rows, distributions and bucketed tables against whole rebuilds."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickhouse.operators import distribution
from tickhouse.operators import quotes as quote_ops
from tickhouse.operators.bars import aggregate_bars, with_log_returns
from tickhouse.plans import gold, refresh
from tickhouse.sources import bucketed
from tickhouse.sources.staged import stage
from tickhouse.streaming import landing, late

D0 = datetime(2024, 1, 1)
BAR = ["exchange_id", "symbol", "bar_start"]


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left, right = (Counter(map(str, d.select(*columns).collect())) for d in (a, b))
    assert left == right


# -- changed bars ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def trades(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        at = D0 + timedelta(minutes=rng.randrange(0, 3 * 1_440) // 37 * 37)
        price, size = Decimal(rng.randrange(100, 900)) / 100, Decimal(rng.randrange(1, 9))
        # A tenth arrives ten days after it happened.
        lake = at + timedelta(days=10 if i % 10 == 0 else 0, seconds=5)
        rows.append(("x", rng.choice("ab"), i, price, size, price * size, i % 2 == 0, at, 5, 1, lake))
    return spark.createDataFrame(
        rows, "exchange_id string, symbol string, trade_id long, price decimal(38,18), "
        "quantity decimal(38,18), notional decimal(38,18), is_buyer_aggressor boolean, "
        "event_time timestamp, ingestion_lag_ms long, _duplicate_count long, "
        "lake_ingested_at timestamp")


def test_bars_by_changed_sets_equal_the_rebuild(trades):
    cut = D0 + timedelta(days=2)
    before = aggregate_bars(trades.filter(F.col("lake_ingested_at") <= F.lit(cut)), 3_600)
    dirty = refresh.dirty_bars(trades, cut, 3_600)
    fresh = aggregate_bars(refresh.rows_of(trades, dirty, 3_600), 3_600)
    whole = aggregate_bars(trades, 3_600)
    same(refresh.replaced(before, fresh, dirty, BAR), whole)
    # Something old changed, and most of what is old did not.
    old = dirty.filter(F.col("bar_start") < F.lit(D0 + timedelta(days=1))).count()
    assert 0 < old < before.count() / 2


def test_returns_change_in_the_bar_behind_too(trades):
    cut = D0 + timedelta(days=2)
    before = with_log_returns(aggregate_bars(
        trades.filter(F.col("lake_ingested_at") <= F.lit(cut)), 3_600))
    whole = with_log_returns(aggregate_bars(trades, 3_600))
    touched = refresh.following(whole, refresh.dirty_bars(trades, cut, 3_600))
    fresh = whole.join(touched, BAR, "left_semi")
    same(refresh.replaced(before, fresh, touched, BAR), whole)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quote_metrics_by_changed_sets_equal_the_rebuild(spark, seed):
    rng = random.Random(seed)
    rows, ids = [], rng.sample(range(10_000), 300)
    for i in ids:
        at = D0 + timedelta(minutes=rng.randrange(0, 2 * 1_440), milliseconds=rng.randrange(9))
        bid = Decimal(rng.randrange(100, 900)) / 100
        rows.append(("x", rng.choice("aab"), i, at, bid + Decimal("0.005"), Decimal("1.5"), Decimal(1),
                     Decimal(2), Decimal("0.1"), at + timedelta(days=10 if i % 9 == 0 else 0)))
    quotes = spark.createDataFrame(
        rows, "exchange_id string, symbol string, update_id long, event_time timestamp, "
        "mid_price decimal(38,18), spread_bps decimal(18,6), bid_quantity decimal(38,18), "
        "ask_quantity decimal(38,18), touch_imbalance decimal(18,6), lake_ingested_at timestamp")
    cut = D0 + timedelta(days=3)

    def metrics(q):
        return quote_ops.quote_metrics(q, 3_600, discrete_median=True)

    before = metrics(quote_ops.with_durations(
        quotes.filter(F.col("lake_ingested_at") <= F.lit(cut)), id_chunk=500))
    changed, again = refresh.changed_quote_bars(quotes, cut, 3_600, stage, chunk_ids=500)
    whole = metrics(quote_ops.with_durations(quotes, id_chunk=500))
    same(refresh.replaced(before, metrics(again), changed, BAR), whole)
    assert changed.count() < whole.count()


def test_nothing_new_changes_nothing(trades):
    cut = D0 + timedelta(days=99)
    dirty = refresh.dirty_bars(trades, cut, 3_600)
    assert dirty.count() == 0 and refresh.rows_of(trades, dirty, 3_600).count() == 0


# -- late rows -------------------------------------------------------------------------


def test_late_rows_are_kept_over_repeats_and_restarts(spark, tmp_path):
    split = late.Split(*(str(tmp_path / n) for n in ("ok", "late", "marks")), "t", 3_600)
    hours = [[0, 5, 3], [4, 9, None, 1], [], [8, 7, 20], [20, 18, 19]]
    rows = [spark.createDataFrame(
        [(h, None if h is None else D0 + timedelta(hours=h)) for h in batch], "h int, t timestamp")
        for batch in hours]
    for n in (0, 1, 1, 2, 3, 3, 4):
        late.split_batch(rows[n], n, split)

    def read(path):
        found = spark.read.schema("h int, t timestamp, batch_id long").parquet(path)
        return sorted((r.batch_id, -1 if r.h is None else r.h) for r in found.collect())

    # Marks before the batches: none, 5, 9, 9, 20.
    assert read(split.on_time) == [(0, 0), (0, 3), (0, 5), (1, 4), (1, 9), (3, 8), (3, 20), (4, 19),
                                   (4, 20)]
    assert read(split.late) == [(1, -1), (1, 1), (3, 7), (4, 18)]


def test_late_rows_of_a_stream(spark, tmp_path):
    split = late.Split(*(str(tmp_path / n) for n in ("ok", "late", "marks")), "t", 60)
    for n, minutes in enumerate(([1, 2, 9], [3, 8, 9, 10])):
        spark.createDataFrame([(D0 + timedelta(minutes=m),) for m in minutes], "t timestamp").coalesce(
            1).write.mode("append").parquet(str(tmp_path / "in"))
        query = late.start_split(
            spark.readStream.schema("t timestamp").parquet(str(tmp_path / "in")), split,
            str(tmp_path / "check"), trigger_seconds=None)
        assert landing.finish(query) == len(minutes)
    assert spark.read.parquet(split.late).count() == 1
    assert spark.read.parquet(split.on_time).count() == 6


# -- distributions ---------------------------------------------------------------------


@pytest.mark.parametrize("span", [1, 7, 1_024])
def test_quantiles_of_merged_counts(spark, span):
    rng = random.Random(5)
    rows = [("ab"[rng.random() < 0.8], D0 + timedelta(hours=rng.randrange(72)),
             rng.choice((None, -3, 0, rng.randrange(60), rng.randrange(5_000)))) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    parts = [distribution.counts(df.filter(F.hash("t", "v") % 2 == 0), ["k"], "t", "v"),
             distribution.counts(df.filter(F.hash("t", "v") % 2 != 0), ["k"], "t", "v")]
    days = distribution.merge(parts[0].unionByName(parts[1]), ["k"], F.date_trunc("day", "bar_start"))
    shares = {"lo": 0.0, "mid": 0.5, "p99": 0.99, "top": 1.0}
    got = {(r.k, r.bar_start): (r.observations, r.max_value, r.lo, r.mid, r.p99, r.top)
           for r in distribution.quantiles(days, ["k"], shares, span).collect()}
    want = {}
    for k in "ab":
        for d in range(3):
            start = D0 + timedelta(days=d)
            vs = sorted(v for kk, t, v in rows
                        if kk == k and v is not None and start <= t < start + timedelta(days=1))
            if vs:
                pick = [vs[max(-(-int(q * 1_000 * len(vs)) // 1_000), 1) - 1]
                        for q in shares.values()]
                want[k, start] = (len(vs), vs[-1], *pick)
    assert got == want


# -- buckets ---------------------------------------------------------------------------


def test_bucketed_tables_join_without_a_shuffle(spark, trades):
    bars = with_log_returns(aggregate_bars(trades, 3_600))
    venue = aggregate_bars(trades.filter("trade_id % 7 <> 0"), 3_600)
    names = [bucketed.write(df, "test", BAR, 4) for df in (bars, venue)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = gold.reconcile(*[bucketed.read(spark, n) for n in names])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" in plan
        same(joined, gold.reconcile(bars, venue))
        metrics = [bucketed.read(spark, names[0]).select(*BAR),
                   bucketed.read(spark, names[1]).select(*BAR, "vwap")]
        plan = metrics[0].join(metrics[1], BAR, "left")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in names:
            spark.sql(f"DROP TABLE {n}")
