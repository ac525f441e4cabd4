"""Tables that grow by batches: tiers, bar states, histories, presence; repeats and crashes."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickhouse.operators import bar_states, presence, scd
from tickhouse.operators.bars import aggregate_bars
from tickhouse.sources import history, tiers, writers
from tickhouse.sources.staged import stage
from tickhouse.streaming import landing, stateful
from tickhouse.streaming.feeds import FEEDS

D0 = datetime(2024, 1, 1)
KEYS = ("exchange_id", "symbol", "trade_id")


def tape(spark, n=300, seed=1, columns=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        price, size = Decimal(rng.randrange(1, 900)) / 100, Decimal(rng.randrange(1, 50))
        rows.append(("x", "hot" if rng.random() < 0.7 else rng.choice("ab"), i, price, size,
                     price * size, rng.random() < 0.5,
                     D0 + timedelta(seconds=rng.randrange(0, 4 * 86_400) // 900 * 900),
                     D0 + timedelta(days=9, seconds=i), rng.choice((None, rng.randrange(900))),
                     rng.choice((1, 1, 2))))
    return spark.createDataFrame(
        rows, "exchange_id string, symbol string, trade_id long, price decimal(38,18), "
        "quantity decimal(38,18), notional decimal(38,18), is_buyer_aggressor boolean, "
        "event_time timestamp, lake_ingested_at timestamp, ingestion_lag_ms long, "
        "_duplicate_count long")


def same(a, b, *columns):
    columns = columns or sorted(a.columns)
    assert sorted(a.columns) == sorted(b.columns) or columns
    left, right = (Counter(map(str, d.select(*columns).collect())) for d in (a, b))
    assert left == right


# -- bar states ------------------------------------------------------------------------


def test_states_of_parts_merge_into_candles_of_all(spark):
    trades = tape(spark)
    parts = [trades.filter(F.col("trade_id") % 3 == k) for k in range(3)]
    states = bar_states.fold(parts[2], 3_600)
    for part in parts[:2]:
        states = bar_states.merge(states.unionByName(bar_states.fold(part, 3_600)))
    same(bar_states.finish(states, 3_600), aggregate_bars(trades, 3_600))


def test_minute_states_merge_into_longer_bars(spark):
    trades = tape(spark)
    longer = bar_states.merge(bar_states.fold(trades, 60), seconds=86_400)
    same(bar_states.finish(longer, 86_400), aggregate_bars(trades, 86_400))


def test_states_need_no_sort(spark):
    plan = bar_states.merge(bar_states.fold(tape(spark)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "Sort [" not in text


def test_states_of_columns_that_are_there(spark):
    few = tape(spark).drop("ingestion_lag_ms", "_duplicate_count", "lake_ingested_at")
    bars = bar_states.finish(bar_states.fold(few, 3_600), 3_600)
    assert "mean_ingestion_lag_ms" not in bars.columns and "vwap" in bars.columns
    assert bar_states.finish(bar_states.fold(few.limit(0))).count() == 0


def bar_tables(root, trades):
    return (
        tiers.Tiers(f"{root}/s", f"{root}/ss", writers.Layout("bar_start", sort=("symbol",)),
                    bar_states.fold(trades.limit(0), 3_600).schema, bar_states.merge),
        tiers.Tiers(f"{root}/k", f"{root}/kk", writers.Layout("event_time"),
                    trades.select(*KEYS, "event_time").schema),
    )


def test_late_and_repeated_trades_and_batches(spark, tmp_path):
    trades = tape(spark)
    states, seen = bar_tables(tmp_path, trades)

    def batch(n):
        # A third of each batch are copies of trades of the batch before it.
        return trades.filter((F.col("trade_id") % 4 == n)
                             | (F.col("trade_id") % 4 == n - 1) & (F.col("trade_id") % 3 == 0))

    def add(n):
        rows = batch(n)
        stateful.add_bar_states(rows.unionByName(rows.limit(20)), n, states, seen, KEYS,
                                ("event_time",), 3_600)

    for n in (0, 1, 1):
        add(n)
    stateful.fold_bar_states(spark, states, seen, 0)
    add(1)
    stateful.fold_bar_states(spark, states, seen, 1)
    add(1)  # after its fold: of no effect
    for n in (2, 3, 3):
        add(n)
    found = bar_states.finish(tiers.read(spark, states).drop("dt"), 3_600)
    same(found, aggregate_bars(trades, 3_600))


# -- tiers -----------------------------------------------------------------------------


def numbers(spark, *values):
    return spark.createDataFrame(
        [(v, "s" if v % 2 else None, None if v == 7 else D0 + timedelta(days=v % 3)) for v in values],
        "v int, symbol string, t timestamp")


def table_of(tmp_path, schema, buckets=0):
    return tiers.Tiers(str(tmp_path / "open"), str(tmp_path / "settled"),
                       writers.Layout("t", buckets=buckets, sort=("v",)), schema)


def values(spark, table):
    return sorted(r.v for r in tiers.read(spark, table).collect())


@pytest.mark.parametrize("buckets", [0, 3])
def test_tiers_show_each_row_once_at_any_moment(spark, tmp_path, buckets):
    table = table_of(tmp_path, numbers(spark, 1).schema, buckets)
    assert values(spark, table) == []
    assert tiers.fold(spark, table, 5) == 0
    tiers.add(numbers(spark, 1, 2, 7), table, 0)
    tiers.add(numbers(spark, 3, 4), table, 1)
    tiers.add(numbers(spark, 3, 5), table, 1)
    tiers.add(numbers(spark, 6), table, 2)
    want = [1, 2, 3, 5, 6, 7]
    assert values(spark, table) == want
    assert tiers.fold(spark, table, 1) > 0
    assert values(spark, table) == want
    assert tiers.fold(spark, table, 1) == 0
    tiers.add(numbers(spark, 3, 5), table, 1)  # repeated after its fold
    assert values(spark, table) == want
    tiers.fold(spark, table, 2)
    tiers.add(numbers(spark, 8, 9), table, 3)
    assert values(spark, table) == [*want, 8, 9]
    assert [r.v for r in tiers.read(spark, table, days=[date(2024, 1, 1)]).orderBy("v").collect()] == [
        3, 6, 9]


def test_a_fold_that_stopped_before_clearing_up(spark, tmp_path, monkeypatch):
    table = table_of(tmp_path, numbers(spark, 1).schema)
    tiers.add(numbers(spark, 1, 2), table, 0)
    tiers.add(numbers(spark, 2, 3), table, 1)
    with monkeypatch.context() as m:
        m.setattr(tiers, "subfolders", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tiers.fold(spark, table, 0)
    assert values(spark, table) == [1, 2, 2, 3]
    tiers.fold(spark, table, 1)
    assert values(spark, table) == [1, 2, 2, 3]
    assert writers.subfolders(spark, table.open_path) == []


def test_compaction_refuses_a_table_of_batches(spark, tmp_path):
    table = table_of(tmp_path, numbers(spark, 1).schema)
    for n in range(3):
        tiers.add(numbers(spark, n, n + 1), table, n)
    before = values(spark, table)
    with pytest.raises(ValueError, match="batch_id"):
        writers.compact(spark, table.open_path, table.layout)
    result, = writers.compact_all(spark, [(table.open_path, table.layout)])
    assert "batch_id" in result.error
    assert values(spark, table) == before
    deeper = writers.Layout("t", buckets=2)
    writers.append(numbers(spark, 1, 2), str(tmp_path / "deep"), deeper)
    with pytest.raises(ValueError, match="sym_bucket"):
        writers.compact(spark, str(tmp_path / "deep"), table.layout)
    writers.compact(spark, str(tmp_path / "deep"), deeper)


def test_layouts_of_the_feeds(spark):
    kline = FEEDS["kline"].layout
    assert kline.partition_cols == ["dt", "interval"] and kline.derived_cols == ["dt"]
    assert FEEDS["trade"].layout.partition_cols == ["dt", "sym_bucket"]
    assert FEEDS["quote"].max_offsets == 2_000_000


def test_a_count_that_is_not_reported_is_an_error(spark, tmp_path, monkeypatch):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    query = landing.start_append(
        spark.readStream.schema("id long").parquet(str(tmp_path / "in")), str(tmp_path / "out"),
        str(tmp_path / "check"), trigger_seconds=None)
    assert landing.finish(query) == 3
    progress = landing._progress(spark)
    progress.ended.pop(str(query.runId))
    monkeypatch.setattr(landing, "LISTENER_SECONDS", 0.01)
    with pytest.raises(TimeoutError):
        landing.finish(query)


# -- histories -------------------------------------------------------------------------

OBSERVED = ("symbol string, status string, tick_size double, step_size double, "
            "min_notional double, observed_at timestamp, n int")


def observations(spark, seed, polls):
    rng = random.Random(seed)
    rows = []
    for day in range(15):
        for k, s in enumerate("abcdef"):
            if rng.random() < 0.7:
                for n in range(rng.choice((1, 1, 2))):
                    at = D0 + timedelta(days=day, minutes=0 if polls else k)
                    rows.append((s, rng.choice("TTH"), rng.choice((0.1, 0.2, None)), 1.0, 5.0, at, n))
    return spark.createDataFrame(rows, OBSERVED)


@pytest.mark.parametrize("polls", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_history_by_batches_equals_the_rebuild(spark, tmp_path, polls, seed):
    rows = observations(spark, seed, polls)
    whole = scd.scd2(rows, tie_break=("n",), close_deletes=polls)
    for k, (low, high) in enumerate(((0, 4), (4, 5), (5, 11), (5, 11), (11, 15))):
        at = k - (k > 2)
        part = rows.filter(F.col("observed_at").between(
            D0 + timedelta(days=low), D0 + timedelta(days=high, seconds=-1)))
        history.add(part, at, str(tmp_path), stage, tie_break=("n",), close_deletes=polls)
    same(history.read(spark, str(tmp_path), 3, whole.schema), whole, *whole.columns)


def test_history_refuses_older_observations_and_missing_batches(spark, tmp_path):
    rows = observations(spark, 1, True)
    first, second = (rows.filter(F.col("observed_at") < D0 + timedelta(days=3)),
                     rows.filter(F.col("observed_at") >= D0 + timedelta(days=3)))
    with pytest.raises(ValueError, match="has not been added"):
        history.add(first, 1, str(tmp_path), stage, tie_break=("n",))
    history.add(second, 0, str(tmp_path), stage, tie_break=("n",))
    with pytest.raises(ValueError, match="rebuild"):
        history.add(first, 1, str(tmp_path), stage, tie_break=("n",))


# -- presence --------------------------------------------------------------------------


def test_presence_against_sets_of_minutes(spark):
    rng = random.Random(3)
    rows = [("k", D0 + timedelta(days=d, minutes=m, seconds=rng.randrange(60)))
            for d in (0, 1, 4) for m in rng.sample(range(1_440), 700)]
    rows += [("full", D0 + timedelta(minutes=m)) for m in range(1_440)]
    rows += [("edge", D0), ("edge", D0 + timedelta(minutes=1_439)), ("edge", None), (None, D0)]
    df = spark.createDataFrame(rows, "k string, t timestamp").repartition(4)
    bits = presence.minute_presence(df, ["k"], "t")
    assert {len(r.minutes) for r in bits.collect()} == {180}
    halves = [presence.minute_presence(df.filter(F.pmod(F.hash("t"), F.lit(2)) == h), ["k"], "t")
              for h in (0, 1)]
    same(presence.merge(halves[0].unionByName(halves[1]), ["k"]), bits)
    have = {(k, t.replace(second=0)) for k, t in rows if t}
    found = presence.coverage(bits, ["k"]).collect()
    for r in found:
        start = datetime.combine(r.day, datetime.min.time())
        line = "".join("01"[(r.k, start + timedelta(minutes=m)) in have] for m in range(1_440))
        runs = [x for x in line.split("1") if x]
        assert (r.minutes_present, r.gaps, r.longest_gap) == (
            line.count("1"), len(runs), max(map(len, runs), default=0))
        assert r.days_missing == (2 if (r.k, r.day) == ("k", date(2024, 1, 2)) else 0)
    plan = presence.backfill_plan(bits, ["k"], 100).collect()
    asked = Counter((r.k, r.starts_at + timedelta(minutes=m)) for r in plan for m in range(r.minutes))
    assert max(asked.values()) == 1 and all(0 < r.minutes <= 100 for r in plan)
    want = {(k, D0 + timedelta(minutes=m)) for k, days in (("k", 5), ("edge", 1), ("full", 1), (None, 1))
            for m in range(days * 1_440)} - have
    assert set(asked) == want


def test_a_newer_batch_is_stored_no_more_than_its_steps_need(spark, tmp_path):
    staged = []

    def counted(df):
        staged.append(df)
        return stage(df)
    made = spark.createDataFrame(
        [("A", "on", datetime(2024, 1, d), d) for d in (1, 2)],
        "symbol string, status string, observed_at timestamp, n long").selectExpr(
        "*", "1D as tick_size", "1D as step_size", "1D as min_notional")
    for n in range(2):
        history.add(made.filter(f"n = {n + 1}"), n, str(tmp_path), counted, tie_break=("n",),
                    close_deletes=False)
    # The latest observations, the starts of versions, the versions.
    assert len(staged) == 6
