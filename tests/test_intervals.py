import random
from datetime import datetime, timedelta
from functools import partial

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickhouse.operators import intervals, scd

D0 = datetime(2024, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def published(spark, data):
    """(start day, end day, rate, lake day)"""
    return spark.createDataFrame(
        [("P", day(a), day(b), r, day(at)) for a, b, r, at in data],
        "pair string, valid_from timestamp, valid_to timestamp, rate int, lake_ingested_at timestamp",
    )


def test_rebounding_removes_overlap_and_keeps_the_latest_copy(spark):
    df = published(spark, [(0, 4, 1, 0), (0, 4, 2, 9), (1, 3, 5, 1), (3, 6, 7, 3)])
    got = rows(intervals.rebound_intervals(df, ["pair"]), "valid_from")
    assert [(r["rate"], r["valid_to"], r["was_rebounded"], r["validity_days"]) for r in got] == [
        (2, day(1), True, 1), (5, day(3), False, 2), (7, day(6), False, 3)]
    out = intervals.rebound_intervals(df, ["pair"])
    assert intervals.overlapping(out, ["pair"], "valid_from", "valid_to").count() == 0


def test_gap_and_overlap_reports(spark):
    df = published(spark, [(0, 1, 1, 0), (3, 6, 2, 0), (5, 7, 3, 0)])
    gap = rows(intervals.gaps(df, ["pair"], "valid_from", "valid_to"))
    assert [(r["gap_starts_at"], r["gap_ends_at"], r["gap_days"]) for r in gap] == [(day(1), day(3), 2)]
    over = rows(intervals.overlapping(df, ["pair"], "valid_from", "valid_to"))
    assert [(r["valid_from"], r["next_valid_from"]) for r in over] == [(day(3), day(5))]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("keyed", [True, False])
def test_both_joins_equal_brute_force(spark, seed, keyed):
    rng = random.Random(seed)
    ivs = []
    for p in ("hot", "b"):
        at = 0.0
        for i in range(12):
            at += rng.choice([0.1, 0.5, 2, 5])
            end = at + rng.choice([0.05, 1, 3])
            ivs.append([p, at, end, i])
            at = end if rng.random() < 0.5 else end + 0.3
        if not keyed:
            break
    pts = [("hot" if rng.random() < 0.7 else rng.choice("bz"), rng.uniform(-1, 40), i)
           for i in range(150)]
    stamp = lambda x: D0 + timedelta(days=x)
    left = spark.createDataFrame([(p, stamp(t), i) for p, t, i in pts], "p string, t timestamp, i int")
    right = spark.createDataFrame([(p, stamp(a), stamp(b), r) for p, a, b, r in ivs],
                                  "p string, f timestamp, e timestamp, r int")
    if not keyed:
        right = right.drop("p")
    expected = sorted(
        (i, next((r for q, a, b, r in ivs if (q == p or not keyed) and stamp(a) <= stamp(t) < stamp(b)),
                 None)) for p, t, i in pts)
    on = ("p",) if keyed else ()
    for join in (intervals.interval_join, intervals.asof_join,
                 partial(intervals.asof_join, sparse=True)):
        got = join(left, right, "t", "f", "e", on=on)
        key = lambda x: (x[0], str(x[1]))
        assert sorted(((r["i"], r["r"]) for r in got.collect()), key=key) == sorted(expected, key=key)
        inner = join(left, right, "t", "f", "e", on=on, how="inner")
        assert inner.count() == sum(r is not None for _, r in expected)


def test_bucketed_join_is_an_equi_join(spark):
    left = spark.createDataFrame([(day(1),)], "t timestamp")
    plan = intervals.interval_join(left, published(spark, [(0, 2, 1, 0)]), "t", "valid_from",
                                   "valid_to")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_asof_join_takes_an_open_end(spark):
    left = spark.createDataFrame([(day(500),), (day(-1),)], "t timestamp")
    right = spark.createDataFrame([(day(0), None, 1)], "f timestamp, e timestamp, r int")
    for sparse in (False, True):
        got = rows(intervals.asof_join(left, right, "t", "f", "e", sparse=sparse), "t")
        assert [r["r"] for r in got] == [None, 1]


def observations(spark, data):
    """(symbol, day, tick)"""
    return spark.createDataFrame(
        [(s, day(d), "TRADING", t, 1, 5) for s, d, t in data],
        "symbol string, observed_at timestamp, status string, tick_size int, step_size int,"
        " min_notional int",
    )


def versions(df):
    return [(r["symbol"], r["tick_size"], r["valid_from"], r["valid_to"]) for r in
            rows(df, "symbol", "valid_from")]


def test_history_closes_on_change_deletion_and_reappearance(spark):
    df = observations(spark, [
        ("A", 0, 1), ("A", 1, 1), ("A", 2, 2), ("A", 3, 2), ("A", 40, 2),
        ("B", 0, 1), ("B", 2, 1), ("B", 3, 1)])
    assert versions(scd.scd2(df)) == [
        ("A", 1, day(0), day(2)), ("A", 2, day(2), None),
        ("B", 1, day(0), day(1)), ("B", 1, day(2), day(40))]
    assert versions(scd.scd2(df, close_deletes=False)) == [
        ("A", 1, day(0), day(2)), ("A", 2, day(2), None), ("B", 1, day(0), None)]


@pytest.mark.parametrize("seed", range(3))
def test_history_equals_a_replay_of_the_batches(spark, seed):
    rng = random.Random(seed)
    data = [(s, d, rng.randrange(2)) for d in range(0, 60, 4) for s in "ABC" if rng.random() < 0.7]
    open_, closed = {}, []
    for d in sorted({d for _, d, _ in data}):
        seen = {s: t for s, dd, t in data if dd == d}
        for s in list(open_):
            if seen.get(s) != open_[s][0]:
                closed.append((s, open_[s][0], day(open_[s][1]), day(d)))
                del open_[s]
        for s, t in seen.items():
            open_.setdefault(s, (t, d))
    expected = sorted(closed + [(s, t, day(d), None) for s, (t, d) in open_.items()],
                      key=lambda v: (v[0], v[2]))
    assert versions(scd.scd2(observations(spark, data), chunk_seconds=9 * 86_400)) == expected


def test_stage_changes_nothing(spark):
    df = observations(spark, [("A", 0, 1), ("A", 1, 2)])
    calls = []

    def keep(frame):
        calls.append(1)
        return frame.select("*")

    assert versions(scd.scd2(df, stage=keep)) == versions(scd.scd2(df)) and calls


@pytest.mark.parametrize("how", ["left", "inner"])
def test_null_keys_and_times_match_nothing_in_either_join(spark, how):
    left = spark.createDataFrame(
        [(None, day(0.1), 1), (None, day(1.5), 2), ("a", day(1.5), 3), ("a", None, 4),
         ("a", day(-1), 5)], "k string, t timestamp, i int")
    right = spark.createDataFrame(
        [(None, day(0), None, 1), ("a", day(0), None, 2), ("a", None, None, 3)],
        "k string, f timestamp, e timestamp, r int")
    want = [(3, 2)] if how == "inner" else [(1, None), (2, None), (3, 2), (4, None), (5, None)]
    for joined in (intervals.asof_join(left, right, "t", "f", "e", on=("k",), how=how),
                   intervals.asof_join(left, right, "t", "f", "e", on=("k",), how=how, sparse=True),
                   intervals.interval_join(left, right, "t", "f", "e", on=("k",), how=how)):
        assert [(r.i, r.r) for r in joined.orderBy("i").collect()] == want


def test_no_row_is_made_for_an_empty_chunk(spark):
    """Thousands of keys observed once and traded years later."""
    n = 300
    began = spark.createDataFrame(
        [(f"k{i}", day(i % 7), (i,)) for i in range(n)], "k string, __t timestamp, __r struct<r:int>")
    placed = spark.createDataFrame(
        [(f"k{i}", day(3_000 + j)) for i in range(0, n, 3) for j in range(2)],
        "k string, __t timestamp")
    chunk = F.floor(F.unix_micros("__t") / (86_400 * 1_000_000))
    found = intervals.entering(placed, began, ["k"], chunk)
    assert found.count() == placed.count()
    line = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in line
    got = intervals.asof_join(placed.withColumnRenamed("__t", "t"), began.select(
        "k", F.col("__t").alias("f"), F.col("__r.r").alias("r")), "t", "f", None, on=("k",))
    assert {(r.k, r.r) for r in got.collect()} == {(f"k{i}", i) for i in range(0, n, 3)}


def test_one_symbol_with_most_rows_is_spread_over_its_chunks(spark):
    rows = [("hot", day(i / 50), i) for i in range(900)] + [(f"s{i}", day(i), i) for i in range(18)]
    left = spark.createDataFrame(rows, "k string, t timestamp, i int")
    right = spark.createDataFrame(
        [("hot", day(x), x) for x in (0, 1, 2, 3, 11)] + [("s3", day(1), 1)],
        "k string, f timestamp, r int")
    for sparse in (False, True):
        joined = intervals.asof_join(left, right, "t", "f", None, on=("k",), sparse=sparse)
        got = {r.i: r.r for r in joined.filter("k = 'hot'").collect()}
        assert got == {i: max(x for x in (0, 1, 2, 3, 11) if x <= i / 50) for i in range(900)}
    plan = intervals.asof_join(left, right, "t", "f", None, on=("k",))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    last = [line for line in plan.splitlines() if "Window [" in line][0]
    assert "__chunk" in last.split("windowspecdefinition(")[1]


def test_the_sparse_form_joins_on_key_and_chunk(spark):
    """Chunks of many, one and no interval, bounds that meet, chunks without left rows."""
    left = spark.createDataFrame(
        [(k, day(x / 4), i) for i, (k, x) in enumerate((k, x) for k in "ab" for x in range(-8, 200))],
        "k string, t timestamp, i int")
    data = [("a", 0, 1, 1), ("a", 1, 1.25, 2), ("a", 1.5, 9, 3), ("a", 30, None, 4), ("b", 2, 45, 5),
            ("c", 0, None, 6)]
    right = spark.createDataFrame(
        [(k, day(f), None if e is None else day(e), r) for k, f, e, r in data],
        "k string, f timestamp, e timestamp, r int")
    for seconds in (3_600, 86_400, 20 * 86_400):
        joined = intervals.asof_join(left, right, "t", "f", "e", on=("k",), chunk_seconds=seconds,
                                     sparse=True)
        assert joined.columns == ["k", "t", "i", "f", "e", "r"]
        got = {r.i: r.r for r in joined.collect()}
        assert len(got) == 416 and got == {
            r.i: r.r for r in intervals.asof_join(left, right, "t", "f", "e", on=("k",)).collect()}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_an_unexpected_open_end_is_an_error(spark):
    left = spark.createDataFrame([("a", day(1))], "k string, t timestamp")
    right = spark.createDataFrame([("a", day(0), None)], "k string, f timestamp, e timestamp")
    with pytest.raises(Exception, match="open_ends"):
        intervals.interval_join(left, right, "t", "f", "e", on=("k",), open_ends=False).collect()


def test_joins_run_nothing_while_they_are_planned(spark):
    left = spark.createDataFrame([("a", day(1))], "k string, t timestamp")
    right = spark.createDataFrame([("a", day(0), None)], "k string, f timestamp, e timestamp")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        intervals.asof_join(left, right, "t", "f", "e", on=("k",))
        intervals.interval_join(left, right, "t", "f", "e", on=("k",))
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_open_intervals_without_keys(spark):
    left = spark.createDataFrame([(day(x / 2), x) for x in range(-2, 9)], "t timestamp, i int")
    right = spark.createDataFrame([(day(0), day(2), 1), (day(2), None, 2), (day(50), None, 3)],
                                  "f timestamp, e timestamp, r int")
    got = {r.i: r.r for r in intervals.interval_join(left, right, "t", "f", "e").collect()}
    assert got == {x: None if x < 0 else 1 if x < 4 else 2 for x in range(-2, 9)}
