"""The chunked windows against plain windows, on random data with one hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickhouse.operators import ordered


@pytest.fixture(scope="module", params=[1, 2])
def tape(request, spark):
    rng = random.Random(request.param)
    data = []
    for i in range(600):
        key = "hot" if rng.random() < 0.6 else rng.choice("abc")
        t = rng.randrange(0, 400)
        data.append((key, t, i, None if rng.random() < 0.2 else rng.randrange(1000)))
    return spark.createDataFrame(data, "k string, t long, id long, v long").repartition(5)


def chunk():
    return F.floor(F.col("t") / 7)


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("keys", [["k"], []])
def test_neighbours(tape, keys):
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("t", "id")
    plain = tape.withColumns({"nt": F.lead("t").over(w), "nv": F.lead("v").over(w),
                              "pv": F.lag("v").over(w)})
    got = ordered.neighbours(tape, keys, ["t", "id"], chunk(), lead={"nt": "t", "nv": "v"},
                             lag={"pv": "v"})
    same(got, plain)


def test_running_max_before(tape):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    got = ordered.running_max_before(tape, ["k"], ["t", "id"], chunk(), "v", "m")
    same(got, tape.withColumn("m", F.max("v").over(w)))


def test_no_window_is_partitioned_by_the_key_alone_over_rows(tape):
    got = ordered.neighbours(tape, ["k"], ["t", "id"], chunk(), lead={"nt": "t"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("__chunk" in w.split("windowspecdefinition(")[1].split(" ASC")[0] for w in windows) == 2


def test_rows_without_a_key_are_one_key(spark):
    rows = [(k, t, 10 * t) for k in (None, "a") for t in (1, 3, 9, 30)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    w = Window.partitionBy("k").orderBy("t")
    same(ordered.neighbours(df, ["k"], ["t"], chunk(), lead={"n": "v"}, lag={"p": "v"}),
         df.withColumns({"n": F.lead("v").over(w), "p": F.lag("v").over(w)}))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    same(ordered.running_max_before(df, ["k"], ["t"], chunk(), "v", "m"),
         df.withColumn("m", F.max("v").over(before)))


@pytest.mark.parametrize("keys", [["k"], []])
def test_last_before(tape, keys):
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("t", "id").rowsBetween(
        Window.unboundedPreceding, -1)
    got = ordered.last_before(tape, keys, ["t", "id"], chunk(), "v", "m")
    same(got, tape.withColumn("m", F.last("v", ignorenulls=True).over(w)))


def test_the_tape_is_shuffled_once_and_joined_with_nothing(tape):
    got = ordered.neighbours(tape, ["k"], ["t", "id"], chunk(), lead={"nt": "t"}, lag={"pv": "v"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
