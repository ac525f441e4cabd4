"""Stored tables: upsert, incremental windows, layout, compaction, seed."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickhouse import schemas
from tickhouse.session import scratch_dir
from tickhouse.sources import readers, writers
from tickhouse.sources.staged import stage

T0 = datetime(2024, 1, 1)
LAYOUT = writers.Layout("t", buckets=2, bucket_col="k", sort=("k", "t"))


def frame(spark, data, extra=None):
    df = spark.createDataFrame([(k, T0 + timedelta(hours=h), v) for k, h, v in data],
                               "k string, t timestamp, v int")
    return df if extra is None else df.withColumn(extra, F.lit(1))


def state(spark, path):
    return {r["k"]: (int((r["t"] - T0).total_seconds() // 3600), r["v"])
            for r in rows(readers.table(spark, path))}


@pytest.mark.parametrize("seed", range(3))
def test_upserts_in_batches_equal_the_last_write_per_key(spark, seed):
    """Random batches with replays, corrections and keys that move between days."""
    rng = random.Random(seed)
    path, expected = scratch_dir(spark, "t"), {}
    for _ in range(4):
        batch = {f"k{rng.randrange(25)}": (rng.randrange(24 * 6), rng.randrange(99))
                 for _ in range(15)}
        expected |= batch
        new = stage(frame(spark, [(k, h, v) for k, (h, v) in batch.items()]))
        writers.upsert(new, path, ["k"], LAYOUT)
        assert readers.table(spark, path).count() == len(expected)
    assert state(spark, path) == expected


def test_a_partition_that_only_gives_rows_away_disappears(spark):
    path = scratch_dir(spark, "t")
    writers.upsert(stage(frame(spark, [("a", 1, 1), ("b", 30, 1)])), path, ["k"], LAYOUT)
    writers.upsert(stage(frame(spark, [("a", 31, 2)])), path, ["k"], LAYOUT)
    assert state(spark, path) == {"a": (31, 2), "b": (30, 1)}


def test_untouched_partitions_keep_their_files(spark):
    path = scratch_dir(spark, "t")
    writers.upsert(stage(frame(spark, [("a", 1, 1), ("b", 60, 1)])), path, ["k"], LAYOUT)
    name = "regexp_extract(input_file_name(), '[^/]+$', 0)"
    files = lambda: {r["k"]: r["f"] for r in rows(
        spark.read.parquet(path).select("k", F.expr(name).alias("f")))}
    before = files()
    writers.upsert(stage(frame(spark, [("b", 61, 2)])), path, ["k"], LAYOUT, timedelta(days=9))
    after = files()
    assert after["a"] == before["a"] and after["b"] != before["b"]


def test_new_columns_are_appended(spark):
    path = scratch_dir(spark, "t")
    writers.upsert(stage(frame(spark, [("a", 1, 1), ("b", 2, 1)])), path, ["k"], LAYOUT)
    writers.upsert(stage(frame(spark, [("b", 2, 2)], "flag")), path, ["k"], LAYOUT)
    got = {r["k"]: (r["v"], r["flag"]) for r in rows(readers.table(spark, path))}
    assert got == {"a": (1, None), "b": (2, 1)}


def test_a_declared_schema_needs_no_footer_merge(spark):
    path = scratch_dir(spark, "t")
    declared = frame(spark, [("a", 1, 1)], "flag").schema
    writers.upsert(stage(frame(spark, [("a", 1, 1), ("b", 2, 1)])), path, ["k"], LAYOUT)
    writers.upsert(stage(frame(spark, [("b", 2, 2)], "flag")), path, ["k"], LAYOUT, schema=declared)
    writers.upsert(stage(frame(spark, [("a", 3, 5)])), path, ["k"], LAYOUT, schema=declared)
    got = {r["k"]: (r["v"], r["flag"]) for r in rows(readers.table(spark, path))}
    assert got == {"a": (5, None), "b": (2, 1)}


def test_incremental_window(spark):
    df = frame(spark, [("a", 0, 1), ("b", 30, 1), ("c", 50, 1)])
    assert writers.incremental(df, "t", None, timedelta(hours=1)).count() == 3
    mark = writers.high_water_mark(df, "t")
    assert {r["k"] for r in rows(writers.incremental(df, "t", mark, timedelta(hours=20)))} == {"b", "c"}


def test_incremental_bound_reaches_the_scan(spark):
    path = scratch_dir(spark, "t")
    writers.append(frame(spark, [("a", 0, 1), ("b", 60, 1)]), path, LAYOUT)
    scan = writers.incremental(readers.table(spark, path), "t", T0 + timedelta(hours=60),
                               timedelta(hours=1))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan.replace(" ", "")


def test_overwrite_replaces_everything(spark):
    path = scratch_dir(spark, "t")
    writers.overwrite(frame(spark, [("a", 0, 1), ("b", 60, 1)]), path, LAYOUT)
    writers.overwrite(frame(spark, [("c", 0, 1)]), path, LAYOUT)
    assert state(spark, path) == {"c": (0, 1)}


def test_compaction_keeps_the_rows_and_isolates_failures(spark):
    path = scratch_dir(spark, "t")
    data = [(f"k{i}", i, i) for i in range(40)]
    for part in (data[:20], data[20:], data[:20]):
        writers.append(frame(spark, part), path, writers.Layout("t", sort=("t",)))
    before = sorted(rows(readers.table(spark, path)), key=str)
    broken, done = writers.compact_all(
        spark, [("/nowhere/at/all", LAYOUT), (path, writers.Layout("t", sort=("t",)))])
    assert broken.error and done.error is None
    assert done.files_after < done.files_before
    assert sorted(rows(readers.table(spark, path)), key=str) == before
    again = writers.compact(spark, path, writers.Layout("t", sort=("t",)))
    assert again.partitions == 0 and again.files_after == done.files_after


def test_month_grain(spark):
    path = scratch_dir(spark, "t")
    layout = writers.Layout("t", grain="month")
    writers.append(frame(spark, [(f"k{i}", i * 48, i) for i in range(20)]), path, layout)
    assert {str(r["dt"]) for r in rows(readers.table(spark, path))} == {"2024-01-01", "2024-02-01"}


def test_one_busy_partition_is_written_by_several_tasks(spark):
    path = scratch_dir(spark, "t")
    hot = spark.range(200_000).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3600).alias("t"),
        F.md5(F.col("id").cast("string")).alias("v"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1MB")
    try:
        writers.append(hot, path, LAYOUT)
    finally:
        spark.conf.set(size, before)
    report = rows(writers.file_report(spark, path, LAYOUT.partition_cols))
    assert len(report) == 1 and report[0]["files"] > 1
    assert readers.table(spark, path).count() == 200_000


def test_stored_failures_replace_the_same_check_only(spark):
    path = scratch_dir(spark, "t")
    writers.store_failures(frame(spark, [("a", 0, 1)]), path, "one")
    writers.store_failures(frame(spark, [("b", 0, 1)]), path, "two")
    writers.store_failures(frame(spark, [("c", 0, 1)]), path, "one")
    got = {(r["check_name"], r["k"]) for r in rows(readers.table(spark, path))}
    assert got == {("one", "c"), ("two", "b")}


def test_seed_is_read_with_declared_types(spark, tmp_path):
    seed = tmp_path / "seed.csv"
    seed.write_text("symbol,base_asset,quote_asset,instrument_class,tick_size,step_size,"
                    "min_notional,is_tracked,listed_on\nAB,A,B,spot,0.0100,1,5,true,2017-08-17\n")
    df = readers.reference_seed(spark, str(seed))
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.INSTRUMENT_REFERENCE]
    assert df.head()["is_tracked"] is True


def test_conform_adds_nulls_but_not_required_fields(spark):
    df = spark.range(1).select(F.lit("t").alias("_kafka_topic"), F.lit("x").alias("_reason"))
    assert schemas.conform(df, schemas.QUARANTINE).columns == schemas.QUARANTINE.names
    with pytest.raises(ValueError, match="required"):
        schemas.conform(df, schemas.TRADE)


def test_scratch_follows_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base.rstrip("/"))
