import json
import os
import random
from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from tickhouse import schemas
from tickhouse.catalogue import jobs
from tickhouse.session import scratch_dir
from tickhouse.sources import readers
from tickhouse.sources.staged import stage
from tickhouse.streaming import landing, stateful

NOW = datetime(2024, 1, 1, 1)
RECORD = {"schema_version": 1, "exchange": "binance", "symbol": "S", "trade_id": 1,
          "price": "64250.100000000000000001", "quantity": "2", "buyer_is_maker": True,
          "trade_time": "2024-01-01T00:00:00.123Z", "event_time": "2024-01-01T00:00:00.200Z",
          "ingested_at": "2024-01-01T00:00:01Z", "producer_id": "p"}


def messages(spark, *bodies, start=0):
    framed = [("t", 0, start + i, NOW, b"S", None if b is None else b"\x00\x00\x00\x00\x07" + b)
              for i, b in enumerate(bodies)]
    return spark.createDataFrame(framed, schemas.MESSAGE)


def body(**changes):
    return json.dumps({k: v for k, v in {**RECORD, **changes}.items() if v is not None}).encode()


def test_landing_splits_once_and_resumes_from_its_checkpoint(spark):
    source, out, bad, ckpt = (scratch_dir(spark, n) for n in ("in", "out", "bad", "ckpt"))

    def run():
        stream = readers.file_messages(spark, source, max_files_per_trigger=1)
        decoded = landing.decode(stream, schemas.TRADE, "venue")
        return landing.finish(landing.start_landing(decoded, out, bad, ckpt, trigger_seconds=None))

    first = [body(), body()[:30], b"", None, body(trade_id=None), body(extra="ignored", trade_id=2)]
    messages(spark, *first).coalesce(1).write.parquet(source)
    assert run() == len(first)
    assert run() == 0
    messages(spark, body(trade_id=3), start=6).coalesce(1).write.mode("append").parquet(source)
    assert run() == 1

    good = rows(readers.table(spark, out), "trade_id")
    assert [r["trade_id"] for r in good] == [1, 2, 3]
    assert str(good[0]["price"]) == "64250.100000000000000001"
    assert good[0]["quote_quantity"] is None and good[0]["_source"] == "venue"
    assert good[0]["trade_time"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert (good[2]["_kafka_offset"], good[2]["_kafka_key"]) == (6, "S")
    quarantine = rows(readers.table(spark, bad), "_kafka_offset")
    assert [r["_kafka_offset"] for r in quarantine] == [1, 2, 3, 4]
    assert {r["_reason"] for r in quarantine} == {"avro_decode_failed"}


def test_append_sink_drains(spark):
    source, out = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    messages(spark, body()).write.parquet(source)
    stream = readers.file_messages(spark, source).withColumn("d", F.to_date("timestamp"))
    query = landing.start_append(stream, out, scratch_dir(spark, "c"), None, partition_by=("d",))
    assert landing.finish(query) == 1 and readers.table(spark, out).count() == 1


def test_landed_schema_matches_the_contract(spark):
    decoded = landing.decode(messages(spark, body()), schemas.TRADE, "venue")
    names = [c for c in landing.landed(decoded).columns]
    assert sorted(names) == sorted(schemas.landed("trade").names)


def test_a_drain_counts_every_batch(spark):
    source, out = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    for n in range(6):
        messages(spark, *[body()] * (n + 1)).coalesce(1).write.mode("append").parquet(source)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    try:
        stream = readers.file_messages(spark, source, max_files_per_trigger=1)
        query = landing.start_append(stream, out, scratch_dir(spark, "c"), None)
        assert landing.finish(query) == 21
        assert sum(p["numInputRows"] for p in query.recentProgress) < 21
    finally:
        spark.conf.set(kept, before)


def test_late_rows_are_counted(spark):
    source, out = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    hours = [datetime(2024, 1, 1, h) for h in (12, 20, 1)]
    schema = "k string, event_time timestamp"
    for n, at in enumerate(hours):
        spark.createDataFrame([(f"k{n}", at)], schema).coalesce(1).write.mode("append").parquet(source)
    stream = readers.file_messages(
        spark, source, spark.read.parquet(source).schema, max_files_per_trigger=1)
    query = landing.start_append(
        stateful.dedup_stream(stream, ["k"]), out, scratch_dir(spark, "c"), None)
    assert landing.finish(query) == 3
    assert landing.late_rows(query) == 1 and readers.table(spark, out).count() == 2


def test_a_repeated_batch_replaces_itself(spark):
    out, bad = scratch_dir(spark, "out"), scratch_dir(spark, "bad")
    decoded = landing.decode(messages(spark, body(), body()[:9]), schemas.TRADE, "venue")
    for batch in (1, 1, 2):
        landing.write_batch(decoded, batch, out, bad)
    assert readers.table(spark, out).count() == readers.table(spark, bad).count() == 2


def test_a_sequence_over_batches_equals_the_loop(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), n, rng.randrange(60)) for n in range(120)]
    expected, highs = {}, {}
    for symbol, n, u in data:
        high = highs.get(symbol)
        back = high is not None and u <= high
        expected[n] = (high is None, back, 0 if high is None or back else u - high - 1)
        highs[symbol] = u if high is None else max(high, u)
    source, out, marks, checkpoint = (scratch_dir(spark, n) for n in ("in", "out", "marks", "c"))
    schema = "symbol string, kafka_offset long, update_id long"

    def run():
        stream = readers.file_messages(
            spark, source, spark.read.parquet(source).schema, max_files_per_trigger=1)
        return landing.finish(
            stateful.start_sequence(stream, ["symbol"], out, marks, checkpoint, trigger_seconds=None))

    for at in range(0, 80, 20):
        spark.createDataFrame(data[at:at + 20], schema).coalesce(1).write.mode("append").parquet(source)
    assert run() == 80
    for at in range(80, 120, 20):
        spark.createDataFrame(data[at:at + 20], schema).coalesce(1).write.mode("append").parquet(source)
    assert run() == 40
    got = {r["arrival"]: (r["first_seen"], r["regressed"], r["span"])
           for r in rows(readers.table(spark, out))}
    assert got == expected


def test_a_body_is_parsed_once(spark):
    decoded = landing.decode(spark.createDataFrame([], schemas.MESSAGE), schemas.TRADE, schemas.VENUE)
    for rows_out in (landing.landed(decoded), landing.quarantined(decoded)):
        plan = rows_out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def _part_files(folder):
    return [n for n in os.listdir(folder) if n.startswith("part-")]


def _one_group(spark, tmp_path, rows=1_000):
    """An events table whose rows are one row group of one file."""
    spark.range(rows).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id * 60) as ts",
        "id as user_id", "'a' as event_type", "1.0D as value", "'{\"k\": 1}' as props",
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_slices_of_one_row_group_are_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "_ROWS_PER_FILE", 100)
    folder, files = jobs._event_files(spark, _one_group(spark, tmp_path))
    assert files == 3 and len(_part_files(folder)) >= 5 * files
    assert spark.read.parquet(folder).count() == 1_000


def test_each_slice_cut_from_one_row_group_is_read_over_all_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "_ROWS_PER_FILE", 50)
    made = {}
    monkeypatch.setattr(jobs, "scratch_dir",
                        lambda s, label: made.setdefault(label, scratch_dir(s, label)))
    folder, files = jobs._event_files(spark, _one_group(spark, tmp_path))
    cores = spark.sparkContext.defaultParallelism
    for n in range(5):
        assert len(_part_files(f"{made['event-slices']}/__slice={n}")) >= cores
    assert files == 5 and spark.read.parquet(folder).distinct().count() == 1_000


def test_a_draining_feed_takes_several_files_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "_ROWS_PER_FILE", 100)
    taken, read = [], readers.file_messages

    def noted(spark, folder, max_files_per_trigger):
        taken.append((len(_part_files(folder)), max_files_per_trigger))
        return read(spark, folder, max_files_per_trigger=max_files_per_trigger)

    monkeypatch.setattr(readers, "file_messages", noted)
    assert jobs.land_quotes(spark, _one_group(spark, tmp_path)).count() == 1_050
    assert taken == [(12, 3)]


def test_decoding_uses_all_cores_for_one_row_group(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(jobs, "stage", lambda df: staged.append(stage(df)) or staged[-1])
    jobs.compact_landed(spark, _one_group(spark, tmp_path))
    assert len(staged[0].inputFiles()) >= spark.sparkContext.defaultParallelism
