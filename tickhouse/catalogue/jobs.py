"""Registered queries that run a job - a stream, an upsert, a compaction - and read its output."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.catalogue.market import HOUR, tables
from tickhouse.catalogue.present import present
from tickhouse.functions import clock, money
from tickhouse.functions.money import MONEY
from tickhouse.operators import bar_states, ingest, intervals, quality, staging
from tickhouse.operators import bars as bar_ops
from tickhouse.plans import silver
from tickhouse.schemas import (
    INSTRUMENT_REFERENCE,
    RECORDS,
    SCHEMA_VERSION,
    TRADE,
    VENUE,
    partition_key,
)
from tickhouse.session import scratch_dir
from tickhouse.sources import readers, tiers, writers
from tickhouse.sources.sample_tables import event_columns
from tickhouse.sources.staged import stage
from tickhouse.streaming import feeds, landing, stateful
from tickhouse.streaming.feeds import FEEDS

_SPLIT = datetime(2024, 1, 15)
_DAILY = writers.Layout("event_time", buckets=2, sort=("symbol", "event_time", "trade_id"))
_BAR_LAYOUT = writers.Layout("bar_start", sort=("symbol", "bar_start"))
_FLUSH = "__flush__"
_BATCHES = 4
_BRONZE = (
    "exchange", "symbol", "trade_id", "price", "quantity", "quote_quantity", "buyer_is_maker",
    "trade_time", "ingested_at", "_kafka_topic", "_kafka_partition", "_kafka_offset",
    "_kafka_key", "_source",
)


# -- streams ---------------------------------------------------------------------------


_SLICES = 5
# Decoding is the cost of a row: files are small, and a scan packs them by its cores.
_ROWS_PER_FILE = 100_000


def _spread(spark, rows: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows for costly work on each, over all cores however few row groups hold them."""
    return rows.repartition(4 * spark.sparkContext.defaultParallelism, key)


def _event_files(spark, path, slices: int = _SLICES) -> tuple[str, int]:
    """The events in files by slice of time, oldest first, and the files of a slice.

    One pass cuts all slices, each into files for all cores however few row groups hold
    the events or a slice of them; each is then written behind the one before it, so that
    a stream that takes a slice's number of files at a time reads them in order. Events
    without a time are a slice of their own.
    """
    events = tables(spark, path).read("events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high, rows = events.agg(F.min(micros), F.max(micros), F.count(F.lit(1))).first()
    number = F.floor((micros - F.lit(low)) * slices / F.lit(max((high or 0) - (low or 0), 1) + 1))
    cut, folder = scratch_dir(spark, "event-slices"), scratch_dir(spark, "event-files")
    pieces = min(4 * spark.sparkContext.defaultParallelism, 1 + rows // _ROWS_PER_FILE)
    events.withColumn("__slice", F.coalesce(number.cast("int"), F.lit(slices))).repartition(
        pieces, "event_id").write.partitionBy("__slice").parquet(cut)
    files = 1 + rows // (slices * _ROWS_PER_FILE)
    stored = spark.read.schema(
        T.StructType([*events.schema, T.StructField("__slice", T.IntegerType())])).parquet(cut)
    for n in range(slices + 1):
        stored.filter(F.col("__slice") == n).drop("__slice").repartition(files).write.mode(
            "append").parquet(folder)
    return folder, files


def _event_stream(spark, files: tuple[str, int]) -> DataFrame:
    folder, at_a_time = files
    schema = spark.read.parquet(folder).schema
    return readers.file_messages(spark, folder, schema, max_files_per_trigger=at_a_time)


def _messages(events: DataFrame) -> DataFrame:
    """Events as framed JSON trade messages; every hundred-and-first body is cut short."""
    e = event_columns(events)
    price = F.col("value").cast("decimal(18,2)").cast(MONEY)
    size = (F.col("k") + 1).cast(MONEY)
    record = F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(VENUE).alias("exchange"),
        F.col("event_type").alias("symbol"), F.col("event_id").alias("trade_id"),
        price.cast("string").alias("price"), size.cast("string").alias("quantity"),
        money.multiply(price, size).cast("string").alias("quote_quantity"),
        (F.col("user_id") % 2 == 0).alias("buyer_is_maker"),
        F.col("ts").alias("trade_time"), F.col("ts").alias("event_time"), "ingested_at",
        F.lit("sample").alias("producer_id"),
    )
    text = F.to_json(record, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"})
    body = F.when(F.col("event_id") % 101 == 0, F.substring(text, 1, 40)).otherwise(text)
    return e.select(
        F.lit("trades").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), "ts",
        F.col("event_type").cast("binary").alias("key"), _framed(body).alias("value"),
    ).withColumnRenamed("ts", "timestamp")


def _framed(body: Column) -> Column:
    return F.concat(F.unhex(F.lit("0000000001")), body.cast("binary"))


def _record_messages(kind: str, rows: DataFrame, offset: Column, cut: Column) -> DataFrame:
    """Rows of a landed table as framed JSON messages; those of ``cut`` break off."""
    given = {"schema_version": F.lit(SCHEMA_VERSION), "producer_id": F.lit("sample")}
    fields = [
        (F.col(f.name) if f.name in rows.columns else given[f.name])
        .cast("string" if isinstance(f.dataType, T.DecimalType) else f.dataType).alias(f.name)
        for f in RECORDS[kind] if f.name in rows.columns or f.name in given
    ]
    text = F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"})
    return rows.select(
        F.lit(kind).alias("topic"), F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"), F.col("ingested_at").alias("timestamp"),
        partition_key(kind).cast("binary").alias("key"),
        _framed(F.when(cut, F.substring(text, 1, 40)).otherwise(text)).alias("value"),
    )


def _drained_feed(
    spark, kind, messages: DataFrame, files: int = 1
) -> tuple[DataFrame, DataFrame]:
    """A feed's messages landed by its job, in several batches of that many files, and half
    of them settled."""
    feed, root, folder = FEEDS[kind], scratch_dir(spark, "lake"), scratch_dir(spark, "messages")
    messages.repartition(_BATCHES * files).write.parquet(folder)
    stream = readers.file_messages(spark, folder, max_files_per_trigger=files)
    landing.finish(feeds.start(stream, feed, root, scratch_dir(spark, "offsets"), drain=True))
    tiers.fold(spark, feed.tiers(root), 1)
    return tiers.read(spark, feed.tiers(root)), readers.table(spark, feed.quarantine(root))


def land_quotes(spark, path) -> DataFrame:
    """Top-of-book messages through their landing job; some bodies are cut short."""
    t = tables(spark, path)
    quotes = _spread(spark, t.landed_quotes(), "_kafka_offset")
    messages = _record_messages(
        "quote", quotes, F.col("_kafka_offset"), F.col("_kafka_offset") % 101 == 0)
    files = 1 + t.read("events").count() // (_BATCHES * _ROWS_PER_FILE)
    good, bad = _drained_feed(spark, "quote", messages, files)
    rows = good.select("exchange", "symbol", "update_id", "bid_price", "bid_quantity", "ask_price",
                       "ask_quantity", "event_time", "ingested_at", "_kafka_topic", "_kafka_offset",
                       "_kafka_key", "_source", F.lit(None).cast("string").alias("_reason"))
    return present(rows.unionByName(
        bad.select("_kafka_topic", "_kafka_offset", "_kafka_key", "_reason"),
        allowMissingColumns=True))


def land_klines(spark, path) -> DataFrame:
    """Venue candles through their draining job, into months by interval."""
    klines = tables(spark, path).landed_klines()
    good, _ = _drained_feed(spark, "kline", _record_messages(
        "kline", klines, F.unix_micros("open_time"), F.lit(False)))
    return present(good, "exchange", "symbol", "interval", "open_time", "close_time", "open",
                   "high", "low", "close", "volume", "quote_volume", "trade_count",
                   "taker_buy_base_volume", "taker_buy_quote_volume", "is_closed", "_kafka_key")


def land_fx(spark, path) -> DataFrame:
    """Reference rates through their draining job."""
    rates = tables(spark, path).landed_fx()
    good, _ = _drained_feed(spark, "fx_rate", _record_messages(
        "fx_rate", rates, F.unix_micros("valid_from"), F.lit(False)))
    return present(good, "source", "base_currency", "quote_currency", "rate", "valid_from",
                   "valid_to", "_kafka_key")


def compact_landed(spark, path) -> DataFrame:
    """Five landed batches, folded in between; a batch comes again before its fold and
    after it, and a fold runs twice."""
    e = _spread(spark, tables(spark, path).read("events"))
    feed, root = FEEDS["trade"], scratch_dir(spark, "lake")
    decoded = stage(landing.decode(_messages(e), TRADE, VENUE).withColumn(
        "__slice", F.pmod(F.col("_kafka_offset"), F.lit(_SLICES))))

    def land(n: int) -> None:
        feeds.land_batch(decoded.filter(F.col("__slice") == n).drop("__slice"), n, feed, root)

    table = feed.tiers(root)
    for step in (0, 1, 1, "fold 1", 1, 2, "fold 1", 3, "fold 2", 4):
        if isinstance(step, int):
            land(step)
        else:
            tiers.fold(spark, table, int(step.split()[1]))
    return present(tiers.read(spark, table), *_BRONZE)


def _land(spark, path) -> tuple[str, str]:
    out, quarantine = scratch_dir(spark, "landed"), scratch_dir(spark, "quarantine")
    events = _event_stream(spark, _event_files(spark, path))
    decoded = landing.decode(_messages(events), TRADE, VENUE)
    landing.finish(
        landing.start_landing(
            decoded, out, quarantine, scratch_dir(spark, "offsets"), trigger_seconds=None
        )
    )
    return out, quarantine


def stream_bronze(spark, path) -> DataFrame:
    tables(spark, path)
    out, _ = _land(spark, path)
    return present(readers.table(spark, out), *_BRONZE)


def stream_quarantine(spark, path) -> DataFrame:
    tables(spark, path)
    _, quarantine = _land(spark, path)
    return present(
        readers.table(spark, quarantine), "_kafka_topic", "_kafka_offset", "_kafka_timestamp",
        "_kafka_key", "_reason",
    )


def _drain_with_flush(spark, path, build, label) -> DataFrame:
    """Drain the events, then one row far in the future that closes every open window.

    The flush row arrives in a second run on the same checkpoint, so that it
    cannot make rows of a later file late.
    """
    schema = spark.read.parquet(f"{path}/events.parquet").schema
    flush_dir, out = scratch_dir(spark, "flush"), scratch_dir(spark, label)
    checkpoint, files = scratch_dir(spark, "offsets"), _event_files(spark, path)
    blank = spark.createDataFrame([], schema)
    blank.write.parquet(flush_dir)
    for final in (False, True):
        if final:
            last = spark.range(1).select(
                F.lit(-1).cast("bigint").alias("event_id"),
                F.lit("2100-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
                F.lit(0).cast("bigint").alias("user_id"), F.lit(_FLUSH).alias("event_type"),
                F.lit(1.0).alias("value"), F.lit('{"k": 0}').alias("props"),
            )
            last.write.mode("append").parquet(flush_dir)
        rows = _event_stream(spark, files).unionByName(
            readers.file_messages(spark, flush_dir, schema)
        )
        landing.finish(
            landing.start_append(build(event_columns(rows)), out, checkpoint, trigger_seconds=None)
        )
    return readers.table(spark, out).filter(F.col("symbol") != _FLUSH)


def _replayed(e: DataFrame) -> DataFrame:
    """The same events and replays as the batch tape, as a stream."""
    price = F.col("value").cast("decimal(18,2)").cast(MONEY)
    size = (F.col("k") + 1).cast(MONEY)
    copies = F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return e.select(
        F.lit(VENUE).alias("exchange_id"), F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"), price.alias("price"), size.alias("quantity"),
        money.multiply(price, size).cast(MONEY).alias("notional"),
        (F.col("user_id") % 2 != 0).alias("is_buyer_aggressor"),
        F.col("ts").alias("event_time"), F.explode(copies).alias("copy"),
    )


def stream_dedup(spark, path) -> DataFrame:
    tables(spark, path)
    stateful.use_rocksdb(spark)
    out = _drain_with_flush(
        spark, path, lambda e: stateful.dedup_stream(_replayed(e), silver.TRADE_KEYS), "dedup"
    )
    return present(out.drop("copy", "is_buyer_aggressor"))


def _bar_state_tables(spark, trades: DataFrame) -> tuple[tiers.Tiers, tiers.Tiers]:
    root = scratch_dir(spark, "bar-states")
    keys = trades.select(*silver.TRADE_KEYS, "event_time").schema
    states = bar_states.fold(trades.limit(0), HOUR).schema
    return (
        tiers.Tiers(f"{root}/states", f"{root}/states-settled", _BAR_LAYOUT, states,
                    bar_states.merge),
        tiers.Tiers(f"{root}/seen", f"{root}/seen-settled",
                    writers.Layout("event_time", sort=("symbol", "trade_id")), keys),
    )


def stream_bars(spark, path) -> DataFrame:
    """Candles as stored states, from a stream with replays in which every thirteenth
    trade comes days late, in the last batch."""
    tables(spark, path)
    folder, files = _event_files(spark, path)
    schema = spark.read.parquet(folder).schema
    late = F.col("event_id") % 13 == 0
    checkpoint, late_dir = scratch_dir(spark, "offsets"), scratch_dir(spark, "late-events")
    spark.createDataFrame([], schema).write.parquet(late_dir)
    blank = _replayed(event_columns(spark.read.parquet(folder))).drop("copy")
    states, seen = _bar_state_tables(spark, blank)
    for final in (False, True):
        if final:
            spark.read.parquet(folder).filter(late).write.mode("append").parquet(late_dir)
            stateful.fold_bar_states(spark, states, seen, 1)
        events = _event_stream(spark, (folder, files)).filter(~late).unionByName(
            readers.file_messages(spark, late_dir, schema))
        landing.finish(stateful.start_bar_states(
            _replayed(event_columns(events)).drop("copy"), states, seen, checkpoint,
            silver.TRADE_KEYS, ("event_time",), HOUR, trigger_seconds=None))
    return present(bar_states.finish(tiers.read(spark, states).drop("dt"), HOUR))


def stream_bars_closed(spark, path) -> DataFrame:
    """Candles by watermark: each is given once, when no further trade may change it."""
    tables(spark, path)
    stateful.use_rocksdb(spark)

    def build(e: DataFrame) -> DataFrame:
        return stateful.bars_stream(
            stateful.dedup_stream(_replayed(e), silver.TRADE_KEYS), seconds=HOUR
        )

    return present(_drain_with_flush(spark, path, build, "bars"))


def stream_sequence(spark, path) -> DataFrame:
    tables(spark, path)
    e = event_columns(_event_stream(spark, _event_files(spark, path)))
    arrived = e.select(
        F.col("event_type").alias("symbol"),
        F.date_format("ts", "yyyy-MM-dd").alias("session"),
        F.col("event_id").alias("kafka_offset"),
        (F.col("event_id") * 7 - F.when(F.col("k") < 10, 500).otherwise(0)).alias("update_id"),
    )
    out = scratch_dir(spark, "sequence")
    landing.finish(
        stateful.start_sequence(
            arrived, ("symbol", "session"), out, scratch_dir(spark, "marks"),
            scratch_dir(spark, "offsets"), trigger_seconds=None,
        )
    )
    observed = readers.table(spark, out).drop("batch_id")
    return present(observed.withColumnRenamed("arrival", "kafka_offset"))


# -- stored tables ---------------------------------------------------------------------


def _tape(spark, path) -> DataFrame:
    return stage(
        silver.trades(tables(spark, path).landed_trades()).select(
            "exchange_id", "symbol", "trade_id", "price", "quantity", "event_time",
            "lake_ingested_at",
        )
    )


def merge_upsert(spark, path) -> DataFrame:
    """A stored tape, then corrections from mid-January on.

    A correction adds one to the size and, for some trades, moves them to the
    next day, so a key leaves one partition for another.
    """
    trades = _tape(spark, path)
    target = scratch_dir(spark, "merge")
    writers.upsert(trades, target, silver.TRADE_KEYS, _DAILY)
    moved = F.when(
        F.col("quantity") > 90, clock.plus_seconds(F.col("event_time"), 86_400)
    ).otherwise(F.col("event_time"))
    corrections = stage(
        trades.filter(F.col("event_time") >= F.lit(_SPLIT)).withColumns(
            {"quantity": (F.col("quantity") + 1).cast(MONEY), "event_time": moved,
             "is_corrected": F.lit(True)}
        )
    )
    writers.upsert(corrections, target, silver.TRADE_KEYS, _DAILY, timedelta(days=3))
    merged = readers.table(spark, target)
    return present(
        merged, "symbol", "trade_id", "quantity", "event_time",
        F.coalesce("is_corrected", F.lit(False)).alias("is_corrected"),
    )


def incremental_bars(spark, path) -> DataFrame:
    """Hourly candles from stored states: a tape up to mid-January, then what is newer,
    then trades of weeks before; no batch reads an earlier one's trades."""
    trades = stage(silver.trades(tables(spark, path).landed_trades(), stage))
    late = F.col("trade_id") % 11 == 0
    early = F.col("event_time") < F.lit(_SPLIT + timedelta(minutes=30))
    states, _ = _bar_state_tables(spark, trades)
    for n, batch in enumerate((early & ~late, ~early & ~late, late)):
        tiers.add(bar_states.fold(trades.filter(batch), HOUR), states, n)
        if n == 1:
            tiers.fold(spark, states, 1)
    bars = stage(bar_states.finish(tiers.read(spark, states).drop("dt"), HOUR))
    return present(bar_ops.with_log_returns(bars, chunk_seconds=7 * 86_400))


def incremental_bars_rebuilt(spark, path) -> DataFrame:
    """Hourly candles built up to mid-January, then the bars of the last day anew."""
    trades = stage(silver.trades(tables(spark, path).landed_trades()))
    target = scratch_dir(spark, "bars")
    early = trades.filter(F.col("event_time") < F.lit(_SPLIT + timedelta(minutes=30)))
    keys = ("exchange_id", "symbol", "bar_start")
    writers.upsert(stage(silver.ohlcv(early, HOUR, stage=stage)), target, keys, _BAR_LAYOUT)

    lookback = timedelta(hours=24)
    stored = readers.table(spark, target)
    mark = writers.high_water_mark(stored, "bar_start")
    window = writers.incremental(trades, "event_time", mark, lookback)
    # The last stored bar before the window seeds the first return inside it.
    previous = (
        stored.filter(F.col("bar_start") < F.lit(mark - lookback))
        .groupBy("exchange_id", "symbol")
        .agg(F.max_by(F.struct("bar_start", "close_price"), "bar_start").alias("last"))
        .select("exchange_id", "symbol", "last.*")
    )
    rebuilt = stage(silver.ohlcv(window, HOUR, previous=stage(previous), stage=stage))
    writers.upsert(rebuilt, target, keys, _BAR_LAYOUT, lookback)
    return present(
        readers.table(spark, target), "exchange_id", "symbol", "bar_start", "open_price",
        "close_price", "base_volume", "trade_count", "log_return",
    )


def compact_report(spark, path) -> DataFrame:
    """A tape landed in several small appends, before and after compaction, per day."""
    trades = staging.stage_trades(tables(spark, path).landed_trades()).select(
        "symbol", "trade_id", "price", "event_time", "buyer_is_maker"
    )
    layout = writers.Layout("event_time", sort=("symbol", "event_time"))
    target = scratch_dir(spark, "small-files")
    for side in (True, False):
        writers.append(trades.filter(F.col("buyer_is_maker") == side), target, layout)
    before = stage(writers.file_report(spark, target, layout.partition_cols))
    writers.compact(spark, target, layout)
    after = writers.file_report(spark, target, layout.partition_cols)
    rows = readers.table(spark, target).groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("trades")
    )
    return present(
        before.select("dt", (F.col("files") > 1).alias("was_split"))
        .join(after.select("dt", F.col("files").alias("files_after")), "dt")
        .join(rows, "dt")
    )


# -- repeats, extremes and open ends ---------------------------------------------------


def parse_extremes(spark, path) -> DataFrame:
    """Trade messages at the ends of the ranges: results or dead letters, never an abort.

    By id: sizes of 10^15 and over, prices of a few 1e-18, times at the 64-bit limit,
    products of 21 digits, and ordinary trades.
    """
    e = tables(spark, path).events()
    case = F.col("event_id") % 5
    cents = F.col("value").cast("decimal(18,2)").cast("string")
    tiny = F.concat(F.lit("0."), F.lpad((F.col("event_id") + 1).cast("string"), 18, "0"))
    price = F.when(case == 1, tiny).when(case == 3, "9" * 20).otherwise(cents)
    size = (
        F.when(case == 0, F.concat((F.col("k") + 1).cast("string"), F.lit("0" * 15)))
        .when(case == 1, "1000").otherwise((F.col("k") + 2).cast("string"))
    )
    moment = F.when(case == 2, str(2**63 - 1)).otherwise(F.unix_millis("ts").cast("string"))
    payload = F.concat(
        F.lit('{"e":"trade","s":"'), "event_type", F.lit('","t":'), F.col("event_id"),
        F.lit(',"p":"'), price, F.lit('","q":"'), size, F.lit('","m":true,"T":'), moment,
        F.lit("}"),
    )
    raw = _spread(spark, e).select(payload.alias("payload"), F.col("ts").alias("received_at"))
    out = ingest.normalise_trades(ingest.route_frames(raw)).stored(stage)
    good = out.valid.select(
        "trade_id", F.col("quote_quantity").cast("string").alias("notional"),
        F.lit(None).cast("string").alias("error_type"), "raw_payload",
    )
    bad = out.dead_letters.select(
        F.get_json_object("raw_payload", "$.t").cast("bigint").alias("trade_id"),
        F.lit(None).cast("string").alias("notional"), "error_type", "raw_payload",
    )
    return present(good.unionByName(bad))


def dead_letter_texts(spark, path) -> DataFrame:
    """Cut-off frames, some very long: the whole text is kept, and its length."""
    e = tables(spark, path).events()
    times = F.when(F.col("event_id") % 1000 == 0, F.lit(40_000)).otherwise(F.col("k") + 1)
    payload = F.concat(F.lit('{"cut": "'), F.expr("repeat(event_type, CAST(times AS INT))"))
    raw = e.withColumn("times", times).select(
        payload.alias("payload"), F.col("ts").alias("received_at"))
    letters = ingest.malformed_frames(ingest.route_frames(raw))
    return present(letters.select(
        F.md5("raw_payload").alias("payload_md5"), "payload_length", "error_type", "failed_at"))


def landing_repeated_batch(spark, path) -> DataFrame:
    """A batch that is written again after a failure lands once."""
    good, bad = scratch_dir(spark, "landed"), scratch_dir(spark, "quarantine")
    events = _spread(spark, tables(spark, path).read("events"))
    # Both outputs of both writes read the decoded rows.
    decoded = stage(landing.decode(_messages(events), TRADE, VENUE))
    for _ in range(2):
        landing.write_batch(decoded, 7, good, bad)
    landed = readers.table(spark, good).groupBy("symbol").agg(F.count(F.lit(1)).alias("landed"))
    quarantined = readers.table(spark, bad).groupBy(F.col("_kafka_key").alias("symbol")).agg(
        F.count(F.lit(1)).alias("quarantined"))
    return present(landed.join(quarantined, "symbol", "left"))


def upsert_repeated_keys(spark, path) -> DataFrame:
    """Replayed trades in one upsert: the copy that the lake saw last is kept."""
    landed = stage(staging.stage_trades(tables(spark, path).landed_trades()).select(
        "exchange_id", "symbol", "trade_id", "price", "event_time", "lake_ingested_at"))
    target = scratch_dir(spark, "merge")
    early = landed.filter(F.col("event_time") < F.lit(_SPLIT))
    for rows in (early, landed):
        writers.upsert(rows, target, silver.TRADE_KEYS, _DAILY, order=("lake_ingested_at",))
    return present(readers.table(spark, target), "symbol", "trade_id", "price", "event_time",
                   "lake_ingested_at")


def open_interval_join(spark, path) -> DataFrame:
    """Rates whose last interval has no end yet, joined by time bucket."""
    t = tables(spark, path)
    rates = intervals.rebound_intervals(
        t.publications(), ["currency_pair"], order=("publication_id",), stage=stage)
    opened = rates.withColumn("valid_to", F.when(F.col("was_rebounded"), F.col("valid_to")))
    joined = intervals.interval_join(
        t.tape(), opened, "event_time", "valid_from", "valid_to", on=("currency_pair",))
    return present(joined.groupBy("currency_pair").agg(
        F.count(F.lit(1)).alias("trades"), F.count("rate").alias("with_rate"),
        F.max("valid_from").alias("newest")))


def rebuild_tape(spark, path) -> DataFrame:
    """A full rebuild replaces what an earlier one wrote; per day of the table's layout."""
    trades, target = _tape(spark, path), scratch_dir(spark, "rebuilt")
    writers.overwrite(trades.filter(F.col("quantity") > 50), target, _DAILY)
    writers.overwrite(trades, target, _DAILY)
    return present(readers.table(spark, target).groupBy("symbol", F.col("dt").cast("string")
                   .alias("dt")).agg(F.count(F.lit(1)).alias("trades")))


def stored_failures(spark, path) -> DataFrame:
    """The rows behind a failed check, kept in its table."""
    trades = staging.stage_trades(tables(spark, path).landed_trades())
    check = quality.in_range("ingestion_lag_ms", -10_000, 4_000, severity="warn")
    target = scratch_dir(spark, "failures")
    failing = quality.failing_rows(trades, check)
    for _ in range(2):
        writers.store_failures(failing, target, "lag")
    # A check that nothing fails leaves no file to tell the schema.
    declared = failing.schema.add("check_name", "string")
    return present(readers.table(spark, target, declared), "symbol", "trade_id",
                   "ingestion_lag_ms", "check_name")


def seed_reference(spark, path) -> DataFrame:
    """The declared instruments, written as CSV and read with their declared types."""
    target = scratch_dir(spark, "seed")
    declared = tables(spark, path).reference().withColumn("listed_on", F.lit("2024-01-01"))
    declared.select(*INSTRUMENT_REFERENCE.names).write.option("header", "true").csv(target)
    return present(readers.reference_seed(spark, target))


def message_keys(spark, path) -> DataFrame:
    """Landed trades by the key that keeps an instrument's messages in order."""
    trades = tables(spark, path).landed_trades()
    return present(trades.groupBy(partition_key("trade").alias("message_key")).agg(
        F.count(F.lit(1)).alias("messages"), F.max("trade_id").alias("last_id")))


QUERIES = {
    f.__name__: f
    for f in (
        parse_extremes, dead_letter_texts, landing_repeated_batch, upsert_repeated_keys,
        open_interval_join, rebuild_tape, stored_failures, seed_reference, message_keys,
        merge_upsert, incremental_bars, incremental_bars_rebuilt, compact_report, compact_landed,
        land_quotes, land_klines, land_fx,
        stream_bronze, stream_quarantine, stream_dedup, stream_bars, stream_bars_closed,
        stream_sequence,
    )
}
