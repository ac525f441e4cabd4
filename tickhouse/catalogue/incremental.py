"""Registered queries over histories and coverage that grow by batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.catalogue import jobs
from tickhouse.catalogue.market import HOUR, tables
from tickhouse.catalogue.present import present
from tickhouse.functions import clock
from tickhouse.operators import bars as bar_ops
from tickhouse.operators import distribution, ingest, presence, quality, staging, telemetry
from tickhouse.operators import quotes as quote_ops
from tickhouse.operators.dedup import dedup
from tickhouse.plans import gold, refresh, silver
from tickhouse.schemas import TRADE, VENUE
from tickhouse.session import scratch_dir
from tickhouse.sources import bucketed, history, readers
from tickhouse.sources.staged import stage
from tickhouse.streaming import landing, late

_VERSIONS = ("symbol", "status", "tick_size", "step_size", "min_notional", "valid_from", "valid_to",
             "is_current")
_KEYS = ("exchange", "symbol")


def _versions_in_batches(spark, observations: DataFrame, chunk_seconds: int, deletes: bool):
    """Five batches by year, the third of which is added twice."""
    rows = stage(observations.withColumn(
        "__batch", F.greatest(F.least(F.year("observed_at") - 1993, F.lit(4)), F.lit(0))),
        by=("__batch",))
    root = scratch_dir(spark, "history")
    for n in (0, 1, 2, 2, 3, 4):
        history.add(rows.filter(F.col("__batch") == n).drop("__batch"), n, root, stage,
                    tie_break=("observation_id",), close_deletes=deletes,
                    chunk_seconds=chunk_seconds)
    payload = [f for f in observations.schema if f.name in _VERSIONS]
    times = [T.StructField(c, T.TimestampType()) for c in ("valid_from", "valid_to")]
    schema = T.StructType([*payload, *times, T.StructField("is_current", T.BooleanType())])
    return present(history.read(spark, root, 4, schema))


def instrument_scd2_incremental(spark, path) -> DataFrame:
    """Histories of polled instruments, batch by batch; a key missing from a poll closes."""
    return _versions_in_batches(
        spark, tables(spark, path).quarterly_observations(), 1_000 * 86_400, True)


def instrument_scd2_incremental_changes(spark, path) -> DataFrame:
    """The same of observations that come one by one; only other values close a version."""
    return _versions_in_batches(spark, tables(spark, path).observations(), 1_000 * 86_400, False)


def _presence(spark, path) -> DataFrame:
    """Bitmaps of two halves of the tape, merged."""
    trades = tables(spark, path).landed_trades()
    halves = [presence.minute_presence(trades.filter(F.col("buyer_is_maker") == side), _KEYS,
                                       "trade_time") for side in (True, False)]
    return stage(presence.merge(halves[0].unionByName(halves[1]), _KEYS))


def completeness_bitmap(spark, path) -> DataFrame:
    """Minutes present, gaps and missing days of each instrument and day."""
    return present(presence.coverage(_presence(spark, path), _KEYS))


def backfill_bitmap(spark, path) -> DataFrame:
    """Requests of at most 600 minutes that fill all gaps."""
    return present(presence.backfill_plan(_presence(spark, path), _KEYS, 600))


# -- refresh by changed bars -----------------------------------------------------------

_CUT = datetime(2024, 1, 25)
_BAR = ["exchange_id", "symbol", "bar_start"]


def _fact_of(bars, metrics, fx) -> DataFrame:
    return gold.market_fact(bars, metrics, fx)


def incremental_fact(spark, path) -> DataFrame:
    """The market fact as of a day, then what came to the lake since: newer trades and
    quotes, and every seventeenth, which is two weeks late."""
    t = tables(spark, path)

    def arriving(rows: DataFrame, ids: str) -> DataFrame:
        late = F.when(F.col(ids) % 17 == 0, 14 * 86_400).otherwise(0)
        return rows.withColumn("lake_ingested_at", F.timestamp_micros(
            F.unix_micros("lake_ingested_at") + late.cast("bigint") * 1_000_000))

    landed = stage(arriving(staging.stage_trades(t.landed_trades()), "trade_id"))
    quotes = stage(dedup(arriving(staging.stage_quotes(t.landed_quotes()), "update_id"),
                         silver.QUOTE_KEYS, silver.ARRIVAL, count_col=None))
    fx = stage(silver.fx_rates(t.landed_fx(), stage))
    seen = F.col("lake_ingested_at") <= F.lit(_CUT)

    def candles(rows: DataFrame) -> DataFrame:
        once = staging.assign_bars(dedup(rows, silver.TRADE_KEYS, silver.ARRIVAL))
        return bar_ops.aggregate_bars(once, HOUR)

    # As of the cut.
    bars = stage(candles(landed.filter(seen)))
    metrics = stage(silver.quote_metrics(
        quote_ops.with_durations(quotes.filter(seen)), HOUR, discrete_median=True))
    fact = stage(_fact_of(bar_ops.with_log_returns(bars), metrics, fx))

    # What arrived since.
    dirty = stage(refresh.dirty_bars(landed, _CUT, HOUR))
    bars = stage(refresh.replaced(bars, candles(refresh.rows_of(landed, dirty, HOUR)), dirty, _BAR))
    changed, requoted = refresh.changed_quote_bars(quotes, _CUT, HOUR, stage)
    metrics = stage(refresh.replaced(
        metrics, silver.quote_metrics(requoted, HOUR, discrete_median=True), changed, _BAR))
    touched = stage(refresh.following(bars, dirty).unionByName(changed).distinct())
    returns = bar_ops.with_log_returns(bars.select(*_BAR, "close_price")).select(*_BAR, "log_return")
    fresh = bars.join(touched, _BAR, "left_semi").join(returns, _BAR)
    return present(refresh.replaced(fact, _fact_of(fresh, metrics, fx), touched, _BAR))


# -- distributions, buckets, late rows -------------------------------------------------

_SHARES = {"p50_lag_ms": 0.5, "p95_lag_ms": 0.95, "p99_lag_ms": 0.99}


def _lag_states(spark, path) -> DataFrame:
    """Hourly value counts of two halves of the landed trades, merged."""
    trades = staging.stage_trades(tables(spark, path).landed_trades())
    halves = [distribution.counts(trades.filter(F.col("buyer_is_maker") == side), ["symbol"],
                                  "event_time", "ingestion_lag_ms") for side in (True, False)]
    return stage(distribution.merge(halves[0].unionByName(halves[1]), ["symbol"]))


def lag_percentiles_rolled(spark, path) -> DataFrame:
    """Exact lag percentiles per symbol and day from stored hourly counts."""
    days = distribution.merge(
        _lag_states(spark, path), ["symbol"], F.date_trunc("day", "bar_start"))
    found = distribution.quantiles(stage(days), ["symbol"], _SHARES)
    return present(found.withColumn("day", F.to_date("bar_start")).drop("bar_start")
                   .withColumnRenamed("max_value", "max_lag_ms"))


def kline_reconciliation_bucketed(spark, path) -> DataFrame:
    """Our candles and the venue's from tables in buckets of the join keys: no shuffle."""
    t = tables(spark, path)
    bars = silver.ohlcv(silver.trades(t.landed_trades()), HOUR, stage=stage)
    names = [bucketed.write(df, label, _BAR) for label, df in
             (("bars", bars), ("venue", silver.venue_klines(t.landed_klines())))]
    return present(gold.reconcile(*[bucketed.read(spark, n) for n in names]))


def market_fact_bucketed(spark, path) -> DataFrame:
    """The market fact from candles and quote metrics stored in buckets."""
    t = tables(spark, path)
    bars = silver.ohlcv(silver.trades(t.landed_trades()), HOUR, stage=stage)
    metrics = silver.quote_metrics(
        silver.quotes(t.landed_quotes(), stage), HOUR, discrete_median=True)
    names = [bucketed.write(df, label, _BAR) for label, df in
             (("bars", bars), ("metrics", metrics))]
    fx = stage(silver.fx_rates(t.landed_fx(), stage))
    return present(gold.market_fact(*[bucketed.read(spark, n) for n in names], fx))


def stream_late_rows(spark, path) -> DataFrame:
    """Events in five batches by time, every thirteenth two batches late, with a restart in
    between: what was on time, and what came more than an hour behind."""
    events = tables(spark, path).read("events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    own = F.floor((micros - F.lit(low)) * 5 / F.lit(max((high or 0) - (low or 0), 1) + 1))
    shown = F.when(F.col("event_id") % 13 == 0, F.least(own + 2, F.lit(4))).otherwise(own)
    cut = stage(events.withColumn("__batch", F.coalesce(shown, F.lit(4)).cast("int")))
    folder, root = scratch_dir(spark, "late-files"), scratch_dir(spark, "late")
    split = late.Split(f"{root}/on-time", f"{root}/late", f"{root}/marks", "ts")
    checkpoint = scratch_dir(spark, "offsets")
    # A run a batch, each on the checkpoint of the one before it.
    for n in range(5):
        cut.filter(F.col("__batch") == n).drop("__batch").write.mode("append").parquet(folder)
        stream = readers.file_messages(spark, folder, events.schema)
        landing.finish(late.start_split(stream, split, checkpoint, trigger_seconds=None))
    parts = [
        spark.read.schema(T.StructType([*events.schema, T.StructField("batch_id", T.LongType())]))
        .parquet(p).withColumn("is_late", F.lit(flag))
        for p, flag in ((split.on_time, False), (split.late, True))
    ]
    return present(parts[0].unionByName(parts[1]), "event_id", "ts", "event_type", "batch_id",
                   "is_late")


# -- delivery --------------------------------------------------------------------------


def message_outcomes(spark, path) -> DataFrame:
    """Messages per hour by stream kind and error class; no class means accepted."""
    t = tables(spark, path)
    frames = stage(ingest.route_frames(t.raw_trades().unionByName(t.raw_quotes())))
    parts = [ingest.malformed_frames(frames).withColumn("kind", F.lit("malformed"))]
    for kind, normalise in (("trade", ingest.normalise_trades),
                            ("bookTicker", ingest.normalise_quotes)):
        out = normalise(frames)
        parts.append(out.dead_letters.withColumn("kind", F.lit(kind)))
        parts.append(out.valid.select(
            F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("error_type"),
            F.col("ingested_at").alias("failed_at")))
    rows = parts[0].select("kind", "error_type", "failed_at")
    for part in parts[1:]:
        rows = rows.unionByName(part.select("kind", "error_type", "failed_at"))
    return present(telemetry.message_rates(rows, "failed_at", ["kind", "error_type"]))


def quarantine_check(spark, path) -> DataFrame:
    """Whether anything was quarantined in the day before each day of the tape's last week."""
    decoded = landing.decode(jobs._messages(tables(spark, path).read("events")), TRADE, VENUE)
    bad = stage(landing.quarantined(decoded).withColumn("_ingested_at", F.col("_kafka_timestamp")))
    days = [datetime(2024, 1, d) for d in range(25, 32)]
    out = None
    for day in days:
        row = quality.quarantine_empty(bad.filter(F.col("_ingested_at") < F.lit(day)), day, 24)
        row = row.withColumn("as_of", clock.built_at(day))
        out = row if out is None else out.unionByName(row)
    return present(out)


QUERIES = {
    f.__name__: f
    for f in (
        incremental_fact, lag_percentiles_rolled, kline_reconciliation_bucketed,
        market_fact_bucketed, stream_late_rows, message_outcomes, quarantine_check,
        instrument_scd2_incremental, instrument_scd2_incremental_changes,
        completeness_bitmap, backfill_bitmap,
    )
}
