"""Streams that keep state: replay removal, candles and update-id sequences.

The batch tables stay the source of truth (a bar is only emitted once the
watermark has passed it, and ``landing.late_rows`` counts what came after); these
serve readers that cannot wait for a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickhouse.operators import bar_states
from tickhouse.operators.bars import BAR_KEYS, bar_measures, with_bar_ratios
from tickhouse.operators.dedup import dedup
from tickhouse.operators.sequence import observe_sequence
from tickhouse.sources import tiers
from tickhouse.streaming.landing import start_batches

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State beyond executor memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def dedup_stream(
    rows: DataFrame, keys: Sequence[str], t: str = "event_time", delay: str = "1 hour"
) -> DataFrame:
    """First copy of each key. A key's state is dropped once the watermark passes it."""
    return rows.withWatermark(t, delay).dropDuplicatesWithinWatermark(list(keys))


def bars_stream(
    trades: DataFrame,
    seconds: int = 60,
    keys: Sequence[str] = ("exchange_id", "symbol"),
    t: str = "event_time",
) -> DataFrame:
    """Candles of a deduplicated, watermarked trade stream; append mode.

    The measures of the batch candles, but for those of landing and replays, which
    a deduplicated stream no longer knows.
    """
    measures = [m for m in bar_measures(t) if m[1] <= set(trades.columns)]
    grouped = trades.groupBy(F.window(t, f"{seconds} seconds"), *keys).agg(
        *[column for column, _ in measures]
    )
    bars = grouped.withColumns(
        {"bar_start": F.col("window.start"), "bar_end": F.col("window.end")}
    ).drop("window")
    return with_bar_ratios(bars)


def add_bar_states(
    trades: DataFrame,
    batch_id: int,
    states: tiers.Tiers,
    seen: tiers.Tiers,
    keys: Sequence[str],
    order: Sequence[str],
    seconds: int = 60,
    t: str = "event_time",
) -> None:
    """Fold a batch of trades into stored bar states, each trade once for ever.

    ``seen`` holds the keys of all trades so far; only the days that the batch falls
    in are read, however long ago they are, so a copy of a trade must carry its time.
    A batch replaces what it wrote before and looks at earlier batches alone, so
    repeating it changes nothing. Rows without a time are left out.
    """
    spark = trades.sparkSession
    once = dedup(trades.dropna(subset=[t]), keys, order, count_col=None).persist()
    try:
        days = [r[0] for r in once.select(F.to_date(t)).distinct().collect()]
        known = tiers.read(spark, seen, before=batch_id, days=days)
        fresh = once.join(known.select(*keys), list(keys), "left_anti")
        tiers.add(bar_states.fold(fresh, seconds, BAR_KEYS, t), states, batch_id)
        tiers.add(fresh, seen, batch_id)
    finally:
        once.unpersist()


def start_bar_states(
    trades: DataFrame,
    states: tiers.Tiers,
    seen: tiers.Tiers,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    seconds: int = 60,
    trigger_seconds: int | None = 60,
) -> StreamingQuery:
    """Candles of a stream of trades as stored states: no row is too late for its bar.

    Nothing is held in memory between batches. :func:`fold_bar_states` from time to
    time keeps the folders few; ``tiers.read`` and ``bar_states.finish`` give candles.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        add_bar_states(batch, batch_id, states, seen, keys, order, seconds)

    return start_batches(trades, write, checkpoint, trigger_seconds)


def fold_bar_states(
    spark: SparkSession, states: tiers.Tiers, seen: tiers.Tiers, through: int
) -> None:
    """Settle finished batches. States go first: a batch that is settled there may be
    repeated without effect, whatever its keys say."""
    tiers.fold(spark, states, through)
    tiers.fold(spark, seen, through)


def start_sequence(
    messages: DataFrame,
    key: Sequence[str],
    path: str,
    marks_path: str,
    checkpoint: str,
    id_col: str = "update_id",
    arrival: str = "kafka_offset",
    trigger_seconds: int | None = 60,
) -> StreamingQuery:
    """The batch sequence observation, micro-batch by micro-batch.

    The state is a table of the highest id per key, one folder a batch. A batch
    reads its predecessor's, puts the marks before its own rows as if they had
    arrived first, and replaces its two folders, so a repeated batch gives the same
    rows. Add a connection id to ``key`` for resets. The key is free to be hot: the
    batch operator cuts it into chunks.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*key, F.col(arrival).alias("arrival"), F.col(id_col).alias("update_id"))
        rows = rows.persist()
        try:
            # Partitioned parquet infers key types; the stored schema keeps them.
            marks = rows.limit(0) if batch_id == 0 else rows.sparkSession.read.schema(
                rows.schema).parquet(f"{marks_path}/batch_id={batch_id - 1}")
            seen = observe_sequence(
                rows.unionByName(marks), key, "update_id", ("arrival",),
                chunk=F.floor(F.col("arrival") / F.lit(100_000)),
            ).filter("arrival >= 0")
            seen.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            highest = rows.unionByName(marks).groupBy(*key).agg(F.max("update_id").alias("update_id"))
            highest.withColumn("arrival", F.lit(-1).cast("bigint")).select(
                *rows.columns).write.mode("overwrite").parquet(f"{marks_path}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return start_batches(messages, write, checkpoint, trigger_seconds)
