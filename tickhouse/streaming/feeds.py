"""The landed tables: what is read, how it is laid out, and the jobs that keep them.

A feed's messages land in a folder per batch, good rows and quarantine from one read
of the source, and are folded into the settled part by day (or month) and bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickhouse.schemas import RECORDS, VENUE, landed
from tickhouse.sources import tiers
from tickhouse.sources.writers import Layout
from tickhouse.streaming import landing


@dataclass(frozen=True)
class Feed:
    """One kind of message. ``max_offsets`` bounds a trigger; without ``trigger_seconds``
    the job drains what is there and stops."""

    kind: str
    table: str
    layout: Layout
    max_offsets: int = 500_000
    trigger_seconds: int | None = 60

    @property
    def schema(self) -> T.StructType:
        return RECORDS[self.kind]

    def tiers(self, root: str) -> tiers.Tiers:
        return tiers.Tiers(f"{root}/{self.table}/open", f"{root}/{self.table}/settled",
                           self.layout, landed(self.kind))

    def quarantine(self, root: str) -> str:
        return f"{root}/quarantine/{self.table}"


# Grain and buckets of the landed tables, and their triggers. Rates are
# few; a month is the least that Spark can replace of a table by itself.
FEEDS = {
    f.kind: f for f in (
        Feed("trade", "trades",
             Layout("trade_time", buckets=16, sort=("symbol", "trade_time", "trade_id"))),
        Feed("quote", "book_ticker",
             Layout("event_time", buckets=16, sort=("symbol", "event_time", "update_id")),
             max_offsets=2_000_000),
        Feed("kline", "klines",
             Layout("open_time", grain="month", by=("interval",), sort=("symbol", "open_time")),
             trigger_seconds=None),
        Feed("fx_rate", "fx_rates",
             Layout("valid_from", grain="month", sort=("source", "valid_from")),
             trigger_seconds=None),
    )
}


def land_batch(decoded: DataFrame, batch_id: int, feed: Feed, root: str) -> None:
    """Both outputs of one batch, in place of what the batch wrote before."""
    decoded.persist()
    try:
        tiers.add(landing.landed(decoded), feed.tiers(root), batch_id)
        landing.quarantined(decoded).write.mode("overwrite").parquet(
            f"{feed.quarantine(root)}/batch_id={batch_id}")
    finally:
        decoded.unpersist()


def start(
    messages: DataFrame,
    feed: Feed,
    root: str,
    checkpoint: str,
    source: str = VENUE,
    framed: bool = True,
    drain: bool = False,
) -> StreamingQuery:
    """Land a feed's messages, at its own pace or (``drain``) until none is left."""
    decoded = landing.decode(messages, feed.schema, source, framed)
    return landing.start_batches(
        decoded, lambda batch, batch_id: land_batch(batch, batch_id, feed, root), checkpoint,
        None if drain else feed.trigger_seconds, name=f"land-{feed.table}-{abs(hash(root))}")


def settle(spark: SparkSession, feeds: Sequence[Feed], root: str, through: int) -> dict[str, str]:
    """Fold the finished batches of several tables; a failure is noted and the next goes on."""
    done = {}
    for feed in feeds:
        try:
            done[feed.table] = f"{tiers.fold(spark, feed.tiers(root), through)} partitions"
        except Exception as exc:  # noqa: BLE001 - isolation between tables is the point
            done[feed.table] = f"{type(exc).__name__}: {exc}"
    return done
