"""Gold tables brought up to date by the bars that changed, however old they are.

What arrived in the lake since the last run names (instrument, bar) pairs. That set
goes down the chain as a semi-join: only those bars are built again from the tape,
only their facts and days are replaced. A fixed lookback would miss older rows and
rebuild many bars that nothing touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock
from tickhouse.operators import Stage
from tickhouse.operators.bars import BAR_KEYS
from tickhouse.operators.ordered import neighbours
from tickhouse.operators.quotes import with_durations

ARRIVED = "lake_ingested_at"


def dirty_bars(
    landed: DataFrame, since: datetime, seconds: int, t: str = "event_time",
    keys: Sequence[str] = BAR_KEYS, arrived: str = ARRIVED,
) -> DataFrame:
    """(keys, bar_start) of the rows that arrived after ``since``: one row a bar."""
    return landed.filter(F.col(arrived) > F.lit(since)).select(
        *keys, clock.bar_floor(F.col(t), seconds).alias("bar_start")).distinct()


def rows_of(
    rows: DataFrame, bars: DataFrame, seconds: int, t: str = "event_time",
    keys: Sequence[str] = BAR_KEYS,
) -> DataFrame:
    """Rows that fall into the given bars. Days of the bars prune a tape laid out by day
    where Spark can tell them before the scan."""
    marked = rows.withColumn("bar_start", clock.bar_floor(F.col(t), seconds))
    return marked.join(bars, [*keys, "bar_start"], "left_semi").drop("bar_start")


def changed_quote_bars(
    quotes: DataFrame, since: datetime, seconds: int, stage: Stage,
    keys: Sequence[str] = BAR_KEYS, chunk_seconds: int = 3_600, chunk_ids: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """(keys, bar_start) whose quote metrics change, and the quotes of those bars with
    their durations.

    Those are bars of quotes that are new, of quotes that a new one follows in time,
    which now prevail shorter, and of quotes that a new one precedes by id, between
    which less of the book was missed. ``quotes`` are free of copies. Four columns of
    theirs are put in order by time and by id; whole rows are read of changed bars only.
    """
    slim = stage(quotes.select(*keys, "event_time", "update_id",
                               (F.col(ARRIVED) > F.lit(since)).alias("is_new")))
    by_time = neighbours(
        slim, keys, ["event_time", "update_id"], clock.bucket_id(F.col("event_time"), chunk_seconds),
        lead={"__new": "is_new"})
    by_id = neighbours(
        slim, keys, ["update_id"], F.floor(F.col("update_id") / F.lit(chunk_ids)),
        lag={"__new": "is_new"})
    bar = clock.bar_floor(F.col("event_time"), seconds).alias("bar_start")
    bars = stage(by_time.unionByName(by_id).filter(
        F.col("is_new") | F.coalesce("__new", F.lit(False))).select(*keys, bar).distinct())
    timed = with_durations(slim.drop("is_new"), keys, chunk_seconds=chunk_seconds,
                           id_chunk=chunk_ids)
    held = rows_of(timed, bars, seconds, keys=keys).drop("event_time")
    return bars, rows_of(quotes, bars, seconds, keys=keys).join(held, [*keys, "update_id"])


def replaced(
    stored: DataFrame, fresh: DataFrame, gone: DataFrame, on: Sequence[str]
) -> DataFrame:
    """The stored rows but for the keys of ``gone``, with the fresh rows in their place."""
    return stored.join(gone.select(*on).distinct(), list(on), "left_anti").unionByName(
        fresh.select(*stored.columns))


def following(
    bars: DataFrame, dirty: DataFrame, keys: Sequence[str] = BAR_KEYS,
    chunk_seconds: int = 7 * 86_400,
) -> DataFrame:
    """The dirty bars and the bars right behind them, whose returns look back at one."""
    marked = bars.select(*keys, "bar_start").join(
        dirty.withColumn("__dirty", F.lit(True)), [*keys, "bar_start"], "left")
    behind = neighbours(
        marked, keys, ["bar_start"], clock.bucket_id(F.col("bar_start"), chunk_seconds),
        lag={"__was": "__dirty"})
    touched: Column = F.coalesce("__dirty", "__was", F.lit(False))
    return behind.filter(touched).select(*keys, "bar_start")
