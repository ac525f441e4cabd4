"""Slowly-changing history from repeated observations."""

from __future__ import annotations

from collections.abc import Sequence

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock
from tickhouse.operators import Stage, keep_lazy
from tickhouse.operators.dedup import dedup
from tickhouse.operators.ordered import neighbours

CHECK_COLS = ("status", "tick_size", "step_size", "min_notional")


def scd2(
    observations: DataFrame,
    key: Sequence[str] = ("symbol",),
    check_cols: Sequence[str] = CHECK_COLS,
    observed_at: str = "observed_at",
    tie_break: Sequence[str] = (),
    close_deletes: bool = True,
    chunk_seconds: int = 30 * 86_400,
    stage: Stage = keep_lazy,
) -> DataFrame:
    """Versions ``[valid_from, valid_to)`` of each key; an open version has a null end.

    A version starts where a checked value differs from the key's previous
    observation (the venue publishes no modification time, so values are
    compared). All observations taken at one ``observed_at`` form a batch; with
    ``close_deletes`` a key missing from the next batch closes there, and its
    reappearance starts a new version even with unchanged values.
    """
    order = [observed_at, *tie_break]
    latest = stage(dedup(observations, [*key, observed_at], order, keep="last", count_col=None))
    chunk = clock.bucket_id(F.col(observed_at), chunk_seconds)
    work = latest.withColumn("__state", F.struct(*check_cols))
    if close_deletes:
        batches = neighbours(
            latest.select(observed_at).distinct(), [], [observed_at], chunk,
            lead={"__next_batch": observed_at},
        )
        work = work.join(batches, observed_at, "left")
    else:
        work = work.withColumn("__next_batch", F.lit(None).cast("timestamp"))

    previous = neighbours(
        work, key, [observed_at], chunk,
        lag={"__was": "__state", "__due": "__next_batch", "__prev": observed_at},
    )
    begins = F.col("__prev").isNull() | ~F.col("__was").eqNullSafe(F.col("__state"))
    if close_deletes:
        begins = begins | (F.col("__due") != F.col(observed_at))
    # Read twice below (rows and chunk edges), behind one window pass.
    starts = stage(previous.filter(begins))

    # The end of a version is known at the start of the next one: the batch after
    # its last observation if deletes close it, else the next start itself.
    starts = starts.withColumn(
        "__ends_prev", F.col("__due") if close_deletes else F.col(observed_at)
    )
    versions = neighbours(starts, key, [observed_at], chunk, lead={"__end": "__ends_prev"})
    if close_deletes:
        last = work.groupBy(*key).agg(F.max_by("__next_batch", observed_at).alias("__closes"))
        versions = versions.join(last, list(key), "left")
        end = F.coalesce("__end", "__closes")
    else:
        end = F.col("__end")
    payload = [c for c in observations.columns if c not in (*key, observed_at, *tie_break)]
    return versions.select(
        *key,
        *payload,
        F.col(observed_at).alias("valid_from"),
        end.alias("valid_to"),
        end.isNull().alias("is_current"),
    )


LAST_SEEN = "last_seen"
_SINCE = "__since"


def scd2_step(
    open_versions: DataFrame,
    batch: DataFrame,
    last_poll: datetime | None,
    key: Sequence[str] = ("symbol",),
    check_cols: Sequence[str] = CHECK_COLS,
    observed_at: str = "observed_at",
    tie_break: Sequence[str] = (),
    close_deletes: bool = True,
    chunk_seconds: int = 30 * 86_400,
    stage: Stage = keep_lazy,
) -> DataFrame:
    """Open versions and newer observations -> versions that close, and those then open.

    What :func:`scd2` makes of all observations, from the open versions alone: each
    stands for its last observation, in which its values were the same, and keeps the
    time it began. Closed versions are never read again. With ``close_deletes`` a key
    was last seen at ``last_poll``, the newest ``observed_at`` before this batch (None
    for the first), or it would not be open. Observations must be newer than that, and
    without ``close_deletes`` newer than their key's version.

    ``open_versions`` has the key, the payload, ``valid_from`` and ``last_seen``; so
    has the result, with ``valid_to`` and ``is_current``.
    """
    payload = [c for c in batch.columns if c not in (*key, observed_at, *tie_break)]
    seeds = open_versions.select(
        *key, *payload, F.col(LAST_SEEN).alias(observed_at), F.col("valid_from").alias(_SINCE))
    rows = batch.withColumn(_SINCE, F.lit(None).cast("timestamp")).unionByName(
        seeds, allowMissingColumns=True)
    versions = scd2(rows, key, check_cols, observed_at, tie_break, close_deletes, chunk_seconds,
                    stage)
    # What is still open was seen at the newest poll; without polls its start will do.
    seen = F.col("valid_from")
    if close_deletes:
        newest = batch.agg(F.max(observed_at)).head()[0] or last_poll
        seen = F.lit(newest).cast("timestamp")
    return versions.withColumns({
        LAST_SEEN: F.when(F.col("is_current"), seen),
        "valid_from": F.coalesce(_SINCE, "valid_from"),
    }).drop(_SINCE)
