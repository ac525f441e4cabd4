"""Half-open validity intervals ``[from, to)``: re-bounding and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions import clock
from tickhouse.operators import Stage, keep_lazy
from tickhouse.operators.dedup import dedup
from tickhouse.operators.ordered import last_before, neighbours

DAY = 86_400
#: Chunks of a key that one task scans.
CHUNKS_TOGETHER = 1_024


def rebound_intervals(
    published: DataFrame,
    keys: Sequence[str],
    start: str = "valid_from",
    end: str = "valid_to",
    order: Sequence[str] = ("lake_ingested_at",),
    keep: str = "last",
    chunk_seconds: int = 30 * DAY,
    stage: Stage = keep_lazy,
) -> DataFrame:
    """Publications -> a series in which no interval overlaps its successor.

    Republished rows collapse to the latest copy. Each upper bound is taken from
    the next publication; the source's own bound is used only for the last one
    and kept as ``source_<end>``.
    """
    latest = stage(dedup(published, [*keys, start], order, keep=keep, count_col=None))
    followed = neighbours(
        latest, keys, [start], clock.bucket_id(F.col(start), chunk_seconds), lead={"__next": start}
    )
    source_end = f"source_{end}"
    return (
        followed.withColumnRenamed(end, source_end)
        .withColumn(end, F.coalesce("__next", source_end))
        .drop("__next")
        .withColumns(
            {
                "validity_days": clock.whole_days(F.col(start), F.col(end)),
                "was_rebounded": F.col(end) != F.col(source_end),
            }
        )
    )


def interval_join(
    left: DataFrame,
    intervals: DataFrame,
    t: str,
    start: str,
    end: str,
    on: Sequence[str] = (),
    how: str = "left",
    bucket_seconds: int = DAY,
    open_ends: bool = True,
) -> DataFrame:
    """Join each left row to the intervals that contain ``t``, by time bucket.

    A plain range condition plans as a nested loop. Here every interval is
    repeated for each bucket it touches, which turns the join into an equi-join
    on (keys, bucket) with the range left as a residual in the ON clause, so a
    left row without a match survives. Nothing is hinted: AQE broadcasts the
    interval side when its measured size allows and otherwise shuffles both
    sides, splitting a skewed bucket. Overlapping intervals give one output row
    each; a null key matches nothing. The interval side grows by its mean length
    in buckets; use :func:`asof_join` for very long intervals.

    An interval with a null end is open. Such intervals are laid out over the buckets
    that hold left rows of their key (without keys: over all up to the newest left row),
    so the keys and times of the left side are read once more. Where every interval is known to end, ``open_ends=False`` saves that,
    and an open one then is an error when the plan runs.
    """
    first = clock.bucket_id(F.col(start), bucket_seconds)
    last = clock.bucket_id(F.timestamp_micros(F.unix_micros(end) - 1), bucket_seconds)
    is_open = F.col(end).isNull() & F.col(start).isNotNull()
    here = [f"__r_{k}" for k in on]
    renamed = intervals.withColumnsRenamed({k: f"__r_{k}" for k in on})
    if open_ends:
        closed = renamed.filter(F.col(end) > F.col(start))
    else:
        unexpected = F.raise_error(F.lit(f"an interval without {end}: pass open_ends=True"))
        closed = renamed.filter(F.when(is_open, unexpected.cast("boolean"))
                                .otherwise(F.col(end) > F.col(start)))
    right = closed.withColumn("__bucket", F.explode(F.sequence(first, last)))
    probe = left.withColumn("__lbucket", clock.bucket_id(F.col(t), bucket_seconds))
    if open_ends:
        opened = renamed.filter(is_open)
        if on:
            held = probe.select(*[F.col(k).alias(r) for k, r in zip(on, here, strict=True)],
                                F.col("__lbucket").alias("__bucket")).dropna().distinct()
            opened = opened.withColumn("__first", first).join(held, here).filter(
                "__bucket >= __first").drop("__first")
        else:
            newest = probe.agg(F.max("__lbucket")).scalar()
            opened = opened.filter(first <= newest).withColumn(
                "__bucket", F.explode(F.sequence(first, newest)))
        right = right.unionByName(opened)
    condition = (
        (F.col("__lbucket") == F.col("__bucket"))
        & (F.col(t) >= F.col(start))
        & (F.col(end).isNull() | (F.col(t) < F.col(end)))
    )
    for k in on:
        condition = condition & (F.col(k) == F.col(f"__r_{k}"))
    return probe.join(right, condition, how).drop("__bucket", "__lbucket", *here)


def entering(
    left: DataFrame, began: DataFrame, on: Sequence[str], chunk: Column
) -> DataFrame:
    """What is in force when a chunk with left rows begins: (keys, __chunk, __r).

    ``left`` has the keys and ``__t``, ``began`` the keys, ``__t`` and ``__r``. Only
    chunks that hold left rows, and the last interval of chunks that hold any, are
    laid on the line, so it has no more rows than the two together; chunks in
    between, however many, have none. A key's chunks are scanned a thousand at a
    time, and thousands by their last intervals.
    """
    occupied = left.select(*on, chunk.alias("__at")).dropna().distinct()
    tails = began.withColumn("__at", chunk).groupBy(*on, "__at").agg(
        F.max_by("__r", "__t").alias("__tail"))
    # A chunk's own intervals come behind what enters it.
    line = occupied.withColumn("__own", F.lit(0)).unionByName(
        tails.withColumn("__own", F.lit(1)), allowMissingColumns=True)
    carried = last_before(
        line, on, ["__at", "__own"], F.floor(F.col("__at") / CHUNKS_TOGETHER), "__tail", "__r")
    return carried.filter("__own = 0 and __r is not null").select(
        *on, F.col("__at").alias("__chunk"), "__r")


def asof_join(
    left: DataFrame,
    intervals: DataFrame,
    t: str,
    start: str,
    end: str | None,
    on: Sequence[str] = (),
    how: str = "left",
    chunk_seconds: int = DAY,
    sparse: bool = False,
) -> DataFrame:
    """Join each left row to the latest interval that began at or before ``t``.

    For non-overlapping intervals this equals the interval join, needs no
    repetition of long intervals and accepts an open end (null). Both sides are
    laid on one timeline, cut into chunks of time, so a busy key is spread over its
    chunks; inside a chunk a window carries the interval forward. What a chunk
    begins with stands in front of it as one more row (:func:`entering`), for which
    the left side's keys and times are read a second time. No row is made for a
    chunk without left rows. A null key or a null ``t`` matches nothing.

    ``sparse`` says that few intervals begin in a chunk. The left rows then meet those
    and what enters the chunk in an equi-join on (keys, chunk), each by the range up to
    its successor: no row of the left side passes a window, a small interval side may
    be broadcast by its measured size, and a busy chunk may be split as a skewed join is.
    """
    if sparse:
        return _asof_sparse(left, intervals, t, start, end, on, how, chunk_seconds)
    lcols = left.columns
    rcols = [c for c in intervals.columns if c not in on]
    chunk = clock.bucket_id(F.col("__t"), chunk_seconds)
    began = intervals.dropna(subset=[*on, start]).select(
        *on, F.col(start).alias("__t"), F.struct(*rcols).alias("__r"))
    placed = left.select(*on, F.col(t).alias("__t"), F.struct(*lcols).alias("__l"))
    before = entering(placed, began, on, chunk)
    # In a chunk: what enters it (no time, so first), and at one time intervals first.
    timeline = (
        placed.withColumns({"__chunk": chunk, "__side": F.lit(1)})
        .unionByName(began.withColumns({"__chunk": chunk, "__side": F.lit(0)}),
                     allowMissingColumns=True)
        .unionByName(before.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    )
    within = (
        Window.partitionBy(*on, "__chunk")
        .orderBy(F.col("__t").asc_nulls_first(), "__side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = timeline.withColumn(
        "__hit", F.last("__r", ignorenulls=True).over(within)).filter("__side = 1")
    if end is not None:
        live = F.col(f"__hit.{end}").isNull() | (F.col("__t") < F.col(f"__hit.{end}"))
        carried = carried.withColumn("__hit", F.when(live, F.col("__hit")))
    if how == "inner":
        carried = carried.filter(F.col("__hit").isNotNull())
    return carried.select("__l.*", *[F.col(f"__hit.{c}").alias(c) for c in rcols])


def _asof_sparse(
    left: DataFrame, intervals: DataFrame, t: str, start: str, end: str | None,
    on: Sequence[str], how: str, chunk_seconds: int,
) -> DataFrame:
    rcols = [c for c in intervals.columns if c not in on]
    chunk = clock.bucket_id(F.col("__t"), chunk_seconds)
    began = neighbours(
        intervals.dropna(subset=[*on, start]).select(
            *on, F.col(start).alias("__t"), F.struct(*rcols).alias("__v")),
        on, ["__t"], chunk, lead={"__until": "__t"},
    ).select(*on, "__t", F.struct("__v", "__until").alias("__r"))
    before = entering(left.select(*on, F.col(t).alias("__t")), began, on, chunk)
    right = began.withColumn("__chunk", chunk).unionByName(
        before, allowMissingColumns=True).withColumnsRenamed({k: f"__r_{k}" for k in on})
    # What enters a chunk has no time of its own there; one value of a time is in force.
    at = F.col("__at")
    held = (
        (F.col("__lchunk") == F.col("__chunk"))
        & (F.col("__t").isNull() | (at >= F.col("__t")))
        & (F.col("__r.__until").isNull() | (at < F.col("__r.__until")))
    )
    for k in on:
        held = held & (F.col(k) == F.col(f"__r_{k}"))
    if end is not None:
        held = held & (F.col(f"__r.__v.{end}").isNull() | (at < F.col(f"__r.__v.{end}")))
    probe = left.withColumns(
        {"__at": F.col(t), "__lchunk": clock.bucket_id(F.col(t), chunk_seconds)})
    return probe.join(right, held, how).select(
        *left.columns, *[F.col(f"__r.__v.{c}").alias(c) for c in rcols])


def overlapping(intervals: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Intervals that extend past the start of their successor."""
    return neighbours(
        intervals,
        keys,
        [start],
        clock.bucket_id(F.col(start), 30 * DAY),
        lead={"next_valid_from": start},
    ).filter(F.col(end) > F.col("next_valid_from"))


def gaps(intervals: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Holes between one interval's end and its successor's start."""
    ahead = neighbours(
        intervals,
        keys,
        [start],
        clock.bucket_id(F.col(start), 30 * DAY),
        lead={"gap_ends_at": start},
    )
    return ahead.filter(F.col("gap_ends_at") > F.col(end)).select(
        *keys,
        F.col(end).alias("gap_starts_at"),
        "gap_ends_at",
        clock.whole_days(F.col(end), F.col("gap_ends_at")).alias("gap_days"),
    )
