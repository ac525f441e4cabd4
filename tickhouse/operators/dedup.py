"""Collapse replays to one row per natural key."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.operators import Stage

_HASH, _ROW = "__hash", "__row"


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep: str = "first",
    count_col: str | None = "_duplicate_count",
    stage: Stage | None = None,
) -> DataFrame:
    """One row per ``keys``: the first (or last) by ``order``, with the number of copies.

    An aggregate rather than ``row_number``: the map side already folds the
    copies of a key, so a replay storm on one key never reaches a single task,
    and the copy count comes out of the same shuffle.

    An immutable event keeps its first observation (a later copy is a replay,
    and keeping it would inflate the measured lag); a correctable publication
    keeps its last.

    With ``stage`` only what repeats is brought together: see :func:`_repeats_alone`.
    Few copies are the usual case, and then no whole row is shuffled or sorted. ``df``
    is read three times, of which once for its keys alone, so it should be cheap to
    read again: a stored table and columns on it.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    if stage is not None:
        return _repeats_alone(df, keys, order, keep, count_col, stage)
    return _folded(df, keys, order, keep, count_col)


def _folded(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str, count_col: str | None
) -> DataFrame:
    """All rows through one aggregate that carries whole rows."""
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in df.columns if c not in keys]
    aggs = [pick(F.struct(*rest), F.struct(*order)).alias(_ROW)]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(
        *[F.col(c) if c in keys else F.col(f"{_ROW}.{c}").alias(c) for c in df.columns],
        *([count_col] if count_col else []),
    )


def _repeats_alone(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep: str,
    count_col: str | None,
    stage: Stage,
) -> DataFrame:
    """Rows whose key comes once go through untouched; the others are settled apart.

    A first pass counts 64-bit hashes of keys and stores those seen twice or more: of
    its stored size the planner sees whether it can be sent to every task or has to be
    joined by shuffle. Two keys of one hash only put more rows among the repeats, so
    the result is exact. The repeats are numbered and stored; an aggregate of numbers
    (the row's, the order's and the count: a hash table, no sort) picks one each, and
    its row is fetched by number. Where the order is not numbers, their rows are folded
    as a whole.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    again = stage(hashed.groupBy(_HASH).count().filter("count > 1").select(_HASH))
    single = hashed.join(again, _HASH, "left_anti").drop(_HASH)
    repeated = hashed.join(again, _HASH, "left_semi").drop(_HASH)
    if count_col:
        single = single.withColumn(count_col, F.lit(1).cast("bigint"))
    place = _as_number(df, order)
    if place is None:
        return single.unionByName(_folded(repeated, keys, order, keep, count_col))
    numbered = stage(repeated.withColumn(_ROW, F.monotonically_increasing_id()))
    pick = F.min_by if keep == "first" else F.max_by
    chosen = numbered.groupBy(*keys).agg(
        pick(_ROW, place).alias(_ROW), F.count(F.lit(1)).alias("__copies")
    ).select(_ROW, "__copies")
    settled = numbered.join(chosen, _ROW).select(
        *df.columns, *([F.col("__copies").alias(count_col)] if count_col else []))
    return single.unionByName(settled)


def _as_number(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One decimal that sorts as up to two columns do, nulls first; None if they are no
    integers or times.

    A time takes 18 digits and a sign; any 64-bit number behind it, and null, have a
    place among 20 digits.
    """
    times, whole = (T.TimestampType, T.TimestampNTZType), (T.LongType, T.IntegerType)
    kinds = [df.schema[c].dataType for c in order]
    if not kinds or len(kinds) > 2 or not isinstance(kinds[-1], times + whole):
        return None
    if len(kinds) == 2 and not isinstance(kinds[0], times):
        return None

    def digits(name: str, kind: T.DataType) -> Column:
        c = F.col(name)
        if isinstance(kind, times):
            c = F.unix_micros(c.cast("timestamp"))
        return c.cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1)).cast("decimal(20,0)")

    last = F.coalesce(digits(order[-1], kinds[-1]), F.lit(0)).cast("decimal(38,0)")
    if len(kinds) == 1:
        return last
    # Times reach 2.6e17 microseconds either way, so the product has 38 digits at most.
    first = F.coalesce(F.unix_micros(F.col(order[0]).cast("timestamp")), F.lit(-(10**18) + 1))
    return (first.cast("decimal(18,0)") * F.lit(Decimal(2 * 10**19)).cast("decimal(20,0)")
            + last).cast("decimal(38,0)")


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
