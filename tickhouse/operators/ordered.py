"""Order-sensitive operators that do not put one key into one task.

A plain ``lead``/``lag`` partitioned by symbol sorts each symbol in a single
task, and a handful of symbols carry most of a tape. Here each key is cut into
*chunks*: ranges of the leading sort column (an hour, a day, a span of ids). The
window runs inside (key, chunk). What crosses a chunk's border comes from a small
table of one row per (key, chunk), built with partial aggregation, whose rows are
put into the chunk before the first or behind the last row: the window sees them
as neighbours. So the tape is shuffled once and joined with nothing, and rows whose
key is null are one key here, as they are to a plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK, _SIDE = "__chunk", "__side"
# Places of a border's row in its chunk, and of the chunk's own rows.
_FIRST, _OWN, _LAST = -1, 0, 1


def _edge(value: str, order: Sequence[str], last: bool) -> Column:
    """First or last ``value`` of a chunk, cheaply when it is the sort column itself."""
    if value == order[0]:
        return F.struct((F.max if last else F.min)(value).alias("v"))
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return F.struct((F.max_by if last else F.min_by)(value, by).alias("v"))


def _bordered(base: DataFrame, edges: DataFrame, sides: Sequence[int]) -> DataFrame:
    """The rows of all chunks, with a row of ``edges`` at the given sides of each."""
    placed = edges.withColumn(_SIDE, F.explode(F.array(*[F.lit(s) for s in sides])))
    return base.withColumn(_SIDE, F.lit(_OWN)).unionByName(placed, allowMissingColumns=True)


def _within(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, _CHUNK).orderBy(_SIDE, *order)


def _across(keys: Sequence[str]):
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy(_CHUNK)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    lead: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    edges_from: DataFrame | None = None,
) -> DataFrame:
    """Add next-row (``lead``) and previous-row (``lag``) values, ``{new name: column}``.

    ``chunk`` must be a non-decreasing function of ``order[0]``, and ``order``
    must be a total order within ``keys``. ``edges_from`` names a cheaper frame
    with the same rows to read the chunk edges from, when ``df`` is already the
    product of windows.
    """
    lead, lag = dict(lead or {}), dict(lag or {})
    base = df.withColumn(_CHUNK, chunk)
    source = base if edges_from is None else edges_from.withColumn(_CHUNK, chunk)
    # A one-field struct tells "no neighbour" from "neighbour is null".
    edges = source.groupBy(*keys, _CHUNK).agg(
        *[_edge(c, order, last=False).alias(f"__e_{n}") for n, c in lead.items()],
        *[_edge(c, order, last=True).alias(f"__e_{n}") for n, c in lag.items()],
    )
    edges = edges.select(
        *keys,
        _CHUNK,
        *[F.lead(f"__e_{n}").over(_across(keys)).alias(f"__e_{n}") for n in lead],
        *[F.lag(f"__e_{n}").over(_across(keys)).alias(f"__e_{n}") for n in lag],
    )
    sides = ([_FIRST] if lag else []) + ([_LAST] if lead else [])

    def seen(name: str, column: str) -> Column:
        own = F.struct(F.col(column).alias("v"))
        return F.when(F.col(_SIDE) == _OWN, own).otherwise(F.col(f"__e_{name}"))

    within = _within(keys, order)
    return (
        _bordered(base, edges, sides)
        .withColumns(
            {f"__n_{n}": F.lead(seen(n, c)).over(within) for n, c in lead.items()}
            | {f"__n_{n}": F.lag(seen(n, c)).over(within) for n, c in lag.items()}
        )
        .filter(F.col(_SIDE) == _OWN)
        .select(*df.columns, *[F.col(f"__n_{n}")["v"].alias(n) for n in (*lead, *lag)])
    )


def running_max_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    value: str,
    out: str,
) -> DataFrame:
    """Maximum of ``value`` over all earlier rows of the key; null on the first row."""
    base = df.withColumn(_CHUNK, chunk)
    earlier = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        base.groupBy(*keys, _CHUNK)
        .agg(F.max(value).alias("__top"))
        .select(*keys, _CHUNK, F.max("__top").over(earlier).alias("__e"))
    )
    within = _within(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        _bordered(base, edges, [_FIRST])
        .withColumn(out, F.max(F.coalesce("__e", value)).over(within))
        .filter(F.col(_SIDE) == _OWN)
        .select(*[c for c in df.columns if c != out], out)
    )


def last_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    value: str,
    out: str,
) -> DataFrame:
    """The last ``value`` that is not null among all earlier rows of the key."""
    base = df.withColumn(_CHUNK, chunk)
    earlier = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    # Rows without a value have no place in the order of values; a chunk of such rows
    # alone has a null tail and still needs what came before it.
    edges = (
        base.groupBy(*keys, _CHUNK)
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), by)).alias("__tail"))
        .select(*keys, _CHUNK, F.last("__tail", ignorenulls=True).over(earlier).alias("__e"))
    )
    within = _within(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        _bordered(base, edges, [_FIRST])
        .withColumn(out, F.last(F.coalesce("__e", value), ignorenulls=True).over(within))
        .filter(F.col(_SIDE) == _OWN)
        .select(*[c for c in df.columns if c != out], out)
    )
