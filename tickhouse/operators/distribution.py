"""Exact distributions that can be stored and merged: how often each value occurs.

A state has one row per (keys, bar, value). States of parts add up to the state of the
whole, and those of hours to those of days, so exact quantiles of any span follow
without a second look at the rows. Whole milliseconds have few values an hour.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions import clock


def counts(rows: DataFrame, keys: Sequence[str], t: str, value: str, seconds: int = 3_600) -> DataFrame:
    """(keys, bar_start, value, n) of whole numbers. Nulls and rows without a time are no part."""
    start = clock.bar_floor(F.col(t), seconds).alias("bar_start")
    return rows.dropna(subset=[t, value]).groupBy(
        *keys, start, F.col(value).cast("bigint").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))


def merge(states: DataFrame, keys: Sequence[str], start: Column | None = None) -> DataFrame:
    """States of the same values as one, per bar or per ``start`` (a coarser bar)."""
    at = F.col("bar_start") if start is None else start
    return states.groupBy(*keys, at.alias("bar_start"), "value").agg(F.sum("n").alias("n"))


def quantiles(
    states: DataFrame, keys: Sequence[str], shares: Mapping[str, float], span: int = 1_024
) -> DataFrame:
    """Per (keys, bar_start): rows, the greatest value, and for each name the least value
    that its share of the rows does not exceed.

    ``states`` are merged. Values are summed up inside chunks of ``span`` values, and
    chunks among each other, so a group of very many values is no task's alone.
    """
    by = [*keys, "bar_start"]
    chunked = states.withColumn("__chunk", F.floor(F.col("value") / F.lit(span)))
    totals = chunked.groupBy(*by, "__chunk").agg(F.sum("n").alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__chunk")
    edges = totals.select(
        *by, "__chunk",
        (F.sum("__n").over(earlier) - F.col("__n")).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*by)).alias("__all"))
    # A chunk's row stands before its values: the sum up to a value then counts what is
    # below the chunk too, and no join is needed.
    placed = chunked.unionByName(
        edges.withColumn("value", F.lit(None).cast("bigint")).withColumn("n", F.col("__before"))
        .drop("__before"), allowMissingColumns=True)
    inside = Window.partitionBy(*by, "__chunk").orderBy(F.col("value").asc_nulls_first())
    summed = placed.select(
        *by, "value", "n", F.sum("n").over(inside.rowsBetween(
            Window.unboundedPreceding, Window.currentRow)).alias("__upto"),
        F.max("__all").over(Window.partitionBy(*by, "__chunk")).alias("__rows")
    ).filter("value is not null")
    found = summed.groupBy(*by).agg(
        F.sum("n").alias("observations"), F.max("value").alias("max_value"),
        *[F.min(F.when(F.col("__upto") >= F.greatest(
            F.ceil(F.col("__rows") * F.lit(share)), F.lit(1)), F.col("value"))).alias(name)
          for name, share in shares.items()])
    return found
