"""Data-quality checks as aggregates, and the invariants that return offending rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock, money
from tickhouse.functions.money import MONEY
from tickhouse.operators.dedup import grain_violations
from tickhouse.operators.ordered import neighbours

# Thresholds of the platform checks.
FRESH_SECONDS = 900
STALE_SECONDS = 3_600
VOLUME_BAND = (0.1, 10.0)
MIN_PASS_RATIO = 0.98
MAX_BAR_GAP_MINUTES = 5


@dataclass(frozen=True)
class Check:
    """A row-level rule: ``failing`` marks the rows that break it.

    ``severity="warn"`` never reports worse than ``warn``; otherwise more than
    ``error_above`` failing rows is an error, and any others a warning.
    """

    name: str
    failing: Column
    severity: str = "error"
    error_above: int = 0


def not_null(column: str, **kw) -> Check:
    return Check(f"not_null:{column}", F.col(column).isNull(), **kw)


def accepted_values(column: str, values: Sequence, **kw) -> Check:
    """Nulls pass; pair with :func:`not_null` where they should not."""
    return Check(f"accepted_values:{column}", ~F.col(column).isin(list(values)), **kw)


def in_range(column: str, low=None, high=None, strictly: bool = False, **kw) -> Check:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | ((c <= low) if strictly else (c < low))
    if high is not None:
        bad = bad | ((c >= high) if strictly else (c > high))
    return Check(f"in_range:{column}", bad, **kw)


def holds(name: str, condition: Column, **kw) -> Check:
    return Check(f"holds:{name}", ~condition, **kw)


def _status(failing: Column, severity: Column | str, error_above: Column | int) -> Column:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return (
        F.when(failing <= 0, "pass")
        .when((severity == "error") & (failing > error_above), "error")
        .otherwise("warn")
    )


def run_checks(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """All row-level rules of a table in one scan: one output row per check."""
    failed = [F.count_if(F.coalesce(c.failing, F.lit(False))).alias(f"__{i}")
              for i, c in enumerate(checks)]
    once = df.agg(F.count(F.lit(1)).alias("total_rows"), *failed)
    cells = F.array(*[
        F.struct(
            F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"),
            F.lit(c.error_above).alias("error_above"), F.col(f"__{i}").alias("failing_rows"),
        )
        for i, c in enumerate(checks)
    ])
    return once.select("total_rows", F.inline(cells)).select(
        F.lit(table).alias("table_name"), "check_name", "failing_rows", "total_rows", "severity",
        _status(F.col("failing_rows"), F.col("severity"), F.col("error_above")).alias("status"),
    )


def _single(table: str, name: str, counted: DataFrame, severity: str, error_above: int = 0):
    """A check row from a one-row frame with ``failing_rows`` and ``total_rows``."""
    return counted.select(
        F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), "failing_rows",
        "total_rows", F.lit(severity).alias("severity"),
        _status(F.col("failing_rows"), severity, error_above).alias("status"),
    )


def check_unique(df: DataFrame, keys: Sequence[str], table: str, severity: str = "error"):
    """Failing rows are keys that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.agg(
        F.count_if(F.col("n") > 1).alias("failing_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
    )
    return _single(table, f"unique:{'+'.join(keys)}", counted, severity)


def check_relationship(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str, table: str,
    severity: str = "error",
) -> DataFrame:
    """Failing rows are non-null values of ``column`` that the parent does not hold.

    Values are counted before the join, so it runs over distinct values.
    """
    known = parent.select(F.col(parent_column).alias(column)).distinct().withColumn(
        "__known", F.lit(True)
    )
    values = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counted = values.join(known, column, "left").agg(
        F.coalesce(
            F.sum(F.when(F.col("__known").isNull() & F.col(column).isNotNull(), F.col("n"))),
            F.lit(0),
        ).alias("failing_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
    )
    return _single(table, f"relationship:{column}", counted, severity)


def check_row_count(df: DataFrame, table: str, low: int = 1, high: int | None = None,
                    severity: str = "warn") -> DataFrame:
    n = F.count(F.lit(1))
    outside = n < low if high is None else (n < low) | (n > high)
    counted = df.agg(outside.cast("bigint").alias("failing_rows"), n.alias("total_rows"))
    return _single(table, "row_count", counted, severity)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows behind a failure, ready to be stored for inspection."""
    return df.filter(F.coalesce(check.failing, F.lit(False))).withColumn(
        "_check_name", F.lit(check.name)
    )


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


# -- invariants that return offending rows ---------------------------------------------


def bar_gaps(
    fact: DataFrame, keys: Sequence[str] = ("exchange_id", "symbol"), since=None,
    max_gap_minutes: int = MAX_BAR_GAP_MINUTES,
) -> DataFrame:
    """Bars whose successor is more than ``max_gap_minutes`` away."""
    recent = fact if since is None else fact.filter(F.col("bar_start") >= F.lit(since))
    ahead = neighbours(
        recent.select(*keys, "bar_start"), keys, ["bar_start"],
        clock.bucket_id(F.col("bar_start"), 7 * 86_400), lead={"next_bar_start": "bar_start"},
    )
    gap = clock.minutes_between(F.col("bar_start"), F.col("next_bar_start"))
    return ahead.withColumn("gap_minutes", gap).filter(
        F.col("gap_minutes") > max_gap_minutes
    ).withColumnRenamed("bar_start", "gap_after")


def off_tick(trades: DataFrame, reference: DataFrame, since=None) -> DataFrame:
    """Trades whose price is not a whole multiple of the instrument's tick size."""
    recent = trades if since is None else trades.filter(F.col("event_time") >= F.lit(since))
    grid = reference.select("symbol", "tick_size")
    # Both have 18 decimals, which a remainder keeps.
    remainder = F.col("price").cast(MONEY) % F.col("tick_size").cast(MONEY)
    return (
        recent.select("symbol", "trade_id", "price", "event_time")
        .join(grid, "symbol")
        .withColumn("grid_remainder", remainder)
        .filter(F.col("grid_remainder") != 0)
    )


def join_multiplication(silver: DataFrame, gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose row count differs between a table and the fact built from it.

    Both counts, 0 where a side has no row, and the rows that the fact has too many
    (above zero: the join multiplied) or too few (below: rows were lost).
    """
    sides = silver.select(*keys, F.lit(1).alias("__s"), F.lit(0).alias("__g")).unionByName(
        gold.select(*keys, F.lit(0).alias("__s"), F.lit(1).alias("__g"))
    )
    counted = sides.groupBy(*keys).agg(
        F.sum("__s").alias("rows_expected"), F.sum("__g").alias("rows_found")
    )
    surplus = F.col("rows_found") - F.col("rows_expected")
    return counted.withColumn("surplus", surplus).filter("surplus <> 0")


# -- platform checks -------------------------------------------------------------------


def freshness(
    df: DataFrame, t: str, as_of: datetime, table: str,
    warn_seconds: int = FRESH_SECONDS, error_seconds: int = STALE_SECONDS,
) -> DataFrame:
    """Age of the newest event. An empty table is an error, not a pass."""
    latest = df.agg(F.max(t).alias("latest"))
    now = F.unix_seconds(F.lit(as_of).cast("timestamp"))
    age = now - F.unix_seconds("latest")
    return latest.select(
        F.lit(table).alias("table_name"), "latest", age.alias("age_seconds"),
        F.when(F.col("latest").isNull() | (age > error_seconds), "error")
        .when(age > warn_seconds, "warn").otherwise("pass").alias("status"),
    )


def volume_baseline(trades: DataFrame, as_of: datetime, t: str = "event_time") -> DataFrame:
    """The last complete hour against the median of the same hour on earlier days.

    The newest hour is still filling, so the one before it is judged; with no
    history to compare with the check passes.
    """
    floor = F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 8 DAYS")
    hourly = (
        trades.filter(F.col(t) >= floor)
        .groupBy(F.date_trunc("hour", t).alias("hour_start"))
        .agg(F.count(F.lit(1)).alias("trades"))
        .withColumn("hour_of_day", F.hour("hour_start"))
    )
    judged = hourly.orderBy(F.col("hour_start").desc()).offset(1).limit(1)
    earlier = hourly.select("hour_of_day", F.col("hour_start").alias("__h"),
                            F.col("trades").alias("__n"))
    paired = judged.join(earlier, "hour_of_day", "left").withColumn(
        "__n", F.when(F.col("__h") < F.col("hour_start"), F.col("__n"))
    )
    median = paired.groupBy("hour_start", "trades").agg(
        F.percentile_approx("__n", 0.5, 10_000).alias("baseline_median")
    )
    ratio = money.ratio(F.col("trades"), F.col("baseline_median"))
    low, high = VOLUME_BAND
    return median.withColumn("volume_ratio", ratio).withColumn(
        "passed", F.coalesce(F.col("volume_ratio").between(low, high), F.lit(True))
    )


def reconciliation_pass(reconciled: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Share of compared bars that agree with the venue; passes when none were compared."""
    floor = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    counted = reconciled.filter(F.col("bar_start") >= floor).agg(
        F.count(F.lit(1)).alias("minutes_compared"),
        F.count_if(F.col("reconciliation_status") == "ok").alias("minutes_matched"),
        F.max("volume_rel_diff").alias("worst_volume_rel_diff"),
    )
    return counted.withColumn(
        "pass_ratio", money.ratio(F.col("minutes_matched"), F.col("minutes_compared"))
    ).withColumn("passed", F.coalesce(F.col("pass_ratio") >= MIN_PASS_RATIO, F.lit(True)))


def quarantine_empty(quarantine: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    floor = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    return quarantine.filter(F.col("_ingested_at") >= floor).agg(
        F.count(F.lit(1)).alias("quarantined"), (F.count(F.lit(1)) == 0).alias("passed")
    )


def instrument_anomalies(dim: DataFrame) -> DataFrame:
    """Instruments that are not ``ok``; a tracked one that never arrived is an error."""
    severity = F.when(F.col("coverage_status") == "tracked_but_absent", "error").otherwise("warn")
    return dim.filter("coverage_status <> 'ok'").select(
        "symbol", "coverage_status", severity.alias("severity")
    )


__all__ = [
    "Check", "accepted_values", "bar_gaps", "check_relationship", "check_row_count",
    "check_unique", "failing_rows", "freshness", "grain_violations", "holds", "in_range",
    "instrument_anomalies", "join_multiplication", "not_null", "off_tick", "orphans",
    "quarantine_empty", "reconciliation_pass", "run_checks", "volume_baseline",
]
