"""Tables that batches add to: open batch folders, and a settled table by day.

A stream's batch owns a folder ``batch_id=N`` and replaces it when it is repeated.
Such folders are many and small. :func:`fold` brings those of closed batches, in the
order of their numbers, into the day and bucket partitions of a settled table, whose
rows say up to which batch their partition is folded. That number decides everything
else: a batch's rows count where it is greater than its partition's, and nowhere
besides. So a fold that stops half-way, a fold that is run again and a batch that is
written again after it was folded all leave one copy, and a reader at any moment sees
settled and open rows as one table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.sources.writers import (
    MAX_RECORDS_PER_FILE,
    Layout,
    exists,
    in_partitions,
    replace_partitions,
    subfolders,
)

THROUGH = "folded_through"
_BATCH = T.StructField("batch_id", T.LongType())


@dataclass(frozen=True)
class Tiers:
    """Where the two parts of a table lie, the layout of the settled one, and its columns.

    ``merge`` folds rows of one key into one, if they are partial aggregates: of rows
    and results of earlier merges it makes what it would make of all rows at once.
    """

    open_path: str
    settled_path: str
    layout: Layout
    schema: T.StructType
    merge: Callable[[DataFrame], DataFrame] | None = None


def add(rows: DataFrame, table: Tiers, batch_id: int) -> None:
    """A batch's rows, in place of what the batch wrote before."""
    placed = rows.select(*table.schema.names).withColumn(
        "dt", table.layout.date_of(F.col(table.layout.time_col)))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "dt").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option(
        "compression", "zstd").parquet(f"{table.open_path}/batch_id={batch_id}")


def _open(spark: SparkSession, table: Tiers) -> DataFrame:
    schema = T.StructType([*table.schema, _BATCH, T.StructField("dt", T.DateType())])
    if not exists(spark, table.open_path):
        return table.layout.with_bucket(spark.createDataFrame([], schema))
    rows = spark.read.schema(schema).parquet(table.open_path)
    # dt is kept as read, so that a condition on it prunes folders.
    return table.layout.with_bucket(rows)


def _settled(spark: SparkSession, table: Tiers) -> DataFrame:
    parts = [table.layout.partition_types()[c] for c in table.layout.derived_cols]
    schema = T.StructType([*table.schema, T.StructField(THROUGH, T.LongType()), *parts])
    if not exists(spark, table.settled_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(table.settled_path)


def _unfolded(open_rows: DataFrame, settled: DataFrame, table: Tiers) -> DataFrame:
    """Open rows that their partition does not hold yet.

    The numbers of the partitions are one row each: days times buckets.
    """
    parts = table.layout.partition_cols
    marks = settled.groupBy(*parts).agg(F.max(THROUGH).alias(THROUGH)).withColumnsRenamed(
        {c: f"__{c}" for c in parts})
    same = F.lit(True)
    for c in parts:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return (
        open_rows.join(marks, same, "left")
        .filter(F.col("batch_id") > F.coalesce(THROUGH, F.lit(-1)))
        .drop(THROUGH, *[f"__{c}" for c in parts])
    )


def read(
    spark: SparkSession,
    table: Tiers,
    before: int | None = None,
    days: Sequence[date] | None = None,
) -> DataFrame:
    """Settled and open rows as one table, partition columns included.

    ``before`` leaves out open batches from that number on: what a batch saw that is
    written once more. ``days`` names the partitions to read.
    """
    settled, pending = _settled(spark, table), _open(spark, table)
    if before is not None:
        pending = pending.filter(F.col("batch_id") < before)
    if days is not None:
        named = in_partitions(["dt"], {(d,) for d in days})
        settled, pending = settled.filter(named), pending.filter(named)
    fresh = _unfolded(pending, settled, table).drop("batch_id")
    whole = settled.drop(THROUGH).unionByName(fresh)
    if table.merge is None:
        return whole
    return table.layout.placed(table.merge(table.layout.drop_derived(whole)))


def fold(spark: SparkSession, table: Tiers, through: int) -> int:
    """Bring the batches up to ``through`` into the settled table; partitions written.

    ``through`` is a batch that is finished, as are all before it. Only partitions
    that receive rows are rewritten. Their names pass through the driver: days times
    buckets. Open folders go when their rows are committed.
    """
    parts = table.layout.partition_cols
    pending = _open(spark, table).filter(F.col("batch_id") <= through)
    settled = _settled(spark, table)
    fresh = _unfolded(pending, settled, table)
    touched = {tuple(r) for r in fresh.select(*parts).distinct().collect()}
    if touched:
        old = settled.filter(in_partitions(parts, touched)).drop(THROUGH)
        rows = table.layout.drop_derived(old.unionByName(fresh.drop("batch_id")))
        if table.merge is not None:
            rows = table.merge(rows)
        replace_partitions(
            rows.select(*table.schema.names).withColumn(THROUGH, F.lit(through).cast("bigint")),
            table.settled_path, table.layout)
    for name, remove in subfolders(spark, table.open_path):
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= through:
            remove()
    return len(touched)
