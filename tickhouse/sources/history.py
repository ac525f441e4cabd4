"""A stored history that grows by batches of observations.

Two folders a batch: versions that it closed, and all that are open after it. A
batch reads the open versions of its predecessor, never the closed ones, and
replaces its own two folders, so repeating it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.operators import Stage
from tickhouse.operators.scd import LAST_SEEN, scd2_step
from tickhouse.sources.writers import exists

_CLOSED, _OPEN = "closed", "open"


def _schema(batch: DataFrame, key, observed_at: str, tie_break) -> T.StructType:
    fields = [f for f in batch.schema if f.name not in (*key, observed_at, *tie_break)]
    at = [T.StructField(c, T.TimestampType()) for c in ("valid_from", "valid_to", LAST_SEEN)]
    return T.StructType([*[batch.schema[k] for k in key], *fields, *at,
                         T.StructField("is_current", T.BooleanType())])


def add(
    batch: DataFrame,
    batch_id: int,
    root: str,
    stage: Stage,
    key: tuple[str, ...] = ("symbol",),
    observed_at: str = "observed_at",
    tie_break: tuple[str, ...] = (),
    close_deletes: bool = True,
    **options,
) -> None:
    """Bring a batch of observations into the history. Batches are numbered from 0.

    Observations that are not newer than what they follow are an error: such a batch
    calls for a rebuild from all observations.
    """
    spark = batch.sparkSession
    schema = _schema(batch, key, observed_at, tie_break)
    before = f"{root}/{_OPEN}/batch_id={batch_id - 1}"
    if batch_id and not exists(spark, before):
        raise ValueError(f"batch {batch_id - 1} has not been added")
    opened = spark.read.schema(schema).parquet(before) if batch_id else spark.createDataFrame(
        [], schema)
    last_poll = opened.agg(F.max(LAST_SEEN)).head()[0]
    # Whole batches are newer as a rule; only if their times overlap are keys compared.
    oldest = batch.agg(F.min(observed_at)).head()[0] if last_poll else None
    if oldest is None or oldest > last_poll:
        late = None
    elif close_deletes:
        late = batch.filter(F.col(observed_at) <= F.lit(last_poll))
    else:
        began = opened.select(*key, F.col(LAST_SEEN).alias("__began"))
        late = batch.join(began, list(key)).filter(F.col(observed_at) <= F.col("__began"))
    if late is not None and not late.isEmpty():
        raise ValueError("observations are older than the history; rebuild it")
    versions = stage(scd2_step(
        opened, batch, last_poll, key, observed_at=observed_at, tie_break=tie_break,
        close_deletes=close_deletes, stage=stage, **options).select(*schema.names))
    for name, rows in ((_CLOSED, versions.filter("not is_current")),
                       (_OPEN, versions.filter("is_current"))):
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")


def read(spark: SparkSession, root: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The history after a batch: what has closed up to it, and what it left open.

    ``schema`` names the columns to read, of the key, the payload, valid_from,
    valid_to and is_current.
    """
    with_batch = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    closed = spark.read.schema(with_batch).parquet(f"{root}/{_CLOSED}").filter(
        F.col("batch_id") <= batch_id).drop("batch_id")
    return closed.unionByName(
        spark.read.schema(schema).parquet(f"{root}/{_OPEN}/batch_id={batch_id}"))
