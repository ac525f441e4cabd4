"""Late rows kept: each batch is split by how far the batches before it had come.

A batch's mark is the newest event time of all batches before it, kept in a table of
one row a batch. Rows older than the mark by more than the allowed delay, and rows
without a time, go to an output of their own instead of being dropped. A batch reads
its predecessor's mark and replaces its three folders, so repeating it, or starting
anew between batches, gives the same two outputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickhouse.sources.writers import exists
from tickhouse.streaming.landing import start_batches

_MARK = "mark timestamp"


@dataclass(frozen=True)
class Split:
    """Folders of the two outputs and of the marks; the time column; the delay in seconds."""

    on_time: str
    late: str
    marks: str
    t: str = "event_time"
    delay_seconds: int = 3_600


def _mark(spark: SparkSession, split: Split, batch_id: int):
    path = f"{split.marks}/batch_id={batch_id}"
    if batch_id < 0 or not exists(spark, path):
        return None
    return spark.read.schema(_MARK).parquet(path).head()[0]


def split_batch(rows: DataFrame, batch_id: int, split: Split) -> None:
    """Write a batch's rows on time, its late rows and the mark behind it."""
    spark, t = rows.sparkSession, F.col(split.t).cast("timestamp")
    mark = _mark(spark, split, batch_id - 1)
    late = t.isNull()
    if mark is not None:
        late = late | (F.unix_micros(t) < F.unix_micros(F.lit(mark).cast("timestamp"))
                       - F.lit(split.delay_seconds * 1_000_000))
    rows.persist()
    try:
        for path, part in ((split.on_time, rows.filter(~late)), (split.late, rows.filter(late))):
            part.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        # An empty batch hands its predecessor's mark on.
        rows.agg(F.greatest(F.max(t), F.lit(mark).cast("timestamp")).alias("mark")).write.mode(
            "overwrite").parquet(f"{split.marks}/batch_id={batch_id}")
    finally:
        rows.unpersist()


def start_split(
    rows: DataFrame, split: Split, checkpoint: str, trigger_seconds: int | None = 60
) -> StreamingQuery:
    return start_batches(
        rows, lambda batch, batch_id: split_batch(batch, batch_id, split), checkpoint,
        trigger_seconds)
