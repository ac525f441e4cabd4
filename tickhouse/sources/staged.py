"""Written intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.session import scratch_dir

_WRITTEN: list[str] = []


def stage(df: DataFrame, label: str = "stage", by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and return it as a table.

    For a frame that several branches read: the work above it runs once, the
    readers prune columns and push filters into it, its real size is known to
    the planner, and a lost executor re-reads files instead of recomputing. A reader of
    one value of the columns ``by``, which have few, reads only its rows.
    """
    path = scratch_dir(df.sparkSession, label)
    track(path)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def track(path: str) -> None:
    """Have ``release`` delete a folder that is written by other means."""
    _WRITTEN.append(path)


def release(spark: SparkSession) -> int:
    """Delete the tables that this process has staged; how many there were.

    For the end of a run, or when the results built on them have been written.
    """
    paths, _WRITTEN[:] = _WRITTEN[:], []
    for path in paths:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
    return len(paths)
