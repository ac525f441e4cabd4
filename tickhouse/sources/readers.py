"""Sources: message streams, the reference seed and stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickhouse.schemas import INSTRUMENT_REFERENCE, MESSAGE


def messages(
    spark: SparkSession, source: str, options: Mapping[str, object], schema: StructType | None = None
) -> DataFrame:
    """An unbounded read of any source; options whose value is None are left out."""
    given = {name: str(value) for name, value in options.items() if value is not None}
    stream = spark.readStream.format(source).options(**given)
    return (stream if schema is None else stream.schema(schema)).load()


def kafka_messages(spark: SparkSession, topic: str, **settings: object) -> DataFrame:
    """A topic, with Kafka source options in ``settings`` (dots written as ``__``).

    Needs the Kafka package on the class path, and ``kafka__bootstrap__servers``.
    A trigger takes at most half a million offsets unless ``maxOffsetsPerTrigger``
    says otherwise, which bounds the first batch after an outage.
    """
    named = {key.replace("__", "."): value for key, value in settings.items()}
    return messages(
        spark, "kafka",
        {"subscribe": topic, "includeHeaders": "true", "maxOffsetsPerTrigger": 500_000, **named},
    )


def file_messages(
    spark: SparkSession,
    path: str,
    schema: StructType = MESSAGE,
    max_files_per_trigger: int | None = 1_000,
    **options: str,
) -> DataFrame:
    """Parquet files as a stream, with the same envelope as a topic."""
    paced = {"path": path, "maxFilesPerTrigger": max_files_per_trigger, **options}
    return messages(spark, "parquet", paced, schema)


def reference_seed(spark: SparkSession, path: str) -> DataFrame:
    """The declared instruments, from CSV with declared types; a malformed row fails the read."""
    return (
        spark.read.schema(INSTRUMENT_REFERENCE)
        .option("header", "true")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table. Without a declared schema, columns added later show up as null before."""
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(schema).parquet(path)
