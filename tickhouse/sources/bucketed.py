"""Tables stored in buckets of their join keys, which join without a shuffle.

Bars, quote metrics and venue candles share their keys. Stored in the same number of
buckets of those keys, sorted by them, each join reads bucket by bucket; what the
shuffle would cost is paid once, when a table is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tickhouse.session import scratch_dir

BUCKETS = 32


def write(
    df: DataFrame, label: str, keys: Sequence[str], buckets: int = BUCKETS, path: str | None = None
) -> str:
    """Store ``df`` in buckets of ``keys``; the name to read it by, with ``read``.

    A bucket is one file, so a key of very many rows calls for more key columns. The
    files lie in ``path`` (by default in the shared folder), the name in the catalogue.
    """
    spark = df.sparkSession
    name = f"tickhouse_{label}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path or scratch_dir(spark, f"bucketed-{label}"))
     .option("compression", "zstd").saveAsTable(name))
    return name


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
