"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Quantile sketches share an aggregate with many other measures; keep them
    # in hash mode for more groups per task before falling back to a sort.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Capturing a Python call site per column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str, master: str | None = None, storage: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the jobs are planned for.

    ``storage`` is a folder on storage that all executors share, for intermediate
    tables; only a local session does without.
    """
    if storage:
        conf["spark.checkpoint.dir"] = storage
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BATCH_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of the settings to an existing session."""
    for key in ("spark.sql.session.timeZone",
                "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"):
        spark.conf.set(key, BATCH_CONF[key])
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage that every executor reaches. Without it
    a local session, whose executor is this process, uses a temporary folder; on a
    cluster the executors could not see each other's files, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tickhouse-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tickhouse/{label}-{uuid.uuid4().hex[:12]}"
