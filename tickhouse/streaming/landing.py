"""Message streams into landed tables, with a quarantine for what will not decode."""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Callable
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tickhouse.schemas import ENVELOPE, QUARANTINE, conform
from tickhouse.sources.writers import MAX_RECORDS_PER_FILE

HEADER_BYTES = 5  # magic byte and four-byte schema id in front of a registry-framed body
DECODE_FAILED = "avro_decode_failed"
_CORRUPT = "_unparsed"
#: How long to wait, after a stream has ended, for the report of its last batch.
LISTENER_SECONDS = 60


def _body(framed: bool) -> Column:
    if not framed:
        return F.col("value")
    return F.expr(f"substring(value, {HEADER_BYTES + 1}, length(value) - {HEADER_BYTES})")


def decode(
    messages: DataFrame,
    schema: T.StructType,
    source: str,
    framed: bool = True,
    avro_schema: dict | None = None,
) -> DataFrame:
    """Messages -> ``record`` plus envelope columns and ``_decoded``.

    With ``avro_schema`` the body is Avro (needs the Avro package); otherwise it
    is JSON. Neither mode fails the batch on a bad record. A JSON record also
    counts as undecodable if a required field is absent, as it would in Avro.
    """
    body = _body(framed)
    if avro_schema is not None:
        from pyspark.sql.avro.functions import from_avro

        record = from_avro(body, json.dumps(avro_schema), {"mode": "PERMISSIVE"})
        good = F.col("record").isNotNull()
    else:
        reading = T.StructType([*schema, T.StructField(_CORRUPT, T.StringType())])
        record = F.from_json(
            body.cast("string"), reading, {"columnNameOfCorruptRecord": _CORRUPT}
        )
        good = F.col("record").isNotNull() & F.col(f"record.{_CORRUPT}").isNull()
        for field in schema:
            if not field.nullable:
                good = good & F.col(f"record.{field.name}").isNotNull()
    # An envelope column is the message's column of that name, or one made here.
    made = {"_ingested_at": F.current_timestamp(), "_source": F.lit(source)}
    envelope = [
        (made[f.name] if f.name in made else F.col(f.name.removeprefix("_kafka_")))
        .cast(f.dataType).alias(f.name)
        for f in ENVELOPE
    ]
    # A filter on the verdict stays above a generator; below a plain projection it would
    # parse the body again for every condition, and once more for every output field.
    parsed = messages.select(*envelope, F.inline(F.array(F.struct(record.alias("record")))))
    return parsed.withColumn("_decoded", F.coalesce(good, F.lit(False)))


def landed(decoded: DataFrame) -> DataFrame:
    """Record fields at the top level, envelope columns kept."""
    return decoded.filter("_decoded").select("record.*", *ENVELOPE.names).drop(_CORRUPT)


def quarantined(decoded: DataFrame, reason: str = DECODE_FAILED) -> DataFrame:
    """Coordinates of the messages that would not decode: enough to find each again."""
    return conform(
        decoded.filter(~F.col("_decoded")).withColumn("_reason", F.lit(reason)), QUARANTINE
    )


def _trigger(writer, seconds: int | None):
    if seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def start_append(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int | None = 60,
    partition_by: tuple[str, ...] = (),
    output_mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a table. ``trigger_seconds=None`` drains what is there and stops.

    The interval is the small-file lever: a minute of data per commit.
    """
    writer = (
        frame.writeStream.format("parquet")
        .outputMode(output_mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return _start(_trigger(writer, trigger_seconds))


def start_landing(
    decoded: DataFrame,
    path: str,
    quarantine_path: str,
    checkpoint: str,
    trigger_seconds: int | None = 60,
    time_col: str = "trade_time",
    name: str | None = None,
) -> StreamingQuery:
    """Write good rows and quarantine rows from one read of the source.

    Two separate queries would read every message twice. A batch owns the folder
    ``batch_id=N`` in both tables and replaces it, so a batch that is repeated
    after a failure lands once. Good rows are partitioned by the date of
    ``time_col`` inside it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(batch, batch_id, path, quarantine_path, time_col)
        finally:
            batch.unpersist()

    return start_batches(decoded, write, checkpoint, trigger_seconds, name)


def start_batches(
    frame: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger_seconds: int | None = 60,
    name: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch and its number to ``write``, which must stand repeats."""
    writer = frame.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _start(_trigger(writer, trigger_seconds))


def write_batch(
    batch: DataFrame, batch_id: int, path: str, quarantine_path: str, time_col: str = "trade_time"
) -> None:
    """Both outputs of one decoded batch, in place of what the batch wrote before."""
    own = f"batch_id={batch_id}"
    good = landed(batch).withColumn("dt", F.to_date(time_col))
    good.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "dt"
    ).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", "zstd").parquet(
        f"{path}/{own}"
    )
    quarantined(batch).write.mode("overwrite").parquet(f"{quarantine_path}/{own}")


class _Progress(StreamingQueryListener):
    """Rows read and rows too late, of every micro-batch of a run.

    ``recentProgress`` of a query forgets all but its last batches.
    """

    def __init__(self) -> None:
        self.rows: Counter[str] = Counter()
        self.late: Counter[str] = Counter()
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the names of the interface
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        run = str(event.progress.runId)
        self.rows[run] += event.progress.numInputRows
        self.late[run] += sum(
            s.numRowsDroppedByWatermark for s in event.progress.stateOperators
        )

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended[str(event.runId)].set()


_LISTENERS: dict[str, _Progress] = {}


def _progress(spark: SparkSession) -> _Progress:
    """The session's listener, added when its first stream is started."""
    app = spark.sparkContext.applicationId
    if app not in _LISTENERS:
        _LISTENERS[app] = _Progress()
        spark.streams.addListener(_LISTENERS[app])
    return _LISTENERS[app]


def _start(writer: DataStreamWriter) -> StreamingQuery:
    _progress(SparkSession.active())
    return writer.start()


def finish(query: StreamingQuery) -> int:
    """Wait for a draining query; returns the rows it read. Its failure is raised."""
    query.awaitTermination()
    progress = _progress(SparkSession.active())
    if not progress.ended[str(query.runId)].wait(timeout=LISTENER_SECONDS):
        raise TimeoutError("the stream ended, but how many rows it read was not reported in time")
    return progress.rows[str(query.runId)]


def late_rows(query: StreamingQuery) -> int:
    """Rows of a finished run that came after the watermark had passed them."""
    return _progress(SparkSession.active()).late[str(query.runId)]
