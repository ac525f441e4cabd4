"""Stored tables: physical layout, keyed upsert, incremental windows and compaction.

Tables are Parquet folders partitioned by a date and, for busy tables, a symbol
bucket. All writes go through Spark's commit protocol: a partition is replaced
as a whole, and readers of the old files are not disturbed before the commit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.operators.dedup import dedup

MAX_RECORDS_PER_FILE = 5_000_000
SMALL_FILE_BYTES = 96 * 1024 * 1024
TARGET_FILE_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Layout:
    """How a table is split and ordered on storage.

    ``grain`` is ``day`` or ``month`` of ``time_col``; ``by`` names columns that split
    a partition by their values, of which there are few; ``buckets`` splits it by
    symbol hash, so a filter on symbol reads one bucket.
    Rows are rebalanced by these columns before a write: AQE merges small
    partitions into one task and splits one that a busy instrument has filled.
    """

    time_col: str
    grain: str = "day"
    buckets: int = 0
    bucket_col: str = "symbol"
    sort: tuple[str, ...] = ()
    by: tuple[str, ...] = ()

    @property
    def derived_cols(self) -> list[str]:
        """Partition columns that are no columns of the table."""
        return ["dt", *(["sym_bucket"] if self.buckets else [])]

    @property
    def partition_cols(self) -> list[str]:
        return ["dt", *self.by, *(["sym_bucket"] if self.buckets else [])]

    def partition_types(self) -> dict[str, T.StructField]:
        return {
            "dt": T.StructField("dt", T.DateType()),
            "sym_bucket": T.StructField("sym_bucket", T.IntegerType()),
        }

    def date_of(self, value: Column) -> Column:
        return F.to_date(F.date_trunc(self.grain, value))

    def with_bucket(self, df: DataFrame) -> DataFrame:
        if not self.buckets:
            return df
        return df.withColumn(
            "sym_bucket", F.pmod(F.xxhash64(self.bucket_col), F.lit(self.buckets)).cast("int"))

    def placed(self, df: DataFrame) -> DataFrame:
        """Add the partition columns."""
        return self.with_bucket(df.withColumn("dt", self.date_of(F.col(self.time_col))))

    def place(self, df: DataFrame) -> DataFrame:
        """Add the partition columns and arrange rows for the write."""
        out = self.placed(df)
        out = out.hint("rebalance", *self.partition_cols)
        return out.sortWithinPartitions(*self.partition_cols, *self.sort)

    def drop_derived(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.derived_cols)


def _writer(df: DataFrame, layout: Layout, mode: str):
    return (
        df.write.mode(mode)
        .partitionBy(*layout.partition_cols)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("compression", "zstd")
    )


def append(df: DataFrame, path: str, layout: Layout) -> None:
    _writer(layout.place(df), layout, "append").parquet(path)


def overwrite(df: DataFrame, path: str, layout: Layout | None = None) -> None:
    """Full rebuild."""
    if layout is None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return
    _writer(layout.place(df), layout, "overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(path)


def _filesystem(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    """A table exists once a write to it has committed."""
    fs, location = _filesystem(spark, path)
    return fs.exists(location) and len(fs.listStatus(location)) > 0


def subfolders(spark: SparkSession, path: str) -> list[tuple[str, Callable[[], None]]]:
    """Names of a folder's folders, each with the call that deletes it; none if it is absent."""
    fs, location = _filesystem(spark, path)
    if not fs.exists(location):
        return []
    return [(s.getPath().getName(), lambda p=s.getPath(): fs.delete(p, True))
            for s in fs.listStatus(location) if s.isDirectory()]


def check_layout(spark: SparkSession, path: str, layout: Layout) -> None:
    """An error for a table whose folders are not those of the layout.

    Rewriting such a table by the layout would put a second kind of folders beside
    the first, and nothing could read it any more.
    """
    at = path
    for column in layout.partition_cols:
        names = [n for n, _ in subfolders(spark, at) if "=" in n]
        foreign = sorted({n.split("=")[0] for n in names} - {column})
        if foreign:
            raise ValueError(f"{path} is laid out by {foreign}, not by {layout.partition_cols}")
        if not names:
            return
        at = f"{at}/{names[0]}"
    deeper = sorted({n.split("=")[0] for n, _ in subfolders(spark, at) if "=" in n})
    if deeper:
        raise ValueError(f"{path} is laid out by {deeper} below {layout.partition_cols}")


def replace_partitions(df: DataFrame, path: str, layout: Layout) -> None:
    """Write the partitions that ``df`` has rows for, in place of what they held."""
    _writer(layout.place(df), layout, "overwrite").option(
        "partitionOverwriteMode", "dynamic").parquet(path)


# -- incremental window ----------------------------------------------------------------


def high_water_mark(table: DataFrame, t: str) -> datetime | None:
    """Newest ``t`` in a table: one aggregated value, answered mostly from file footers."""
    return table.agg(F.max(t)).head()[0]


def incremental(
    source: DataFrame, t: str, mark: datetime | None, lookback: timedelta
) -> DataFrame:
    """Rows of the source from ``mark - lookback`` on; the whole source on a first run.

    The bound is a literal, so it prunes partitions and reaches the scan. It
    reaches back past the mark to pick up late rows, whose whole bar is rebuilt.
    """
    if mark is None:
        return source
    return source.filter(F.col(t) >= F.lit(mark - lookback))


# -- upsert ----------------------------------------------------------------------------


def upsert(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    layout: Layout,
    lookback: timedelta | None = None,
    schema: T.StructType | None = None,
    order: Sequence[str] = (),
) -> None:
    """Insert or replace rows by key, rewriting only the partitions involved.

    A key that comes more than once in ``new`` is settled by ``order`` (its last
    row wins); without an order it is an error, as no row has a better claim.

    A key may move between partitions, so old copies are looked up in every
    partition of the lookback (counted back from the oldest new row; ``None``
    searches the whole table), not only in those the new rows fall in. New
    columns are added and are null in old rows. Declare the table's ``schema``
    on a large table; without it the footers of all files are merged to find it.

    The old table is read twice: keys alone, to find the partitions with an old
    copy, and then those partitions, named by literals that prune the listing.
    The names of touched partitions pass through the driver; they are as many as
    days times buckets. ``new`` is read more than once, so pass a stored frame.
    """
    spark = new.sparkSession
    if order:
        new = dedup(new, keys, order, keep="last", count_col=None)
    elif not new.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"keys {tuple(keys)} repeat in the new rows; name an order")
    if not exists(spark, path):
        append(new, path, layout)
        return
    parts = layout.partition_cols
    if schema is None:
        old = spark.read.option("mergeSchema", "true").parquet(path)
    else:
        full = T.StructType(
            [*schema, *[layout.partition_types()[c] for c in layout.derived_cols]])
        old = spark.read.schema(full).parquet(path)
    if lookback is not None:
        oldest = new.agg(F.min(layout.time_col)).head()[0]
        if oldest is not None:
            old = old.filter(F.col("dt") >= layout.date_of(F.lit(oldest - lookback)))
    new_keys = new.select(*keys)
    holding = {
        tuple(r) for r in
        old.join(new_keys, list(keys), "left_semi").select(*parts).distinct().collect()
    }
    receiving = {tuple(r) for r in layout.placed(new).select(*parts).distinct().collect()}
    kept = old.filter(in_partitions(parts, holding | receiving)).join(
        new_keys, list(keys), "left_anti"
    )
    merged = layout.place(
        layout.drop_derived(kept.unionByName(layout.placed(new), allowMissingColumns=True))
    )
    # A partition whose every row moved elsewhere gets no output, so the dynamic
    # overwrite would leave it standing. Usually no partition only gives rows away.
    giving = holding - receiving
    emptied: set[tuple] = set()
    if giving:
        left = old.filter(in_partitions(parts, giving)).join(new_keys, list(keys), "left_anti")
        emptied = giving - {tuple(r) for r in left.select(*parts).distinct().collect()}
    _writer(merged, layout, "overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for values in emptied:
        folder = "/".join(f"{c}={v}" for c, v in zip(parts, values, strict=True))
        fs, location = _filesystem(spark, f"{path}/{folder}")
        fs.delete(location, True)


def in_partitions(parts: Sequence[str], values: set[tuple]) -> Column:
    """A condition of literals; dates are listed per value of the other columns, which
    are few, so it stays short."""
    condition = F.lit(False)
    for rest in {v[1:] for v in values}:
        same = _one_of(parts[0], [v[0] for v in values if v[1:] == rest])
        for column, value in zip(parts[1:], rest, strict=True):
            same = same & F.col(column).eqNullSafe(F.lit(value))
        condition = condition | same
    return condition


def _one_of(column: str, values: list) -> Column:
    found = F.col(column).isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


# -- compaction ------------------------------------------------------------------------


def file_report(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """Files, bytes and small files per partition, from file metadata only."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )
    values = [F.regexp_extract("path", rf"/{p}=([^/]+)/", 1).alias(p) for p in parts]
    return (
        files.select(*values, "length")
        .groupBy(*parts)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.count_if(F.col("length") < SMALL_FILE_BYTES).alias("small_files"),
        )
    )


@dataclass(frozen=True)
class CompactionResult:
    path: str
    files_before: int
    files_after: int
    partitions: int
    error: str | None = None


def compact(
    spark: SparkSession,
    path: str,
    layout: Layout,
    small_bytes: int = SMALL_FILE_BYTES,
    target_bytes: int = TARGET_FILE_BYTES,
) -> CompactionResult:
    """Rewrite partitions that hold more than one small file into files near the target size.

    A partition gets as many writers as its bytes call for: one writes all of a
    small one, and rows of a larger one go to several by range of the layout's sort
    columns, so each file covers a stretch of symbols and its statistics prune.

    A table with other folders than the layout's is refused (:func:`check_layout`);
    one that a stream adds to by batches is folded instead (:mod:`tickhouse.sources.tiers`).
    """
    check_layout(spark, path, layout)
    parts = layout.partition_cols
    report = file_report(spark, path, parts)
    before = report.agg(F.sum("files"), F.sum("bytes")).head()
    mixed = report.filter(
        (F.col("small_files") > 1) & (F.col("bytes") / F.col("files") < small_bytes)
    ).withColumn("__writers", F.ceil(F.col("bytes") / F.lit(target_bytes)))
    candidates = mixed.count()
    if candidates:
        table = spark.read.option("mergeSchema", "true").parquet(path)
        keys = [F.col(c).cast("string") for c in parts]
        marked = table.withColumns({f"__{c}": k for c, k in zip(parts, keys)})
        picked = marked.join(
            mixed.select(*[F.col(c).alias(f"__{c}") for c in parts], "__writers"),
            [f"__{c}" for c in parts],
        )
        rewritten = picked.filter("__writers = 1").repartition(*parts)
        several = mixed.filter("__writers > 1").agg(F.sum("__writers")).head()[0]
        if several:
            rewritten = rewritten.unionByName(
                picked.filter("__writers > 1").repartitionByRange(
                    int(several), *parts, *layout.sort)
            )
        rewritten = rewritten.sortWithinPartitions(*parts, *layout.sort).select(*table.columns)
        _writer(rewritten, layout, "overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(path)
    after = file_report(spark, path, parts).agg(F.sum("files")).head()
    return CompactionResult(path, before[0] or 0, after[0] or 0, candidates)


def compact_all(
    spark: SparkSession, tables: Sequence[tuple[str, Layout]], **sizes: int
) -> list[CompactionResult]:
    """Compact several tables; a failure is recorded and the next table goes on."""
    results = []
    for path, layout in tables:
        try:
            results.append(compact(spark, path, layout, **sizes))
        except Exception as exc:  # noqa: BLE001 - isolation between tables is the point
            results.append(CompactionResult(path, 0, 0, 0, f"{type(exc).__name__}: {exc}"))
    return results


def store_failures(rows: DataFrame, path: str, check_name: str) -> None:
    """Keep the rows behind a failed check, replacing that check's earlier rows."""
    rows.withColumn("check_name", F.lit(check_name)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("check_name").parquet(path)
