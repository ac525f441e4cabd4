"""What the operators of this subpackage share: cleaned input, stored tables, slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.session import scratch_dir
from tickhouse.sources.staged import track

#: The white space that separates words, as a Java and a Python character class.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
#: The same characters for functions that take them one by one.
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, a null text as the empty one."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


#: Spark's setting that deletes a query's shuffle files when the query ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, label: str, clean: bool = False) -> DataFrame:
    """Write ``df`` into the folder that all executors share, and read it back.

    The work above runs once, the lineage ends in files, and a lost executor
    costs only the tasks that it was running. With ``clean`` the shuffle files of the
    write go as soon as it is done, rather than when the driver happens to forget
    them; the frame itself is not to be used again.
    """
    spark = df.sparkSession
    path, before = scratch_dir(spark, f"llm-{label}"), spark.conf.get(_CLEAN)
    track(path)
    spark.conf.set(_CLEAN, str(clean or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def apart(df: DataFrame) -> DataFrame:
    """An aggregate that is to be joined on its own key, dealt out anew first.

    Joined as it is, it would share its shuffle with the join, and Spark could not
    split a hot key of the other side. The table is small against that side.
    """
    return df.hint("rebalance")


def drop_stored(df: DataFrame) -> None:
    """Delete the folder of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slice_bits(rows: int, per_slice: int) -> int:
    """How many leading bits of a hash cut ``rows`` into slices of about ``per_slice``."""
    return max(0, (max(rows, 1) // per_slice).bit_length())


def sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, the first in order of a hash of ``key``.

    A share of the hash range that holds a fifth more than that is cut first, so
    the sort meets about ``rows`` rows, not as many of every partition.
    """
    total, span = df.count(), 1 << 31
    place = F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.lit(span))
    share = 1.0 if total < 4 * rows else 1.2 * rows / total
    return df.where(place < F.lit(int(span * share))).orderBy(place, key).limit(rows)
