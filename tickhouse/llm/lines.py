"""Line dedup: which lines of each document stay, as run-length keep bitmaps.

Hashes of long lines are range-partitioned with a secondary sort by document and
position, so a line that a third of all documents share spreads over many
partitions. Each partition streams its sorted rows and passes on one row for the
first occurrence of a line in a document, with the places behind it; counts and the
last document of each line are summed from those. Texts stay where they are: only hashes, positions and bitmaps move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.shared import SPACE_CHARS, drop_stored, lower_ascii, store, texts, unused

MIN_CHARS = 40
MIN_DOCS = 5
#: Repeated lines are few, their places many: each line meets its places in so many parts.
PARTS = 16


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per line whose key is long enough: 128 bits of the key, and its place.

    ``version`` tells rows with one doc_id and different texts apart.
    """
    split = texts(docs).select(
        "doc_id", F.xxhash64("text").alias("version"),
        F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    # Stripping can only shorten, so short lines go before any key is made.
    keyed = split.where(F.length("line") >= min_chars).withColumn(
        "key", lower_ascii(F.btrim("line", F.lit(SPACE_CHARS))))
    return keyed.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        "doc_id", "version", "pos")


def occurrences(hashes: DataFrame) -> DataFrame:
    """h1, h2, doc_id, places: where each document holds a line, the first place first.

    Partitions are ranges of (hash, document), sorted by them and the position. One
    pass over the sorted rows gathers a document's places of a line in that order.
    """
    return (
        hashes.repartitionByRange("h1", "h2", "doc_id")
        .sortWithinPartitions("h1", "h2", "doc_id", "pos")
        .groupBy("h1", "h2", "doc_id")
        .agg(F.collect_list(F.struct("version", "pos")).alias("places"))
    )


def repeated(firsts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """h1, h2, last_doc of the lines that ``min_docs`` documents hold, from one row for
    each line's first occurrence in a document."""
    return (
        firsts.groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        .where(F.col("n_docs") >= min_docs)
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 label: str = "lines") -> DataFrame:
    """doc_id, version, keep, n_dropped for the documents that lose lines.

    ``keep`` is the bitmap of kept lines in run lengths: (start, length) of each
    run from line 0; the last run is open and has length -1. A document without
    a row keeps everything. Empty documents and tables lose nothing; rows whose
    doc_id is null count as no document and keep their lines.
    """
    hashes = store(line_hashes(docs, min_chars).where("doc_id is not null"), label)
    firsts = store(occurrences(hashes), f"{label}-firsts")
    drop_stored(hashes)
    part = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    dropped = (
        firsts.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))
        .join(repeated(firsts, min_docs).withColumn("part", part), ["h1", "h2", "part"])
        .where(F.col("doc_id") != F.col("last_doc"))
        .select("doc_id", F.inline("places"))
        .groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )
    gone = F.col("gone")
    first = F.filter(gone, lambda p, i: (i == 0) | (gone[F.greatest(i, F.lit(1)) - 1] < p - 1))
    last = F.filter(
        gone, lambda p, i: (i == F.size(gone) - 1)
        | (gone[F.least(i + 1, F.size(gone) - 1)] > p + 1))
    runs = dropped.select(
        "doc_id", "version", F.size(gone).cast("long").alias("n_dropped"),
        F.concat(F.array(F.lit(0)), F.transform(last, lambda p: p + 1)).alias("starts"),
        F.concat(first, F.array(F.lit(-1))).alias("stops"))
    keep = F.zip_with("starts", "stops", lambda a, b: F.struct(
        a.alias("start"), F.when(b < 0, F.lit(-1)).otherwise(b - a).alias("length")))
    return runs.select("doc_id", "version", keep.alias("keep"), "n_dropped")


def apply_bitmap(text: Column, keep: Column) -> Column:
    """The text with the lines of its bitmap; whole where there is none."""
    lines = _lines(text)
    kept = F.transform(F.array(lines), lambda all_lines: F.array_join(F.flatten(F.transform(
        keep, lambda r: F.slice(
            all_lines, r["start"] + 1,
            F.when(r["length"] < 0, F.size(all_lines)).otherwise(r["length"])))), "\n"))[0]
    return F.when(keep.isNull(), text).otherwise(kept)


def dedup(docs: DataFrame, label: str = "lines") -> DataFrame:
    """``docs`` with the repeated lines gone from text; n_chars follows if present."""
    doc, version, own, keep = (
        unused(docs, c) for c in ("__doc", "__version", "__own", "__keep"))
    bitmaps = keep_bitmaps(docs, label=label).select(
        F.col("doc_id").alias(doc), F.col("version").alias(version), F.col("keep").alias(keep))
    text = F.coalesce("text", F.lit(""))
    out = docs.withColumn(own, F.xxhash64(text)).join(
        bitmaps, (F.col("doc_id") == F.col(doc)) & (F.col(own) == F.col(version)), "left")
    out = out.withColumn("text", F.when(F.col(keep).isNull(), F.col("text")).otherwise(
        apply_bitmap(F.col("text"), F.col(keep))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col(keep).isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """Per document: lines, dropped lines and the digest of what is kept."""
    text = texts(docs).withColumn("version", F.xxhash64("text"))
    bitmaps = keep_bitmaps(docs).select(
        F.col("doc_id").alias("d"), F.col("version").alias("v"), "keep", "n_dropped")
    return text.join(
        bitmaps, (F.col("doc_id") == F.col("d")) & (F.col("version") == F.col("v")), "left"
    ).select(
        "doc_id",
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
        .cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(apply_bitmap(F.col("text"), F.col("keep")), 256).alias("kept_sha256"))
