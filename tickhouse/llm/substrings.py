"""Substring dedup: repeated windows of 50 words, found by FM-index shards.

Shards are cut by content, so that equal windows meet in one and a document is
streamed only through shards that can hold its windows. The least hash of the
8-word grams in a window is its anchor. Equal windows have equal anchors; a run of
windows around one anchor is a segment. Anchors that one distinct text alone has
are dropped before any words move, and equal segments become one before they are
indexed. Each shard is an FM-index over its segments; streaming them through it
gives, for every window, the least document that has it. Anchors with very many
different segments are split into blocks, and every pair of blocks is a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.fm_index import FMIndex
from tickhouse.llm.shared import apart, drop_stored, store

WINDOW, GRAM = 50, 8
#: Segments a shard, and different segments of one anchor above which it is split.
SHARD, BLOCK = 8192, 4096

_RANDOM = np.random.Generator(np.random.PCG64(6))
_PLACE = _RANDOM.integers(0, 1 << 63, GRAM, np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """The words; bytes.split cuts at the six white space characters alone."""
    return (text or "").encode(errors="replace").split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _key(data: bytes) -> tuple[int, int]:
    a, b = np.frombuffer(xxhash.xxh3_128_digest(data), np.int64)
    return int(a), int(b)


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the anchor of each window (its least gram, the first of equals),
    and the grams."""
    n = len(words) - GRAM + 1
    grams = np.zeros(n, np.uint64)
    for i in range(GRAM):
        grams += words[i:i + n] * _PLACE[i]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    return _least_places(grams, WINDOW - GRAM + 1), grams


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` values is, by doubling."""
    places, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = places[:-step], places[step:]
        places = np.where(values[a] <= values[b], a, b)
        reach += step
    return places


def _segments(words: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(anchor, first window, windows) of each run of windows with one anchor."""
    places, grams = anchors(words)
    starts = np.flatnonzero(np.diff(places, prepend=-1))
    counts = np.diff(np.append(starts, len(places)))
    hashes = grams[places[starts]].view(np.int64)
    yield from zip(hashes.tolist(), starts.tolist(), counts.tolist(), strict=True)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, 128-bit key of the words, digest of the joined words, and
    the distinct anchors of every row."""
    names = ["doc_id", "n_words", "k1", "k2", "whole", "anchors"]
    types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64())]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                words = words_of(text.as_py())
                joined = b" ".join(words)
                found = None
                if len(words) >= WINDOW:
                    places, grams = anchors(hashed(words))
                    found = np.unique(grams[np.unique(places)]).view(np.int64)
                rows.append((doc_id.as_py(), len(words), *_key(joined),
                             hashlib.sha256(joined).hexdigest(), found))
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        measure, "doc_id long, n_words long, k1 long, k2 long, whole string, anchors array<long>")


def _cut(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """The documents of ``hits`` (id, k1, k2, shared anchors) with their text and the
    segments at those anchors."""
    joined = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(hits, "id")
    segment = pa.struct([
        ("anchor", pa.int64()), ("start", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
        ("words", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                words = words_of(batch.column("text")[i].as_py())
                key = batch.column("k1")[i].as_py(), batch.column("k2")[i].as_py()
                if _key(b" ".join(words)) != key:
                    continue  # another text under the same doc_id
                shared, numbers = set(batch.column("shared")[i].as_py()), hashed(words)
                found = []
                for anchor, start, count in _segments(numbers):
                    if anchor in shared:
                        data = numbers[start:start + count + WINDOW - 1].tobytes()
                        found.append((anchor, start, *_key(data), data))
                out.append((batch.column("id")[i].as_py(), *key,
                            b" ".join(words).decode(errors="replace"), found))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string()),
                 pa.array([[dict(zip(("anchor", "start", "s1", "s2", "words"), s, strict=True))
                            for s in x] for x in columns[4]], pa.list_(segment))],
                ["id", "k1", "k2", "joined", "segments"])

    return joined.mapInArrow(
        cut, "id long, k1 long, k2 long, joined string, segments array<struct<"
             "anchor: long, start: long, s1: long, s2: long, words: binary>>")


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard: index its segments and stream them; the least owners of windows."""
    sequences = [np.frombuffer(w, np.uint64) for w in rows["words"]]
    index = FMIndex(sequences, rows["owner"].tolist(), WINDOW)
    return rows[["anchor", "s1", "s2"]].assign(least=index.least_owners(sequences))


def repeated_windows(docs: DataFrame, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Measured rows; documents with shared anchors; and the least document of each
    window: (id, k1, k2, spans of (start, least owners from there on))."""
    full = store(measured(docs), label)
    rows = store(full.drop("anchors"), f"{label}-rows")
    texts = full.where("doc_id is not null and anchors is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("id"), F.first("anchors").alias("anchors"))
    at = store(texts.select("id", "k1", "k2", F.explode("anchors").alias("anchor")),
               f"{label}-anchors", clean=True)
    drop_stored(full)
    common = apart(at.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    hits = at.join(common, "anchor").groupBy("id", "k1", "k2").agg(
        F.collect_set("anchor").alias("shared"))
    cut = store(_cut(docs, hits), f"{label}-cut", clean=True)
    drop_stored(at)
    whole = cut.select("id", "k1", "k2", F.explode("segments").alias("s")).select(
        "id", "k1", "k2", "s.*")
    distinct = store(whole.groupBy("anchor", "s1", "s2").agg(
        F.min("id").alias("owner"), F.count("*").alias("texts"),
        F.first("words").alias("words")), f"{label}-segments", clean=True)
    # From here on words are read from the distinct segments alone.
    parts = store(whole.drop("words"), f"{label}-parts")
    joined = store(cut.drop("segments"), f"{label}-joined")
    drop_stored(cut)
    several = apart(distinct.groupBy("anchor").agg(
        F.count("*").alias("n"), F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks")))
    shards = max(1, distinct.count() // SHARD)
    split = F.col("blocks") > 1
    placed = (
        # A segment of one text, alone at its anchor, repeats nothing.
        distinct.join(several, "anchor").where("n > 1 or texts > 1")
        .withColumn("shard", F.when(split, F.col("anchor")).otherwise(
            F.pmod(F.xxhash64("anchor"), F.lit(shards))))
        .withColumn("block", F.pmod(F.xxhash64("s1"), F.col("blocks")).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("shard", F.col("blocks").alias("b"), F.least("block", "o").alias("i"),
                F.greatest("block", "o").alias("j"), "anchor", "s1", "s2", "owner", "words")
    )
    searched = placed.groupBy("shard", "b", "i", "j").applyInPandas(
        _search, "anchor long, s1 long, s2 long, least array<long>")
    # A split segment comes from several shards; the others from one.
    least = store(searched.groupBy("anchor", "s1", "s2").agg(
        F.collect_list("least").alias("all")).select(
        "anchor", "s1", "s2", F.aggregate(
            F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))), F.element_at("all", 1),
            lambda a, x: F.zip_with(a, x, lambda p, q: F.least(p, q))).alias("least")),
        f"{label}-least", clean=True)
    drop_stored(distinct)
    seen = parts.join(least, ["anchor", "s1", "s2"]).where(
        F.exists("least", lambda x: x < F.col("id")))
    spans = seen.groupBy("id", "k1", "k2").agg(
        F.collect_list(F.struct("start", "least")).alias("spans"))
    return rows, joined, spans


def _covered(id_: int, n: int, spans: list[dict]) -> np.ndarray:
    """Which of n words lie in a window that a smaller document has."""
    edges = np.zeros(n + 1, np.int64)
    for span in spans:
        starts = span["start"] + np.flatnonzero(np.asarray(span["least"]) < id_)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
    return np.cumsum(edges[:-1]) > 0


def _removed(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """id, k1, k2, and what is left of the documents that lose words."""
    joined = texts.join(spans, ["id", "k1", "k2"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "k1", "k2", "n_removed", "kept"]
        types = [pa.int64()] * 4 + [pa.string()]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = row["joined"].split(" ")
                gone = _covered(row["id"], len(words), row["spans"])
                kept = " ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                out.append((row["id"], row["k1"], row["k2"], int(gone.sum()), kept))
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return joined.mapInArrow(
        remove, "id long, k1 long, k2 long, n_removed long, kept string")


def digest(docs: DataFrame, label: str = "substrings") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs``.

    A document with the words of a smaller one loses them all, if they make a
    window. A null text has no words; a null doc_id has no place in the order of
    documents, and its row keeps its words and takes none from others. Rows that
    repeat a doc_id take nothing from each other.
    """
    rows, texts, spans = repeated_windows(docs, label)
    removed = _removed(texts, spans).select(
        F.col("id").alias("i"), F.col("k1").alias("a"), F.col("k2").alias("b"), "n_removed",
        F.sha2("kept", 256).alias("left"))
    first = rows.where("doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("id"), F.count("*").alias("copies")).where("copies > 1").select(
        F.col("k1").alias("c"), F.col("k2").alias("d"), "id")
    copy = (F.col("id") < F.col("doc_id")) & (F.col("n_words") >= WINDOW)
    joined = (
        rows.drop("anchors")
        .join(first, (F.col("k1") == F.col("c")) & (F.col("k2") == F.col("d")), "left")
        .join(removed, (F.col("doc_id") == F.col("i")) & (F.col("k1") == F.col("a"))
              & (F.col("k2") == F.col("b")), "left")
    )
    return joined.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
        .alias("n_removed"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("left", "whole")).alias("kept_sha256"))
