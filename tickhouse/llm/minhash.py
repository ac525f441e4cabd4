"""MinHash near-dedup with odd sketches.

1. Every text becomes its set of word shingles, 120 MinHash samples of it, bands
   of some samples, and an odd sketch: each sample flips one bit of a bitmap, so the bits in which two bitmaps differ measure how many samples do.
   Equal sets are one set from here on, whatever the number of their copies.
2. Sets that share a band meet in a bucket. Inside, population counts of XORed
   sketches leave the pairs that may be similar enough; a bucket passes on one
   edge per set, to the least set it is connected with there.
3. What these edges connect is small and is compared on full sets, most similar
   pairs first; a pair that is connected by then needs no comparison.

A ``Limit`` is the least similarity with the bands and the sketch bound that fit
it. At 85 percent (24 bands of five) a pair at the limit shares no band with a
chance of 8e-7, and is beyond the sketch bound (0.68 as estimated) with a chance
of 5e-6; at 80 percent (30 bands of four) with chances of 1.4e-7 and 6e-7
(0.59 as estimated). Other than that no link is lost. Buckets and connected parts above a block are cut into pairs of
blocks, so no task holds more than two.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.components import components
from tickhouse.llm.shared import apart, store, unused

SHINGLE, PERCENT = 5, 85
BANDS, ROWS = 24, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
LEAST_ESTIMATE = 0.68
BUCKET_BLOCK, SET_BLOCK = 2048, 512

_RANDOM = np.random.Generator(np.random.PCG64(20))
_ODD = _RANDOM.integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RANDOM.integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2)
_PLACE = _RANDOM.integers(0, 1 << 63, SHINGLE + 1, np.uint64) * np.uint64(2) + np.uint64(1)
_JOIN = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all of them."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """64 bits of each word; bytes.split and bytes.lower know ASCII alone."""
    words = (text or "").encode(errors="replace").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingles; fewer words than one are a shingle as a whole."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    sums = np.full(n, np.uint64(size) * _PLACE[SHINGLE])
    for i in range(size):
        sums += words[i:i + n] * _PLACE[i]
    return np.unique(_mix(sums))


def samples(found: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        part = found[at:at + 2048, None]
        np.minimum(least, ((part ^ _FLIP) * _ODD).min(axis=0), out=least)
    return least


def bands(sampled: np.ndarray, number: int = BANDS) -> np.ndarray:
    """A hash of each of ``number`` bands; a divisor of the number of samples."""
    joined = (sampled * _JOIN.ravel()).reshape(number, -1).sum(axis=1, dtype=np.uint64)
    return _mix(joined + np.arange(number, dtype=np.uint64)).view(np.int64)


def odd_sketch(sampled: np.ndarray) -> bytes:
    """Bits flipped once by each sample at a place that its value and number give."""
    places = _mix(sampled + np.arange(SAMPLES, dtype=np.uint64) * _ODD) % np.uint64(SKETCH_BITS)
    flips = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def estimate(differing: float) -> float:
    """The similarity that a number of differing bits stands for."""
    rest = max(1 - 2 * differing / SKETCH_BITS, 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * float(np.log(rest))


def most_differing(least_estimate: float) -> int:
    """The most bits in which the sketches of a pair to compare may differ."""
    return max(x for x in range(SKETCH_BITS // 2) if estimate(x) >= least_estimate)


class Limit(NamedTuple):
    """Least similarity in percent, bands that the samples are cut into, sketch bound."""

    percent: int = PERCENT
    bands: int = BANDS
    most_differing: int = most_differing(LEAST_ESTIMATE)


#: The limit of op8's query, and one for pairs of 80 percent and more.
AT_85 = Limit()
AT_80 = Limit(80, 30, most_differing(0.59))


def _key(found: np.ndarray) -> tuple[int, int]:
    both = xxhash.xxh3_128_digest(found.tobytes())
    a, b = np.frombuffer(both, np.int64)
    return int(a), int(b)


def measured(docs: DataFrame, limit: Limit = AT_85) -> DataFrame:
    """doc_id, size and 128-bit key of the set, bands and sketch of every row."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "k1", "k2", "bands", "sketch"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                found = shingles(text.as_py())
                if len(found):
                    sampled = samples(found)
                    rows.append((doc_id.as_py(), len(found), *_key(found),
                                 bands(sampled, limit.bands), odd_sketch(sampled)))
                else:
                    rows.append((doc_id.as_py(), 0, 0, 0, None, None))
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        measure, "doc_id long, n long, k1 long, k2 long, bands array<long>, sketch binary")


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _bits(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Population counts of the XOR of each row of a with each of b."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for word in range(a.shape[1]):
        out += np.bitwise_count(a[:, word][:, None] ^ b[:, word][None, :])
    return out


def _similar(ids: list[int], sizes: list[int], sketches: list[bytes],
             limit: Limit) -> Iterator[tuple[int, int]]:
    """(id, least id that sketches connect it with) for a bucket, or a pair of blocks."""
    n = len(ids)
    order = sorted(range(n), key=ids.__getitem__)
    forest = Forest(n)
    if n <= 12:
        bits = [int.from_bytes(sketches[i]) for i in order]
        for i in range(n):
            for j in range(i):
                low, high = sorted((sizes[order[i]], sizes[order[j]]))
                if 100 * low >= limit.percent * high and (
                        bits[i] ^ bits[j]).bit_count() <= limit.most_differing:
                    forest.join(i, j)
    else:
        bits, size = _bits([sketches[i] for i in order]), np.array([sizes[i] for i in order])
        rest = np.arange(n)
        # Breadth first from the least row left: each row's neighbours are found once.
        while len(rest):
            edge, rest = rest[:1], rest[1:]
            root = int(edge[0])
            while len(edge) and len(rest):
                part, edge = edge[:256], edge[256:]
                near = _differing(bits[part], bits[rest]) <= limit.most_differing
                low = np.minimum(size[part][:, None], size[rest][None, :])
                high = np.maximum(size[part][:, None], size[rest][None, :])
                hit = (near & (100 * low >= limit.percent * high)).any(axis=0)
                for x in rest[hit].tolist():
                    forest.join(root, x)
                edge, rest = np.concatenate([edge, rest[hit]]), rest[~hit]
    for i in range(n):
        if forest.root(i) != i:
            yield ids[order[i]], ids[order[forest.root(i)]]


def _bucket_edges(batches: Iterator[pa.RecordBatch], limit: Limit) -> Iterator[pa.RecordBatch]:
    """Edges of each run of rows with one (band, i, j); rows come sorted by these."""
    key, ids, sizes, sketches = None, [], [], []
    out: list[tuple[int, int]] = []
    end = [None]
    for batch in chain(batches, end):
        rows = zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True) if batch else [
            (None,) * 6]
        for band, i, j, doc, size, sketch in rows:
            if (band, i, j) != key:
                if len(ids) > 1:
                    out.extend(_similar(ids, sizes, sketches, limit))
                key, ids, sizes, sketches = (band, i, j), [], [], []
            ids.append(doc)
            sizes.append(size)
            sketches.append(sketch)
        if len(out) > 10_000 or batch is None:
            u, v = zip(*out, strict=True) if out else ([], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
            out = []


def _verify(rows: pd.DataFrame, limit: Limit) -> pd.DataFrame:
    """Edges of a spanning forest of the links inside a block or between two."""
    # A doc_id with several texts has a set of each.
    rows = rows.drop_duplicates(["id", "found"]).reset_index(drop=True)
    ids, block = rows["id"].tolist(), rows["block"].to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in rows["found"]]
    size = np.array([len(s) for s in sets])
    bits = _bits(rows["sketch"].tolist())
    apart = _differing(bits, bits)
    fits = 100 * np.minimum(size[:, None], size) >= limit.percent * np.maximum(size[:, None], size)
    if rows["i"].iloc[0] != rows["j"].iloc[0]:
        fits &= block[:, None] != block
    a, b = np.nonzero(np.triu(fits & (apart <= limit.most_differing), 1))
    forest, u, v = Forest(len(ids)), [], []
    for k in np.argsort(apart[a, b], kind="stable"):
        i, j = int(a[k]), int(b[k])
        if forest.root(i) == forest.root(j):
            continue
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= limit.percent * (len(sets[i]) + len(sets[j]) - both):
            forest.join(i, j)
            u.append(ids[i])
            v.append(ids[j])
    return pd.DataFrame({"u": u, "v": v}, dtype="int64")


def _in_blocks(df: DataFrame, size: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks (i, j) of its group that it is in."""
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    return (
        df.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
        .drop("o", size)
    )


def _full_sets(docs: DataFrame, near: DataFrame) -> DataFrame:
    """The rows of ``near`` with their shingle sets, made again from the texts."""
    joined = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(near, "id")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column("text")]
            keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)
            # Another text under the same doc_id is not the one that was meant.
            same = pa.array([_key(s) == k for s, k in zip(sets, keys, strict=True)], pa.bool_())
            kept = [batch.column(c) for c in ("id", "component", "members", "sketch")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([s.tobytes() for s in sets], pa.binary())],
                ["id", "component", "members", "sketch", "found"]).filter(same)

    return joined.mapInArrow(
        shingle, "id long, component long, members long, sketch binary, found binary")


def _classes(docs: DataFrame, label: str, limit: Limit) -> tuple[DataFrame, DataFrame]:
    """The measured rows, and (id, component) of the documents that link."""
    rows = store(measured(docs, limit), label)
    sets = store(
        rows.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(
            F.min("doc_id").alias("id"), F.first("n").alias("n"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), f"{label}-sets")
    banded = sets.select("id", F.explode("bands").alias("band"))
    buckets = apart(
        banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1"))
    members = banded.join(buckets, "band").join(sets.select("id", "n", "sketch"), "id")
    edges = (
        _in_blocks(members, "members", BUCKET_BLOCK)
        .repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        .select("band", "i", "j", "id", "n", "sketch")
        .mapInArrow(partial(_bucket_edges, limit=limit), "u long, v long")
    )
    maybe = store(components(edges, f"{label}-maybe"), f"{label}-parts")
    parts = apart(maybe.groupBy("component").agg(F.count("*").alias("members")))
    near = maybe.join(parts, "component").join(sets.select("id", "k1", "k2", "sketch"), "id")
    verified = (
        _in_blocks(_full_sets(docs, near), "members", SET_BLOCK)
        .groupBy("component", "i", "j").applyInPandas(
            lambda found: _verify(found, limit), "u long, v long")
    )
    copies = rows.where("n > 0").join(
        sets.select("k1", "k2", "id"), ["k1", "k2"]).where("doc_id <> id").select(
        F.col("doc_id").alias("u"), F.col("id").alias("v"))
    return rows, components(verified.union(copies), f"{label}-links")


def near_duplicates(
    docs: DataFrame, label: str = "minhash", limit: Limit = AT_85
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``.

    A null or empty text has no shingle and links with nothing; so does a row
    whose doc_id is null. Rows that repeat a doc_id are versions of one document:
    it links by each of its texts.
    """
    rows, classes = _classes(docs, label, limit)
    component = F.coalesce("component", "doc_id")
    return rows.select("doc_id", F.col("n").alias("n_shingles")).join(
        classes.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def dedup(docs: DataFrame, label: str = "minhash", limit: Limit = AT_85) -> DataFrame:
    """One document of each group, the one of least doc_id, with its columns.

    Rows that repeat the doc_id of a kept document: one of them stays.
    """
    rows, classes = _classes(docs, label, limit)
    name = unused(docs, "__id")
    gone = classes.where("id <> component").select(F.col("id").alias(name))
    left = docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
    repeats = rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeats.isEmpty():
        return left
    again = repeats.select(F.col("doc_id").alias(name))
    twice = left.join(again, F.col("doc_id") == F.col(name), "left_semi")
    return left.join(again, F.col("doc_id") == F.col(name), "left_anti").union(
        twice.dropDuplicates(["doc_id"]))
