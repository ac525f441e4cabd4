"""Exact top-k by inner product, aggregating sorted lists without random access.

Candidates are cut into blocks. Inside a block every dimension is a list of the
candidates in order of their component, read from its favourable end. What has
been read gives each candidate a lower and an upper bound of its score (unread
lists can add at least their last and at most their next entry); reading stops
when nothing outside the candidates with an upper bound at the k-th best lower
bound can qualify, and their scores are then resolved. All queries of a task read
a stretch of the lists together, as a product of matrices.

The first block gives each query a k-th best score, which goes with the query into
the other blocks: a query whose best possible sum there is below it reads nothing.
A block's k best of each query are merged across blocks. Queries are cut into blocks
too, so a task holds one block of each at a time, whatever the tables hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.shared import store

K = 10
EVERY = 100
SCALE = 1024
CANDIDATES, QUERIES = 8192, 512
#: Reading stops for good when so few candidates are left that resolving is cheaper.
FEW = 256
ROUNDS = 6
_INT = np.iinfo(np.int64)


def whole(vector: Column) -> Column:
    """floor(1024 x) of each component, as doubles, which hold it exactly; null where the
    vector takes no part: a null or empty one, and one with a null or non-finite
    component (or one that 1024 times is)."""
    def scaled(x: Column) -> Column:
        return F.lit(float(SCALE)) * x.cast("double")

    def fits(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(scaled(x)) & (F.abs(scaled(x)) < F.lit(float("inf")))

    # floor() gives a 64-bit number; past 2^53 a double is whole already.
    def floored(x: Column) -> Column:
        y = scaled(x)
        return F.when(F.abs(y) < F.lit(float(1 << 53)), F.floor(y).cast("double")).otherwise(y)

    return F.when((F.size(vector) > 0) & F.forall(vector, fits), F.transform(vector, floored))


def _past_64_bits(x: np.ndarray, q: np.ndarray) -> bool:
    """Whether a score, or a sum on the way to it, may be."""
    with np.errstate(over="ignore"):
        return x.size > 0 and x.shape[-1] * np.abs(x).max() * np.abs(q).max() >= 2.0 ** 62


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, cut off at the ends of 64 bits."""
    if _past_64_bits(x, q):
        numbers = [int(v) for v in q]
        sums = (sum(int(a) * b for a, b in zip(row, numbers, strict=True)) for row in x)
        return np.array([min(max(s, int(_INT.min)), int(_INT.max)) for s in sums], np.int64)
    return x.astype(np.int64) @ q.astype(np.int64)


class Lists:
    """A block of candidates: its components in sorted lists, one a dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        rising = np.argsort(self.x, axis=0, kind="stable")
        #: The components of each dimension from the lowest, and each candidate's place there.
        self.entries = np.take_along_axis(self.x, rising, axis=0)
        self.place = np.empty(rising.shape, np.int32)
        np.put_along_axis(
            self.place, rising, np.arange(len(self.ids), dtype=np.int32)[:, None], axis=0)

    def top(self, query_ids: np.ndarray, q: np.ndarray, bars: np.ndarray,
            k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query the k best (ids, scores) that reach its bar, ties to the smaller id,
        the query's own id apart."""
        # Scores that are cut off are equal, which no bound on the sums would show.
        all_of_them = len(self.ids) <= FEW or _past_64_bits(self.x, q)
        alive = None if all_of_them else self._survivors(query_ids, q, bars, k)
        for n, query_id in enumerate(query_ids):
            left = np.arange(len(self.ids)) if alive is None else np.flatnonzero(alive[n])
            left = left[self.ids[left] != query_id]
            scores = _scores(self.x[left], q[n])
            best = np.lexsort((self.ids[left], ~scores))[:k]  # ~s falls as s rises
            yield self.ids[left][best], scores[best]

    def _survivors(self, query_ids: np.ndarray, q: np.ndarray, bars: np.ndarray,
                   k: int) -> np.ndarray:
        """Who can be among the k best, after reading no more of the lists than that takes."""
        n, place = len(self.ids), self.place
        low, high = self.entries[0], self.entries[-1]
        # A list is read from the top for a positive weight, from the bottom for a negative.
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        # Sums of doubles, so a hair of slack keeps every bound on its side.
        slack = 1e-9 * (1.0 + np.abs(q) @ np.maximum(np.abs(low), np.abs(high)))
        alive = np.ones((len(q), n), bool)
        alive &= (up @ high + down @ low + slack >= bars)[:, None]
        alive &= self.ids[None, :] != query_ids[:, None]
        # What is unread counts with its list's last entry, so an entry read adds its rest.
        lower = np.repeat((up @ low + down @ high)[:, None], n, axis=1)
        step = -(-n // ROUNDS)
        for edge in range(step, n, step):
            busy = np.flatnonzero(alive.sum(axis=1) > max(FEW, k))
            if not len(busy):
                break
            u, d = up[busy], down[busy]
            tops = (place >= n - edge) & (place < n - edge + step)
            ends = (place >= edge - step) & (place < edge)
            seen = lower[busy] + u @ ((self.x - low) * tops).T + d @ ((self.x - high) * ends).T
            lower[busy] = seen
            if edge < 2 * step:
                continue
            upper = (seen + (u * (self.entries[n - 1 - edge] - low)) @ (place < n - edge).T
                     + (d * (self.entries[edge] - high)) @ (place >= edge).T)
            ranked = np.where(alive[busy], seen, -np.inf)
            best = np.partition(ranked, n - k, axis=1)[:, n - k] if n > k else -np.inf
            bar = np.maximum(best - slack[busy], bars[busy])
            # Bounds only tighten: whoever cannot reach the k-th best is out for good, and
            # no candidate is outside these lists.
            alive[busy] &= upper + slack[busy][:, None] >= bar[:, None]
        return alive


def _block(q: pd.DataFrame, c: pd.DataFrame, k: int) -> pd.DataFrame:
    parts = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
    if len(q) and len(c):
        lists = Lists(c["vec_id"].to_numpy(), np.array(c["x"].tolist(), float))
        ids = q["vec_id"].to_numpy()
        bars = q["bar"].astype(float).fillna(-np.inf).to_numpy()
        bars[bars <= float(_INT.min)] = -np.inf  # it may have been cut off there
        found = lists.top(ids, np.array(q["x"].tolist(), float), bars, k)
        for query_id, (who, scores) in zip(ids, found, strict=True):
            if len(who):
                parts.append(pd.DataFrame({"query_id": query_id, "vec_id": who, "score": scores}))
    return pd.concat(parts)


def search(vectors: DataFrame, k: int = K, every: int = EVERY,
           candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each query.

    ``vectors`` has vec_id and embedding. Queries are the rows whose vec_id is a
    multiple of ``every``; candidates are all rows of another vec_id and the same
    number of components. Repeated rows are each a candidate; a repeated query
    is asked once. A null vec_id takes no part. A score past 64 bits is given as
    their end, and such scores rank alike.
    """
    rows = vectors.select("vec_id", whole(F.col("embedding")).alias("x")).where(
        "vec_id is not null and x is not null").withColumn("d", F.size("x"))
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    # The same columns under ids of their own, as both sides come from one table.
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])
    n, m = rows.count(), asked.count()
    n_c, n_q = -(-n // candidates) or 1, -(-m // queries) or 1

    def spread(df: DataFrame, own: str, blocks: int, other: str, others: list[int]) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).withColumn(
            other, F.explode(F.array(*[F.lit(x).cast("long") for x in others])
                             if len(others) < 2 else
                             F.sequence(F.lit(others[0]).cast("long"), F.lit(others[-1]).cast("long"))))

    def found(q: DataFrame, blocks: list[int]) -> DataFrame:
        left = spread(q, "qb", n_q, "cb", blocks).groupBy("d", "qb", "cb")
        right = spread(rows, "cb", n_c, "qb", list(range(n_q))).where(
            F.col("cb").between(blocks[0], blocks[-1])).groupBy("d", "qb", "cb")
        return left.cogroup(right).applyInPandas(
            lambda a, b: _block(a, b, k), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = F.row_number().over(best)
    none = F.lit(None).cast("long")
    all_found = found(asked.withColumn("bar", none), [0])
    if n_c > 1:
        first = store(all_found, "topk-first")
        # What the k-th best of one block scores, the k-th best of all does at least.
        bars = first.withColumn("rank", ranked).where(F.col("rank") == k).select(
            F.col("query_id").alias("vec_id"), F.col("score").alias("bar"))
        all_found = first.unionByName(
            found(asked.join(bars, "vec_id", "left"), list(range(1, n_c))))
    return all_found.withColumn("rank", ranked).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
