"""Quality classifier: regularised quadratic discriminant over text statistics.

A document becomes a short vector of logarithms of rates (letters, digits, marks,
repeated words and lines). Each class has a mean and a covariance shrunk towards
its own average variance; a score is the posterior from the difference of the two
Gaussian log densities, whose Mahalanobis distances use stored Cholesky factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.shared import sample

#: Training takes at most so many labelled rows, the first in order of a hash.
TRAIN_ROWS = 20_000
SHRINKAGE = 0.05
CUT = 0.3
FOLDS, HELD_OUT = 5, 0

# Bytes that are counted together.
GROUPS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789",
    b".,;:", b"!?", b"*&$%#@", b"|<>[]{}\\/=+~^", b"\"'()-_", b"\n", bytes(range(128, 256)),
)
_GROUP_OF = np.full(256, len(GROUPS))
for _i, _g in enumerate(GROUPS):
    _GROUP_OF[list(_g)] = _i
N_FEATURES = len(GROUPS) + 6


def features(text: str | None) -> np.ndarray:
    """The transformed statistics of one text; a null text is an empty one."""
    data = (text or "").encode(errors="replace")
    per_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    counts = np.bincount(_GROUP_OF, weights=per_byte, minlength=len(GROUPS) + 1)[:len(GROUPS)]
    words, lines = data.split(), data.split(b"\n")
    n = len(words)
    out = np.empty(N_FEATURES)
    out[:len(GROUPS)] = np.log((counts + 0.5) / (len(data) + 20.0))
    distinct, twice = len(set(words)), sum(map(eq, words, words[1:]))
    out[len(GROUPS):] = (
        np.log1p(n), np.log((sum(map(len, words)) + 5.0) / (n + 1.0)),
        np.log((n - distinct + 0.5) / (n + 1.0)), np.log((twice + 0.5) / (n + 1.0)),
        np.log((len(lines) - len(set(lines)) + 0.5) / (len(lines) + 1.0)),
        np.log((max(map(len, words)) if words else 0) + 1.0),
    )
    return out


@dataclass
class Discriminant:
    """Per class: mean, inverse Cholesky factor, log determinant, log prior."""

    means: np.ndarray
    inverses: np.ndarray
    log_dets: np.ndarray
    priors: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The posterior of class 1 for each row of x."""
        logs = [
            prior - 0.5 * (log_det + (((x - mean) @ inverse.T) ** 2).sum(axis=1))
            for mean, inverse, log_det, prior in
            zip(self.means, self.inverses, self.log_dets, self.priors, strict=True)
        ]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(x: np.ndarray, labels: np.ndarray, shrinkage: float = SHRINKAGE) -> Discriminant:
    """With no row of a class, its statistics are those of standard normal rows."""
    parts = []
    for k in (0, 1):
        rows = x[labels == k]
        mean = rows.mean(axis=0) if len(rows) else np.zeros(x.shape[1])
        spread = np.cov(rows.T, bias=True) if len(rows) > 1 else np.eye(x.shape[1])
        level = max(np.trace(spread) / x.shape[1], 1e-6)
        shrunk = (1 - shrinkage) * spread + shrinkage * level * np.eye(x.shape[1])
        factor = np.linalg.cholesky(shrunk)
        parts.append((mean, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(),
                      np.log((len(rows) + 1) / (len(x) + 2))))
    return Discriminant(*(np.array(p) for p in zip(*parts, strict=True)))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Discriminant:
    """Fitted on at most ``rows`` labelled documents outside the held-out fold."""
    marked = labels.where("doc_id is not null and quality in (0, 1)").where(
        F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT)
    chosen = sample(marked.groupBy("doc_id").agg(
        F.max(F.col("quality").cast("int")).alias("quality")), "doc_id", rows)
    # At most ``rows`` pairs of numbers, so this side can be sent to every task.
    pairs = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"],
                                "x": [features(t) for t in batch["text"]]})

    found = pairs.mapInPandas(measure, "doc_id bigint, quality int, x array<double>")
    # Rows that repeat a doc_id would pass the bound; one of each text is enough.
    local = found.dropDuplicates(["doc_id"]).orderBy("doc_id").limit(rows).toPandas()
    x = np.array(local["x"].tolist()).reshape(-1, N_FEATURES)
    return fit(x, local["quality"].to_numpy(dtype=int))


def score(docs: DataFrame, model: Discriminant) -> DataFrame:
    """``docs`` with a column score; the texts are read once and not shuffled."""
    @F.pandas_udf("double")
    def posterior(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([features(t) for t in batch]).reshape(-1, N_FEATURES)
            yield pd.Series(model.scores(x))

    return docs.withColumn("score", posterior("text"))


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents whose score reaches the cut, with their own columns."""
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    text = f"c{docs.columns.index('text')}"
    scored = score(renamed.withColumn("text", F.col(text)), train(docs, labels)).where(
        F.col("score") >= cut)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def digest(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs.select("doc_id", "text"), train(docs, labels)).select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT,
                   F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= cut).cast("int").alias("predicted"))
