"""Embedding near-dedup: spherical k-means cells, blocked products inside cells.

Every vector goes to the cell of its nearest centre, and as a guest to the cells
whose border it is near enough to have a neighbour behind. Cells that are still
large are cut again by centres of their own. Inside a cell, blocks of rows are
multiplied with each other. A block pair returns, per row, a count of its links
and one edge to the least row it is connected to there, so a dense group of copies
costs arithmetic but never a list of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.components import components
from tickhouse.llm.shared import sample, store

COSINE = 0.93
#: The longest step between two linked unit vectors.
STEP = (2 - 2 * COSINE) ** 0.5
#: Centres are fitted on at most so many vectors, the first in order of a hash.
FIT_ROWS = 20_000
MAX_CELLS = 1024
#: Cells of more rows are cut again, by centres fitted on about so many of their rows.
SPLIT_ROWS, SPLIT_FIT, SPLIT_CELLS = 16_384, 4_096, 256
#: Rows of a large cell that one task assigns.
ASSIGN_ROWS = 8_192
BLOCK = 1024
#: Spreads that the part of a link's step across a border may have.
REACH = 3.0
#: What moving a row into one more cell costs, in products of two rows.
MOVE = 500


def valid(vector: Column) -> Column:
    """Not null, not empty, all components finite, and not all zero."""
    return (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < F.lit(float("inf")))
    ) & F.exists(vector, lambda x: x != 0)


def unit(rows: pd.Series) -> np.ndarray:
    x = np.array(rows.tolist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares then neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(x: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: unit centres, started from spread-out rows."""
    centres = x[np.linspace(0, len(x) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        home = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def limits_of(x: np.ndarray, centres: np.ndarray, reach: float) -> np.ndarray:
    """How far behind the border of two cells a guest may stand, for every two cells.

    Two linked rows on different sides of a border are, across it, at most a step
    apart, so the nearer one is at most half a step from it: with that limit no link
    is lost. Steps point in all directions that the rows themselves are spread in, so
    where that spread across the border is small (of the rows of both cells, against
    their spread in all directions), half of ``reach`` spreads of a step is enough.
    """
    k = len(centres)
    n, first, second = np.zeros(k), np.zeros((k, k)), np.zeros((k, k))
    sums = np.zeros_like(centres)
    apart = _apart(centres)
    for rows in np.array_split(x, max(1, len(x) // 2048)):
        dots = rows @ centres.T
        home = dots.argmax(axis=1)
        margin = (dots[np.arange(len(rows)), home][:, None] - dots) / apart[home]
        at = np.zeros((k, len(rows)))
        at[home, np.arange(len(rows))] = 1
        n, first, second, sums = n + at.sum(axis=1), first + at @ margin, \
            second + at @ margin**2, sums + at @ rows
    both = np.maximum(n[:, None] + n[None, :], 1)
    across = (second + second.T) / both - ((first - first.T) / both) ** 2
    norms = sums @ sums.T
    own = np.diag(norms)
    spread = 1 - (own[:, None] + own[None, :] + 2 * norms) / both**2
    share = np.clip(across / np.maximum(spread, 1e-9), 1 / x.shape[1], 1)
    share[n[:, None] + n[None, :] < 8] = 1
    return np.minimum(STEP / 2, reach / 2 * STEP * np.sqrt(share)) + 1e-9


def _apart(centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 1e-12))


def cells_of(x: np.ndarray, centres: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """A mask of the cells that each row is in, at home or as a guest."""
    dots = x @ centres.T
    home = dots.argmax(axis=1)
    margin = (dots[np.arange(len(x)), home][:, None] - dots) / _apart(centres)[home]
    inside = margin <= limits[home]
    inside[np.arange(len(x)), home] = True
    return inside


def plan_cells(x: np.ndarray, groups: np.ndarray, n: float, most: int, reach: float,
               move: float = MOVE, cells: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Centres and limits for ``n`` rows like the sample ``x``, compared inside ``groups``.

    Of 1, 4, 16, ... cells the number that costs least on the sample: a row is
    multiplied with the centres, moved to its cells and multiplied with their rows.
    Where rows are guests nearly everywhere that is one cell.
    """
    tries, k = [], 1
    while k <= min(most, max(1, len(x) // 16)):
        tries.append(k)
        k *= 4
    best = None
    for k in [min(cells, len(x))] if cells else tries:
        centres = fit(x, k)
        limits = limits_of(x, centres, reach)
        inside = np.vstack([cells_of(rows, centres, limits)
                            for rows in np.array_split(x, max(1, len(x) // 2048))])
        pairs = sum(float((inside[groups == g].sum(axis=0, dtype=float) ** 2).sum())
                    for g in np.unique(groups)) / len(x) ** 2 * n
        cost = k + move * inside.sum() / len(x) + pairs
        if best is None or cost < best[0]:
            best = cost, centres, limits
    return best[1:]


def _members(lists: pd.Series, known: np.ndarray) -> np.ndarray:
    """Which of the ``known`` cells, in order, each list holds."""
    out = np.zeros((len(lists), len(known)), np.float32)
    row = np.repeat(np.arange(len(lists)), [len(c) for c in lists])
    cell = np.concatenate([np.asarray(c, np.int64) for c in lists])
    at = np.searchsorted(known, cell)
    held = at < len(known)
    held[held] = known[at[held]] == cell[held]
    out[row[held], at[held]] = 1
    return out


def _links(a: pd.DataFrame, b: pd.DataFrame | None, cell: int) -> np.ndarray:
    """The links of one block (b is None) or between two that this cell counts.

    A pair is counted in the least of the cells that both rows are in.
    """
    other = a if b is None else b
    near = unit(a["x"]) @ unit(other["x"]).T >= COSINE
    if b is None:
        near[np.arange(len(a)), np.arange(len(a))] = False
    if not near.any():
        return near
    less = np.unique(np.concatenate([np.asarray(c, np.int64) for c in a["cells"]]))
    less = less[less < cell]
    if len(less):
        near &= _members(a["cells"], less) @ _members(other["cells"], less).T == 0
    return near


def _spread_least(linked: np.ndarray, least_a: np.ndarray, least_b: np.ndarray) -> None:
    """Give both sides of every link the least id that links reach."""
    while True:
        top = np.iinfo(np.int64).max
        new_a = np.minimum(least_a, np.where(linked, least_b[None, :], top).min(axis=1))
        new_b = np.minimum(least_b, np.where(linked, new_a[:, None], top).min(axis=0))
        if (new_a == least_a).all() and (new_b == least_b).all():
            return
        least_a[:], least_b[:] = new_a, new_b


def _block_pair(rows: pd.DataFrame) -> pd.DataFrame:
    cell, i, j = (int(rows[c].iloc[0]) for c in ("cell", "i", "j"))
    a = rows[rows["block"] == i].reset_index(drop=True)
    b = None if i == j else rows[rows["block"] == j].reset_index(drop=True)
    out = []
    if len(a) and (b is None or len(b)):
        linked = _links(a, b, cell)
        other = a if b is None else b
        least_a, least_b = a["id"].to_numpy().copy(), other["id"].to_numpy().copy()
        if b is None:
            least_b = least_a
        if linked.any():
            if b is None:
                least_b = least_a.copy()
            _spread_least(linked, least_a, least_b)
        counts = (linked * other["copies"].to_numpy()[None, :]).sum(axis=1)
        out.append(pd.DataFrame({"id": a["id"], "n": counts, "least": least_a}))
        if b is not None:
            counts = (linked * a["copies"].to_numpy()[:, None]).sum(axis=0)
            out.append(pd.DataFrame({"id": b["id"], "n": counts, "least": least_b}))
    found = pd.concat(out) if out else pd.DataFrame({"id": [], "n": [], "least": []})
    return found[found["n"] > 0].astype("int64")


def links(vectors: DataFrame, label: str = "vectors", reach: float = REACH,
          cells: int | None = None, split: int = SPLIT_ROWS, block: int = BLOCK,
          move: float = MOVE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vec_id, embedding, label.

    Equal vectors of a label are one vector with a number of copies while pairs
    are compared. Rows of a null label, and vectors that ``valid`` refuses, link
    with nothing. Vectors of different lengths never link. A vec_id that comes
    twice counts as two vectors. A row whose vec_id is null is its own component.
    ``cells`` fixes the number of first cells, which a sample decides otherwise;
    cells of more than ``split`` rows are cut again where that saves work.
    """
    ok = F.coalesce(valid(F.col("embedding")), F.lit(False)) & F.col("label").isNotNull() & \
        F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "label", "embedding", ok.alias("ok"))
    distinct = store(
        rows.where("ok").groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), label)
    # One length of vectors after another: usually there is a single one.
    sizes = [(r[0], r[1]) for r in distinct.groupBy(F.size("embedding")).count().collect()]
    parts = [_cells(distinct.where(F.size("embedding") == size), size, n, reach, move, cells)
             for size, n in sizes]
    if parts:
        in_cells = parts[0]
        for p in parts[1:]:
            in_cells = in_cells.union(p)
        in_cells = _cut_large(store(in_cells, f"{label}-cells"), reach, split, move, label)
        group = ("d", "label", "cell")
        blocks = in_cells.groupBy(*group).agg(
            F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
        pairs = in_cells.join(blocks, list(group)).withColumn(
            "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        placed = pairs.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = placed.select(
            *group, F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"),
            "block", "id", "copies", "x", "cells")
        found = store(placed.groupBy(*group, "i", "j").applyInPandas(
            _block_pair, "id long, n long, least long"), f"{label}-links")
    else:
        found = vectors.sparkSession.createDataFrame([], "id long, n long, least long")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("id").alias("u"), F.col("least").alias("v")), label)
    classes = (
        distinct.join(counts, "id", "left").join(joined, "id", "left")
        .select(F.col("label").alias("l"), F.col("embedding").alias("e"),
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "id").alias("component_id")))
    linked = rows.where("ok").join(
        classes, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")))
    alone = rows.where("not ok").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _cells(distinct: DataFrame, size: int, n: int, reach: float, move: float,
           cells: int | None) -> DataFrame:
    """Each distinct vector once in its home cell and once in each as a guest."""
    rows = sample(distinct, "id", FIT_ROWS).select("label", "embedding").toPandas()
    centres, limits = plan_cells(unit(rows["embedding"]), pd.factorize(rows["label"])[0],
                                 n, MAX_CELLS, reach, move, cells)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            inside = cells_of(unit(batch["embedding"]), centres, limits)
            at, cell = np.nonzero(inside)
            lists = np.array([np.flatnonzero(m).tolist() for m in inside] + [None], object)[:-1]
            out = batch.iloc[at].rename(columns={"embedding": "x"})
            yield out.assign(d=size, cell=cell, cells=lists[at])[
                ["d", "label", "cell", "id", "copies", "x", "cells"]]

    kind = distinct.schema["label"].dataType.simpleString()
    vector = distinct.schema["embedding"].dataType.simpleString()
    return distinct.select("label", "embedding", "id", "copies").mapInPandas(
        assign, f"d int, label {kind}, cell long, id long, copies long, x {vector}, "
                "cells array<long>")


def _cut_large(in_cells: DataFrame, reach: float, split: int, move: float,
               label: str) -> DataFrame:
    """Cells of over ``split`` rows cut by centres of their own, until none pays.

    A cell's centres are fitted on rows that a share of the hash range picks, about
    ``SPLIT_FIT``. Its rows are then dealt to as many tasks as they need, each of
    which gets the centres too. A cell that is one dense group stays as it is.
    """
    group = ["d", "label", "cell"]
    columns, kinds = in_cells.columns, in_cells.schema
    rows, settled, cut = in_cells, [], False
    while True:
        large = store(rows.groupBy(*group).count().where(F.col("count") > split),
                      f"{label}-large")
        if large.isEmpty():
            break
        span = 1 << 31
        place = F.pmod(F.xxhash64(F.lit(12), "id"), F.lit(span))
        picked = rows.join(large, group).where(
            place < F.lit(float(span)) * SPLIT_FIT / F.col("count"))

        def plan(few: pd.DataFrame) -> pd.DataFrame:
            n = int(few["count"].iloc[0])
            x = unit(few["x"])
            centres, limits = plan_cells(x, np.zeros(len(x)), n, SPLIT_CELLS, reach, move)
            out = few[group].head(1).assign(n=n)
            out["centres"], out["limits"] = [centres.ravel()], [limits.ravel()]
            return out if len(centres) > 1 else out.head(0)

        kind = kinds["label"].dataType.simpleString()
        plans = store(picked.groupBy(*group).applyInPandas(
            plan, f"d int, label {kind}, cell long, n long, "
                  "centres array<double>, limits array<double>"), f"{label}-plans")
        if plans.isEmpty():
            break
        cut = True
        parts = plans.select(*group, F.ceil(F.col("n") / F.lit(ASSIGN_ROWS)).alias("parts"))
        dealt = rows.join(parts, group).withColumn(
            "part", F.pmod(F.xxhash64(F.lit(13), "id"), F.col("parts"))).drop("parts")
        tools = plans.withColumn("part", F.explode(F.sequence(
            F.lit(0).cast("long"), F.ceil(F.col("n") / F.lit(ASSIGN_ROWS)) - 1)))

        def assign(some: pd.DataFrame, tool: pd.DataFrame) -> pd.DataFrame:
            if not len(some):
                return some[columns]
            centres = np.array(tool["centres"].iloc[0]).reshape(-1, int(some["d"].iloc[0]))
            limits = np.array(tool["limits"].iloc[0]).reshape(len(centres), len(centres))
            at, sub = np.nonzero(cells_of(unit(some["x"]), centres, limits))
            out = some.iloc[at]
            # The new cell's number: a hash of the old one's and its place there.
            old = out["cell"].to_numpy().astype(np.uint64)
            with np.errstate(over="ignore"):
                new = (old * np.uint64(0x9E3779B97F4A7C15) + sub.astype(np.uint64)
                       + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
                new ^= new >> np.uint64(29)
            return out.assign(cell=new.astype(np.int64))[columns]

        settled.append(rows.join(plans.select(*group), group, "left_anti"))
        keys = [*group, "part"]
        rows = store(dealt.groupBy(*keys).cogroup(tools.groupBy(*keys)).applyInPandas(
            assign, kinds), f"{label}-cut")
    if not cut:
        return in_cells
    for s in settled:
        rows = rows.unionByName(s.select(*columns))
    # A row's cells were cut apart from each other: list them anew.
    same = [F.col("label").alias("l"), F.col("id").alias("i"), F.xxhash64("x").alias("h")]
    rows = store(rows, f"{label}-all")
    lists = rows.groupBy(*same).agg(F.collect_set("cell").alias("all"))
    return store(rows.join(lists, (F.col("label") == F.col("l")) & (F.col("id") == F.col("i"))
                           & (F.xxhash64("x") == F.col("h")))
                 .withColumn("cells", F.col("all")).select(*columns), f"{label}-listed")
