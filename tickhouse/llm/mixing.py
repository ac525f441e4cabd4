"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order, read up to three
times. A reading of a document has the virtual finish time

    (words of the source up to and including it, earlier readings counted) / target

and the mix is the readings in order of that time until the budget is used up.
The running sums are never taken over a whole source in one task: the shuffle
key's leading bits cut a source into slices, slice totals give each slice its
offset, and a window runs inside a slice.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.shared import WORD, slice_bits, store, unused

WEIGHTS = (5, 2, 1)
MAX_READINGS = 3
KEY_BITS = 60


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size in words of each row; a null text has none."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(totals: DataFrame, weights=WEIGHTS, readings: int = MAX_READINGS) -> DataFrame:
    """source, source_size -> the same with weight and target.

    Sources in code point order (null last) take the weights in turn. Sharing the
    excess of sources at their ceiling again and again ends where every other
    source stands at one level times its weight, so the level is found directly:
    sources in order of ceiling over weight, the first that the remaining words
    per remaining weight do not lift above its ceiling. One row per source.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("turn", (F.row_number().over(everything) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("turn") + 1)
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn(
        "ceiling", F.col("source_size") * readings)
    by_ratio = Window.orderBy(
        F.col("ceiling").cast("double") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("ceiling").over(before), F.lit(0)))
        .cast("double") / F.sum("weight").over(onwards)
    )
    levelled = ranked.withColumn("level", level)
    holds = F.col("level") * F.col("weight") <= F.col("ceiling")
    found = levelled.withColumn("level", F.min(
        F.when(holds, F.struct(F.col("ceiling").cast("double") / F.col("weight"), "level"))
    ).over(whole)["level"])
    return found.select(
        "source", "source_size", "weight",
        F.least(F.col("ceiling").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def _last_finish(readings: DataFrame, budget: int, first_slices: int = 4096) -> float | None:
    """The greatest finish time at which the readings so far stay within the budget.

    Radix search over the global order: totals of equal ranges of finish time,
    then of the range where the budget ends, until its readings share one time.
    Each round is one aggregate whose result is a table of ``first_slices`` rows.
    """
    bounds = readings.agg(F.min("finish"), F.max("finish"), F.sum("size")).first()
    if bounds[0] is None:
        return None
    low, high, used, best = bounds[0], bounds[1], 0, None
    if bounds[2] <= budget:
        return high
    for _ in range(64):
        width = (high - low) / first_slices
        inside = readings.where(F.col("finish").between(low, high))
        number = (
            F.least(F.floor((F.col("finish") - low) / width), F.lit(first_slices - 1))
            if width > 0 else F.lit(0)
        )
        rows = (
            inside.groupBy(number.alias("n"))
            .agg(F.sum("size").alias("size"), F.min("finish").alias("low"),
                 F.max("finish").alias("high"))
            .orderBy("n").collect()
        )
        for row in rows:
            if used + row["size"] > budget:
                low, high = row["low"], row["high"]
                break
            used, best = used + row["size"], row["high"]
        if low == high or math.nextafter(low, high) == high and used > budget:
            break
    return best


def plan(docs: DataFrame, weights=WEIGHTS, readings: int = MAX_READINGS,
         per_slice: int = 4096, label: str = "mix") -> DataFrame:
    """One row per (doc_id, source, size): copies, source_size, target, and the
    finish time and number of the readings that the mix takes.

    Rows equal in these three columns are copies of one unit and share a finish
    time. Empty documents have size 0 and are read like others; a source of
    empty documents has target 0 and no reading. No rows give no rows.
    """
    units = store(
        sizes(docs).groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")), label)
    words = F.col("size") * F.col("copies")
    shares = store(targets(
        units.groupBy("source").agg(F.sum(words).alias("source_size")), weights, readings),
        f"{label}-targets")
    rows, total = units.agg(F.count("*"), F.sum(words)).first()
    # Any key that is the same in other engines does; it shuffles doc_id.
    key = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, KEY_BITS // 4), 16, 10)
    keyed = units.withColumn("key", F.coalesce(key.cast("long"), F.lit(0))).withColumn(
        "slice", F.shiftright("key", KEY_BITS - slice_bits(rows, per_slice)))
    ends = keyed.groupBy("source", "slice").agg(F.sum(words).alias("in_slice"))
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = ends.select(
        F.col("source").alias("s"), F.col("slice").alias("c"),
        F.coalesce(F.sum("in_slice").over(upto), F.lit(0)).alias("offset"))
    in_slice = Window.partitionBy("source", "slice").orderBy(
        "key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = (
        keyed.withColumn("inner", F.sum(words).over(in_slice))
        .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("c")))
        .withColumn("upto", F.col("offset") + F.col("inner"))
        .drop("s", "c", "offset", "inner", "key", "slice")
        .join(shares.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
    )
    queued = store(queued, f"{label}-queue")
    times = [
        F.when(F.lit(n) * F.col("source_size") < F.col("target"),
               (F.lit(n) * F.col("source_size") + F.col("upto")).cast("double") / F.col("target"))
        for n in range(readings)
    ]
    queued = queued.withColumn("finishes", F.array_compact(F.array(*times)))
    cut = _last_finish(
        queued.select(words.alias("size"), F.explode("finishes").alias("finish")), total or 0)
    taken = F.filter("finishes", lambda t: t <= F.lit(-1.0 if cut is None else cut))
    return queued.select(
        "doc_id", "source", "size", "copies", "source_size", "target",
        taken.alias("finishes"), F.size(taken).alias("readings"))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed documents: a row per reading, in the order of finish time.

    The rows are range-partitioned by finish time over all partitions, so files
    written in partition order hold the mix. Columns are those of ``docs``.
    """
    size, finish = unused(docs, "__size"), unused(docs, "__finish")
    joined = docs.withColumn(
        size, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")).alias("d")
    planned = plan(docs, **kw).where("readings > 0").alias("p")
    on = (
        F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
        & F.col("d.source").eqNullSafe(F.col("p.source"))
        & (F.col(f"d.{size}") == F.col("p.size"))
    )
    return (
        joined.join(planned, on)
        .select(*[F.col(f"d.`{c}`") for c in docs.columns],
                F.explode("p.finishes").alias(finish))
        .repartitionByRange(F.col(finish), F.col("doc_id"))
        .sortWithinPartitions(finish, "doc_id").drop(finish)
    )


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, words taken."""
    planned = plan(docs)
    return planned.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("readings")).alias("taken"))
