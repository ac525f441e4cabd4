"""Connected components of a graph that is a table of edges.

Alternating star contraction: every vertex tells its larger neighbours its
least neighbour, then its smaller neighbours and itself theirs, until the edges
are stars around the least vertex of each component. A step is an aggregate (a
minimum, which combines before the shuffle) and a join back on the same key, so
no neighbourhood is ever gathered, and a vertex with very many edges is a long
key that a skewed join may split. Each step ends in a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.shared import apart, drop_stored, store


def _least(edges: DataFrame) -> DataFrame:
    """u, v edges -> u and the least of u and its neighbours v."""
    return apart(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.where("v > u").join(_least(both), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    return (
        down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
    )


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """u, v edges of long ids (in any direction, repeats allowed) -> id, component.

    Each vertex of an edge with the least vertex that edges reach from it. Edges
    from a vertex to itself, and edges with a null end, join nothing.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
        ).first())

    stars = store(edges.where("u <> v").select(
        F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")
    ).distinct(), label)
    seen = state(stars)
    while True:
        new = store(_small_star(_large_star(stars)), label)
        now = state(new)
        drop_stored(stars)
        stars = new
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
