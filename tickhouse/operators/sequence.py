"""What a venue update id says about delivery, as a batch operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.operators.ordered import running_max_before


def observe_sequence(
    messages: DataFrame,
    key: Sequence[str] = ("symbol",),
    id_col: str = "update_id",
    arrival: Sequence[str] = ("kafka_offset",),
    session: str | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Compare each id with the highest one that arrived before it.

    ``first_seen``: nothing to compare with. ``regressed``: the id did not
    advance (a replay or reordering). ``span``: book updates passed over, which
    is churn and not loss. ``session`` restarts the comparison after a
    reconnect. By default rows are chunked by ranges of the arrival offset.
    """
    keys = [*key, *([session] if session else [])]
    cut = chunk if chunk is not None else F.floor(F.col(arrival[0]) / F.lit(100_000))
    seen = running_max_before(messages, keys, arrival, cut, id_col, "__high")
    first = F.col("__high").isNull()
    back = F.coalesce(F.col(id_col) <= F.col("__high"), F.lit(False))
    return seen.withColumns(
        {
            "first_seen": first,
            "regressed": back,
            "span": F.when(first | back, F.lit(0)).otherwise(
                F.col(id_col) - F.col("__high") - 1
            ).cast("bigint"),
        }
    ).drop("__high")
