"""DataFrame -> DataFrame operators; no I/O of their own.

An operator that reads an intermediate result more than once takes ``stage``, a
function that stores a frame and returns the stored table
(:func:`tickhouse.sources.staged.stage`), so that the work above it runs once.
Without it the result is the same and the plan repeats that work.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame

Stage = Callable[[DataFrame], DataFrame]


def keep_lazy(df: DataFrame) -> DataFrame:
    return df
