"""Portable result types, so a result compares with any SQL engine's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _portable(field: T.StructField, digits: int) -> Column:
    c = F.col(f"`{field.name}`")
    dt = field.dataType
    if isinstance(dt, T.DecimalType | T.DoubleType | T.FloatType):
        # Through a decimal, so a tie rounds half up on the printed digits.
        c = F.round(c.cast("decimal(38,12)"), digits).cast("double")
    elif isinstance(dt, T.TimestampType):
        c = c.cast("timestamp_ntz")
    elif isinstance(dt, T.IntegralType):
        c = c.cast("bigint")
    elif isinstance(dt, T.DateType):
        c = c.cast("string")
    return c.alias(field.name)


def present(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Select ``columns`` (default all) with decimals as rounded doubles, UTC times as NTZ."""
    picked = df.select(*columns) if columns else df
    return picked.select(*[_portable(f, digits) for f in picked.schema])
