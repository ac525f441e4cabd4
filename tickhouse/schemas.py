"""Record contracts and table schemas.

Writers never infer a schema: every table below is declared, and new fields are
only ever appended with a null default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.functions.money import MONEY

VENUE = "binance"
FX_SOURCE = "banrep-trm"
SCHEMA_VERSION = 1


def _struct(*fields: tuple) -> T.StructType:
    out = T.StructType()
    for name, dtype, *nullable in fields:
        out.add(name, dtype, nullable[0] if nullable else False)
    return out


_S, _L, _I, _B, _TS = (T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(),
                       T.TimestampType())
_OPT = True

TRADE = _struct(
    ("schema_version", _I), ("exchange", _S), ("symbol", _S), ("trade_id", _L),
    ("price", MONEY), ("quantity", MONEY), ("quote_quantity", MONEY, _OPT),
    ("buyer_is_maker", _B), ("trade_time", _TS), ("event_time", _TS), ("ingested_at", _TS),
    ("producer_id", _S), ("raw_payload", _S, _OPT),
)
QUOTE = _struct(
    ("schema_version", _I), ("exchange", _S), ("symbol", _S), ("update_id", _L),
    ("bid_price", MONEY), ("bid_quantity", MONEY), ("ask_price", MONEY), ("ask_quantity", MONEY),
    ("event_time", _TS), ("ingested_at", _TS), ("producer_id", _S), ("raw_payload", _S, _OPT),
)
KLINE = _struct(
    ("schema_version", _I), ("exchange", _S), ("symbol", _S), ("interval", _S),
    ("open_time", _TS), ("close_time", _TS), ("open", MONEY), ("high", MONEY), ("low", MONEY),
    ("close", MONEY), ("volume", MONEY), ("quote_volume", MONEY), ("trade_count", _L),
    ("taker_buy_base_volume", MONEY), ("taker_buy_quote_volume", MONEY), ("is_closed", _B),
    ("ingested_at", _TS), ("producer_id", _S), ("raw_payload", _S, _OPT),
)
FX_RATE = _struct(
    ("schema_version", _I), ("source", _S), ("base_currency", _S), ("quote_currency", _S),
    ("rate", MONEY), ("valid_from", _TS), ("valid_to", _TS), ("ingested_at", _TS),
    ("producer_id", _S), ("raw_payload", _S, _OPT),
)
DEAD_LETTER = _struct(
    ("schema_version", _I), ("origin_topic", _S), ("origin_stream", _S, _OPT),
    ("error_type", _S), ("error_message", _S), ("raw_payload", _S), ("failed_at", _TS),
    ("producer_id", _S), ("payload_length", _L, _OPT),
)
INSTRUMENT_OBSERVATION = _struct(
    ("symbol", _S), ("base_asset", _S), ("quote_asset", _S), ("status", _S),
    ("observed_at", _TS), ("tick_size", MONEY, _OPT), ("step_size", MONEY, _OPT),
    ("min_notional", MONEY, _OPT),
)
INSTRUMENT_REFERENCE = _struct(
    ("symbol", _S), ("base_asset", _S), ("quote_asset", _S), ("instrument_class", _S),
    ("tick_size", MONEY), ("step_size", MONEY), ("min_notional", MONEY), ("is_tracked", _B),
    ("listed_on", T.DateType()),
)

# Message envelope columns carried from the broker into every landed row.
ENVELOPE = _struct(
    ("_kafka_topic", _S, _OPT), ("_kafka_partition", _I, _OPT), ("_kafka_offset", _L, _OPT),
    ("_kafka_timestamp", _TS, _OPT), ("_kafka_key", _S, _OPT), ("_ingested_at", _TS, _OPT),
    ("_source", _S, _OPT),
)
QUARANTINE = T.StructType(
    [f for f in ENVELOPE if f.name != "_source"] + [T.StructField("_reason", _S)]
)

# Shape of a broker message before decoding.
MESSAGE = _struct(
    ("topic", _S), ("partition", _I), ("offset", _L), ("timestamp", _TS),
    ("key", T.BinaryType(), _OPT), ("value", T.BinaryType(), _OPT),
)

RECORDS = {"trade": TRADE, "quote": QUOTE, "kline": KLINE, "fx_rate": FX_RATE}

NATURAL_KEYS = {
    "trade": ("exchange", "symbol", "trade_id"),
    "quote": ("exchange", "symbol", "update_id"),
    "kline": ("exchange", "symbol", "interval", "open_time"),
    "fx_rate": ("source", "base_currency", "quote_currency", "valid_from"),
}


def partition_key(kind: str) -> Column:
    """The value that keeps one instrument's messages in order."""
    if kind == "kline":
        return F.concat_ws(":", "symbol", "interval")
    if kind == "fx_rate":
        return F.concat("base_currency", "quote_currency")
    return F.col("symbol")


def landed(kind: str) -> T.StructType:
    """Record columns plus the envelope: the bronze table of ``kind``."""
    return T.StructType(list(RECORDS[kind]) + list(ENVELOPE))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: missing nullable columns become null, types are cast."""
    have = set(df.columns)
    missing = [f.name for f in schema if f.name not in have and not f.nullable]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
