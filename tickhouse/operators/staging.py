"""Landed tables -> canonical columns: rename, cast and derive per row, nothing else.

Narrow transformations only, so column pruning and pushed filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import clock, money
from tickhouse.functions.money import MONEY


def stage_trades(landed: DataFrame) -> DataFrame:
    """The matching-engine time becomes ``event_time``; the venue envelope time is kept apart."""
    return landed.select(
        F.col("exchange").alias("exchange_id"),
        "symbol",
        "trade_id",
        F.col("price").cast(MONEY).alias("price"),
        F.col("quantity").cast(MONEY).alias("quantity"),
        F.col("quote_quantity").cast(MONEY).alias("notional"),
        "buyer_is_maker",
        (~F.col("buyer_is_maker")).alias("is_buyer_aggressor"),
        F.col("trade_time").alias("event_time"),
        F.col("event_time").alias("venue_publish_time"),
        F.col("ingested_at").alias("producer_ingested_at"),
        F.col("_ingested_at").alias("lake_ingested_at"),
        F.col("_kafka_topic").alias("kafka_topic"),
        F.col("_kafka_partition").alias("kafka_partition"),
        F.col("_kafka_offset").alias("kafka_offset"),
        "producer_id",
        "schema_version",
        clock.millis_between(F.col("trade_time"), F.col("ingested_at")).alias("ingestion_lag_ms"),
    )


def assign_bars(trades: DataFrame) -> DataFrame:
    """Signed size plus the one- and five-minute bar each trade belongs to."""
    q = F.col("quantity")
    return trades.withColumns(
        {
            "signed_quantity": F.when(F.col("is_buyer_aggressor"), q).otherwise(-q),
            "bar_start_1m": clock.bar_floor(F.col("event_time"), 60),
            "bar_start_5m": clock.bar_floor(F.col("event_time"), 300),
        }
    )


def stage_quotes(landed: DataFrame) -> DataFrame:
    bid, ask = F.col("bid_price"), F.col("ask_price")
    return landed.select(
        F.col("exchange").alias("exchange_id"),
        "symbol",
        "update_id",
        *[F.col(c).cast(MONEY).alias(c)
          for c in ("bid_price", "bid_quantity", "ask_price", "ask_quantity")],
        money.mid_price(bid, ask).alias("mid_price"),
        money.spread_bps(bid, ask).alias("spread_bps"),
        (ask - bid).cast(MONEY).alias("spread_absolute"),
        money.touch_imbalance(F.col("bid_quantity"), F.col("ask_quantity")).alias("touch_imbalance"),
        "event_time",
        F.col("ingested_at").alias("producer_ingested_at"),
        F.col("_ingested_at").alias("lake_ingested_at"),
        F.col("_kafka_partition").alias("kafka_partition"),
        F.col("_kafka_offset").alias("kafka_offset"),
        "producer_id",
        "schema_version",
    )


def stage_klines(landed: DataFrame) -> DataFrame:
    """Closed candles only; the inclusive close becomes an exclusive bar end."""
    prices = {"open": "open_price", "high": "high_price", "low": "low_price",
              "close": "close_price", "volume": "base_volume", "quote_volume": "quote_volume"}
    takers = ("taker_buy_base_volume", "taker_buy_quote_volume")
    return landed.filter("is_closed").select(
        F.col("exchange").alias("exchange_id"),
        "symbol",
        F.col("interval").alias("bar_interval"),
        F.col("open_time").alias("bar_start"),
        F.timestamp_micros(F.unix_micros("close_time") + F.lit(1_000)).alias("bar_end"),
        *[F.col(src).cast(MONEY).alias(dst) for src, dst in prices.items()],
        "trade_count",
        *[F.col(c).cast(MONEY).alias(c) for c in takers],
        F.col("ingested_at").alias("producer_ingested_at"),
        F.col("_ingested_at").alias("lake_ingested_at"),
        "producer_id",
    )


def stage_fx(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("source").alias("rate_source"),
        "base_currency",
        "quote_currency",
        F.concat("base_currency", "quote_currency").alias("currency_pair"),
        F.col("rate").cast(MONEY).alias("rate"),
        "valid_from",
        "valid_to",
        clock.whole_days(F.col("valid_from"), F.col("valid_to")).alias("validity_days"),
        F.col("ingested_at").alias("producer_ingested_at"),
        F.col("_ingested_at").alias("lake_ingested_at"),
    )
