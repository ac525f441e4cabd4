"""Canonical inputs derived from the generic sample tables.

The sample tables carry no market data, so each input below is a projection of
one of them onto a landed-table schema. Every row of the source takes part.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.functions import clock, money
from tickhouse.functions.money import MONEY
from tickhouse.operators import Stage
from tickhouse.schemas import SCHEMA_VERSION, VENUE

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _shift_ms(ts: Column, ms: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + ms.cast("bigint") * 1_000)


@dataclass(frozen=True)
class SampleTables:
    spark: SparkSession
    path: str
    #: What ``events`` gives, if it has been stored.
    stored: DataFrame | None = None

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    # -- events as trades, quotes and raw messages ---------------------------------

    def events(self) -> DataFrame:
        return event_columns(self.read("events")) if self.stored is None else self.stored

    def with_events_stored(self, stage: Stage) -> SampleTables:
        """The same with the events parsed once, in files that all cores read, for a chain
        that derives several inputs from them; a stored table may be one row group."""
        spread = self.events().repartition(4 * self.spark.sparkContext.defaultParallelism, "event_id")
        return replace(self, stored=stage(spread))

    def arrivals(self) -> DataFrame:
        """Events with the lake clock; every twentieth id is replayed an hour later."""
        copies = F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        copy = F.col("copy")
        return (
            self.events()
            .withColumn("copy", F.explode(copies))
            .withColumns(
                {
                    "_kafka_topic": F.lit("sample"),
                    "_kafka_partition": F.lit(0),
                    "_kafka_offset": F.col("event_id") * 2 + copy,
                    "_ingested_at": _shift_ms(
                        F.col("ingested_at"), F.lit(60_000) + copy * 3_600_000
                    ),
                    "exchange": F.lit(VENUE),
                    "producer_id": F.lit("sample"),
                    "schema_version": F.lit(SCHEMA_VERSION),
                }
            )
        )

    def landed_trades(self) -> DataFrame:
        price = F.col("value").cast("decimal(18,2)").cast(MONEY)
        size = (F.col("k") + 1).cast(MONEY)
        return self.arrivals().select(
            "exchange", F.col("event_type").alias("symbol"), F.col("event_id").alias("trade_id"),
            price.alias("price"), size.alias("quantity"),
            money.multiply(price, size).cast(MONEY).alias("quote_quantity"),
            (F.col("user_id") % 2 == 0).alias("buyer_is_maker"),
            F.col("ts").alias("trade_time"),
            F.col("ts").alias("event_time"), "ingested_at", "_ingested_at",
            "_kafka_topic", "_kafka_partition", "_kafka_offset", "producer_id", "schema_version",
        )

    def landed_quotes(self) -> DataFrame:
        bid = F.col("value").cast("decimal(18,2)").cast(MONEY)
        edge = ((F.col("k") + 1).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)"))
        return self.arrivals().select(
            "exchange", F.col("event_type").alias("symbol"),
            (F.col("event_id") * 7).alias("update_id"),
            bid.alias("bid_price"), (F.col("user_id") + 1).cast(MONEY).alias("bid_quantity"),
            (bid + edge).cast(MONEY).alias("ask_price"),
            (F.col("k") + 1).cast(MONEY).alias("ask_quantity"),
            F.col("ts").alias("event_time"), "ingested_at", "_ingested_at",
            "_kafka_topic", "_kafka_partition", "_kafka_offset", "producer_id", "schema_version",
        )

    def landed_klines(self, code: str = "1h") -> DataFrame:
        """Venue candles over the same tape, except the prints with ``k = 13``."""
        seconds = clock.interval_seconds(code)
        price = F.col("value").cast("decimal(18,2)").cast(MONEY)
        size = (F.col("k") + 1).cast(MONEY)
        notional = money.multiply(price, size)
        by = F.struct("ts", "event_id")
        buys = F.col("user_id") % 2 != 0
        printed = self.events().filter("k <> 13")
        return (
            printed.groupBy(
                F.col("event_type").alias("symbol"),
                clock.bar_floor(F.col("ts"), seconds).alias("open_time"),
            )
            .agg(
                F.min_by(price, by).alias("open"), F.max(price).alias("high"),
                F.min(price).alias("low"), F.max_by(price, by).alias("close"),
                F.sum(size).alias("volume"), F.sum(notional).alias("quote_volume"),
                F.count(F.lit(1)).alias("trade_count"),
                F.sum(F.when(buys, size).otherwise(0)).alias("taker_buy_base_volume"),
                F.sum(F.when(buys, notional).otherwise(0)).alias("taker_buy_quote_volume"),
                F.max("ts").alias("ingested_at"),
            )
            .withColumns(
                {
                    "exchange": F.lit(VENUE),
                    "interval": F.lit(code),
                    "close_time": _shift_ms(F.col("open_time"), F.lit(seconds * 1_000 - 1)),
                    "is_closed": F.lit(True),
                    "_ingested_at": F.col("ingested_at"),
                    "producer_id": F.lit("sample"),
                }
            )
        )

    def landed_fx(self) -> DataFrame:
        """A USD/COP publication every second day, each overlapping the next by a day."""
        start = clock.plus_seconds(clock.bar_floor(F.col("ts"), 172_800), 21_600)
        return (
            self.events()
            .groupBy(start.alias("valid_from"))
            .agg((F.lit(4000) + F.max(F.col("value").cast("decimal(18,2)"))).alias("rate"))
            .select(
                F.lit("sample").alias("source"), F.lit("USD").alias("base_currency"),
                F.lit("COP").alias("quote_currency"), F.col("rate").cast(MONEY).alias("rate"),
                "valid_from", clock.plus_seconds(F.col("valid_from"), 259_200).alias("valid_to"),
                F.col("valid_from").alias("ingested_at"), F.col("valid_from").alias("_ingested_at"),
            )
        )

    # -- raw messages ---------------------------------------------------------------

    def raw_trades(self) -> DataFrame:
        """Events as combined trade frames. Some ids are damaged, each kind in its own way."""
        eid = F.col("event_id")
        ms = F.unix_millis("ts").cast("string")
        price = (
            F.when(eid % 107 == 0, "n/a").when(eid % 103 == 0, "0.00")
            .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
        )
        # The venue omits the envelope time on some paths.
        sent = F.when(eid % 7 == 0, "").otherwise(F.concat(F.lit('"E":'), ms, F.lit(",")))
        frame = F.concat(
            F.lit('{"stream":"'), "event_type", F.lit('@trade","data":{"e":"trade",'), sent,
            F.lit('"s":"'), "event_type", F.lit('","t":'), eid.cast("string"),
            F.lit(',"p":"'), price, F.lit('","q":"'), (F.col("k") + 1).cast("string"),
            F.lit('","T":'), ms, F.lit(',"m":'), (F.col("user_id") % 2 == 0).cast("string"),
            F.lit("}}"),
        )
        payload = (
            F.when(eid % 101 == 0, F.substring(frame, 1, 30))
            .when(eid % 109 == 0, F.concat(F.lit('{"result":null,"id":'), eid.cast("string"),
                                           F.lit("}")))
            .when(eid % 113 == 0, F.lit("[1,2]"))
            .otherwise(frame)
        )
        return self.events().select(
            "event_id", payload.alias("payload"), F.col("ingested_at").alias("received_at")
        )

    def raw_quotes(self) -> DataFrame:
        """Events as bare top-of-book frames: no stream name, no event type, no time."""
        eid = F.col("event_id")
        bid = F.col("value").cast("decimal(18,2)")
        edge = (F.col("k") + 1).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")
        ask = F.when(eid % 103 == 0, bid).otherwise((bid + edge).cast("decimal(18,2)"))
        payload = F.concat(
            F.lit('{"u":'), (eid * 7).cast("string"), F.lit(',"s":"'), "event_type",
            F.lit('","b":"'), bid.cast("string"), F.lit('","B":"'),
            (F.col("user_id") + 1).cast("string"), F.lit('","a":"'), ask.cast("string"),
            F.lit('"'),
            F.when(eid % 107 == 0, "").otherwise(
                F.concat(F.lit(',"A":"'), (F.col("k") + 1).cast("string"), F.lit('"'))
            ),
            F.lit("}"),
        )
        return self.events().select(
            "event_id", payload.alias("payload"), F.col("ingested_at").alias("received_at")
        )

    def raw_klines(self) -> DataFrame:
        """Venue candles as positional arrays; some are short or have high and low swapped."""
        n = F.col("trade_count")
        swap = n % 5 == 0

        def text(c: str) -> Column:
            return F.concat(F.lit('"'), F.col(c).cast("decimal(28,8)").cast("string"), F.lit('"'))

        tail = F.concat_ws(
            ",", text("quote_volume"), n.cast("string"), text("taker_buy_base_volume"),
            text("taker_buy_quote_volume"), F.lit('"0"'),
        )
        payload = F.concat(
            F.lit("["),
            F.concat_ws(
                ",", F.unix_millis("open_time").cast("string"), text("open"),
                F.when(swap, text("low")).otherwise(text("high")),
                F.when(swap, text("high")).otherwise(text("low")),
                text("close"), text("volume"), F.unix_millis("close_time").cast("string"),
                F.when(n % 7 != 0, tail),
            ),
            F.lit("]"),
        )
        return self.landed_klines().select(
            payload.alias("payload"), "symbol", "interval", F.col("ingested_at").alias("received_at")
        )

    def raw_fx(self) -> DataFrame:
        """Orders as published rate rows in local civil time."""
        key = F.col("o_orderkey")
        day = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
        last = F.date_format(
            F.when(key % 103 == 0, F.date_sub("o_orderdate", 2))
            .otherwise(F.date_add("o_orderdate", 1)), "yyyy-MM-dd'T'00:00:00.000",
        )
        rate = F.when(key % 101 == 0, "x").otherwise(
            F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        )
        unit = F.when(key % 107 == 0, "co1").when(key % 3 == 0, " cop ").otherwise("COP")
        payload = F.concat(
            F.lit('{"valor":"'), rate, F.lit('","unidad":"'), unit,
            F.lit('","vigenciadesde":"'), day, F.lit('","vigenciahasta":"'), last, F.lit('"}'),
        )
        return self.read("orders").select(
            "o_orderkey", payload.alias("payload"),
            F.col("o_orderdate").cast("timestamp").alias("received_at"),
        )

    def raw_instruments(self) -> DataFrame:
        """Parts as exchange-information payloads with heterogeneous filter arrays."""
        key = F.col("p_partkey")
        size = F.col("p_size").cast("string")
        tick = F.concat(F.lit('{"filterType":"PRICE_FILTER","tickSize":"0.'), size, F.lit('"}'))
        lot = F.concat(
            F.lit('{"filterType":"LOT_SIZE","stepSize":"'),
            F.when(key % 11 == 0, "bad").otherwise(size), F.lit('"}'),
        )
        kind = F.when(key % 2 == 0, "NOTIONAL").otherwise("MIN_NOTIONAL")
        least = F.concat(
            F.lit('{"filterType":"'), kind, F.lit('","minNotional":"'), size, F.lit('"}')
        )
        filters = F.concat_ws(",", F.when(key % 13 != 0, tick), lot, least)
        payload = F.concat(
            F.lit('{"symbols":[{"symbol":"p'), key.cast("string"), F.lit('","status":"'),
            F.when(key % 5 == 0, "halt").otherwise("trading"), F.lit('","baseAsset":"'),
            "p_brand", F.lit('","quoteAsset":"usdt","filters":['), filters, F.lit("]}]}"),
        )
        return self.read("part").select(
            payload.alias("payload"),
            F.lit("2024-01-31 00:00:00").cast("timestamp").alias("received_at"),
        )

    # -- lineitem as a large tape --------------------------------------------------

    def tape(self) -> DataFrame:
        """Line items as trades of a supplier's instrument; (order, line) repeats."""
        # Whole cents by integer division, so no engine's rounding of doubles is involved.
        cents = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")
        price = (cents.cast("decimal(16,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)
        size = F.col("l_quantity").cast("decimal(18,2)").cast(MONEY)
        maker = F.col("l_returnflag") == "R"
        return self.read("lineitem").select(
            F.lit("tape").alias("exchange_id"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
            price.alias("price"), size.alias("quantity"),
            money.multiply(price, size).cast(MONEY).alias("notional"),
            maker.alias("buyer_is_maker"), (~maker).alias("is_buyer_aggressor"),
            F.col("l_shipdate").cast("timestamp").alias("event_time"),
            F.col("l_shipdate").cast("timestamp").alias("lake_ingested_at"),
            (F.col("l_linenumber") * 1_000).cast("bigint").alias("ingestion_lag_ms"),
            F.lit(1).cast("bigint").alias("_duplicate_count"),
            F.element_at(
                F.array(*[F.lit(p) for p in PRIORITIES]), F.col("l_linenumber") % 5 + 1
            ).alias("currency_pair"),
        )

    # -- orders as publications and instrument observations ------------------------

    def publications(self) -> DataFrame:
        """Orders as rate publications: the priority is the pair, the date the validity start."""
        start = F.col("o_orderdate").cast("timestamp")
        return self.read("orders").select(
            F.col("o_orderpriority").alias("currency_pair"),
            F.col("o_totalprice").cast("decimal(18,2)").cast(MONEY).alias("rate"),
            start.alias("valid_from"),
            clock.plus_seconds(start, 7 * 86_400).alias("valid_to"),
            F.col("o_orderkey").alias("publication_id"),
        )

    def observations(self) -> DataFrame:
        """Orders as instrument observations of a customer's symbol."""
        digit = F.col("o_orderpriority").substr(1, 1).cast("int")
        return self.read("orders").select(
            F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("symbol"),
            F.col("o_orderstatus").alias("status"),
            (digit.cast("decimal(3,0)") * F.lit("0.01").cast("decimal(3,2)"))
            .cast(MONEY).alias("tick_size"),
            F.lit("0.001").cast(MONEY).alias("step_size"),
            F.when(digit > 2, F.lit(5)).otherwise(10).cast(MONEY).alias("min_notional"),
            F.col("o_orderdate").cast("timestamp").alias("observed_at"),
            F.col("o_orderkey").alias("observation_id"),
        )

    def quarterly_observations(self) -> DataFrame:
        """The same observations polled once a quarter: symbols come and go between polls."""
        return self.observations().withColumn(
            "observed_at", F.date_trunc("quarter", "observed_at")
        )

    # -- part as declared instruments ----------------------------------------------

    def reference(self) -> DataFrame:
        """Parts as declared instruments; keys run a hundred ahead of what trades."""
        return self.read("part").select(
            (F.col("p_partkey") + 100).cast("string").alias("symbol"),
            F.col("p_brand").alias("base_asset"),
            F.col("p_type").alias("quote_asset"),
            F.lit("spot").alias("instrument_class"),
            F.lit("0.01").cast(MONEY).alias("tick_size"),
            F.lit("1").cast(MONEY).alias("step_size"),
            F.lit("5").cast(MONEY).alias("min_notional"),
            (F.col("p_size") <= 40).alias("is_tracked"),
        )

    def part_tape(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_partkey").cast("string").alias("symbol"),
            F.col("l_shipdate").cast("timestamp").alias("event_time"),
            F.col("l_extendedprice").cast("decimal(18,2)").cast(MONEY).alias("notional"),
        )


def event_columns(events: DataFrame) -> DataFrame:
    """Typed columns of the events table, batch or streaming."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        ts.alias("ts"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        _shift_ms(ts, F.col("event_id") % 5_000).alias("ingested_at"),
    )
