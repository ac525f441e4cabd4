"""Raw venue text -> contract records, with a dead-letter row for every failure.

One job per input kind over a table or stream of raw messages. Parsing stays in
built-in expressions; a row is never dropped because it is bad, it is routed.
Shape errors, value errors and unreadable text carry different ``error_type``
values, low in cardinality so they can be grouped by.

JSON objects are read as ``map<string,string>``: venue keys differ only in case
(``t``/``T``, ``b``/``B``), and numbers must reach the decimal cast as text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.functions import clock, money
from tickhouse.functions.money import MONEY
from tickhouse.operators import Stage
from tickhouse.schemas import (
    DEAD_LETTER,
    FX_RATE,
    FX_SOURCE,
    INSTRUMENT_OBSERVATION,
    KLINE,
    QUOTE,
    SCHEMA_VERSION,
    TRADE,
    VENUE,
    conform,
)

# Topics and error classes.
TRADE_TOPIC = "md.trades.v1"
QUOTE_TOPIC = "md.book_ticker.v1"
KLINE_TOPIC = "md.klines.v1"
FX_TOPIC = "md.fx_rates.v1"
UNREADABLE = "JSONDecodeError"
BAD_SHAPE = "NormalizationError"
BAD_VALUE = "ValidationError"
BAD_EPOCH = "ValueError"

# What a dead letter is made of.
_LETTER = ("stream", "error_type", "error_message", "payload", "received_at", "producer_id")
_OBJECT = "map<string,string>"
_NO_TIME = "epoch milliseconds lie outside the years 1970 to 9999"


@dataclass(frozen=True)
class Normalised:
    """``checked`` holds every input row with its verdict; the two outputs are filters of it."""

    checked: DataFrame
    schema: T.StructType
    topic: str

    @property
    def valid(self) -> DataFrame:
        return conform(self.checked.filter(F.col("error_type").isNull()), self.schema)

    @property
    def dead_letters(self) -> DataFrame:
        return dead_letters(self.checked.filter(F.col("error_type").isNotNull()), self.topic)

    def stored(self, stage: Stage) -> Normalised:
        """The same with its verdicts written once, for a caller that reads both outputs."""
        have = set(self.checked.columns)
        kept = [c for c in dict.fromkeys((*self.schema.names, *_LETTER)) if c in have]
        return replace(self, checked=stage(self.checked.select(*kept)))


def dead_letters(
    rejected: DataFrame, topic: str, message_width: int | None = None,
    payload_width: int | None = None,
) -> DataFrame:
    """Envelope of rejected rows, whole by default; a width cuts text that is stored,
    and ``payload_length`` then still tells the length of what came."""
    stream = F.col("stream") if "stream" in rejected.columns else F.lit(None)

    def stored(column: str, width: int | None) -> Column:
        return F.col(column) if width is None else F.substring(column, 1, width)

    return conform(
        rejected.select(
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            F.lit(topic).alias("origin_topic"),
            stream.alias("origin_stream"),
            "error_type",
            stored("error_message", message_width).alias("error_message"),
            stored("payload", payload_width).alias("raw_payload"),
            F.col("received_at").alias("failed_at"),
            "producer_id",
            F.length("payload").cast("long").alias("payload_length"),
        ),
        DEAD_LETTER,
    )


def _first_error(rules: Sequence[tuple[str, Column, str]]) -> dict[str, Column]:
    """Error columns from (class, failing condition, message); the first failing rule wins."""
    kind = message = F.lit(None).cast("string")
    for error_class, failed, text in reversed(rules):
        hit = F.coalesce(failed, F.lit(False))
        kind = F.when(hit, F.lit(error_class)).otherwise(kind)
        message = F.when(hit, F.lit(text)).otherwise(message)
    return {"error_type": kind, "error_message": message}


def _field(source: str, key: str) -> Column:
    return F.try_element_at(F.col(source), F.lit(key))


def _number(source: str, key: str) -> Column:
    return _field(source, key).try_cast(MONEY)


def _whole(source: str, key: str) -> Column:
    return _field(source, key).try_cast("bigint")


def _computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that are computed once per row.

    A filter on a projected column is pushed below the projection with the
    column's expression inlined, so a filter on a verdict would parse the payload
    again for every rule. A generator over one struct keeps filters above it,
    and expressions above it see finished values: text first becomes typed
    fields, the rules then read those.
    """
    keep = [c for c in df.columns if c not in columns]
    fields = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(fields)))


def _prepared(raw: DataFrame, producer_id: str) -> DataFrame:
    return raw if "producer_id" in raw.columns else raw.withColumn("producer_id", F.lit(producer_id))


# -- frames ----------------------------------------------------------------------------


def route_frames(raw: DataFrame) -> DataFrame:
    """Classify raw frames (``payload``, ``received_at``): adds ``route``, ``stream``, ``body``.

    route: ``malformed`` (not JSON), ``ignored`` (not an object), ``control``
    (subscription replies), or the message kind. The stream name decides the
    kind, then the event type, then the presence of the three quote fields.
    """
    parsed = _computed(raw, {"__o": F.from_json("payload", _OBJECT)})
    data = _field("__o", "data")
    wrapped = F.map_contains_key("__o", F.lit("stream")) & data.startswith("{")
    parsed = _computed(
        parsed,
        {
            "stream": F.when(wrapped, _field("__o", "stream")),
            "body": F.when(wrapped, F.from_json(data, _OBJECT)).otherwise(F.col("__o")),
            # The record's own JSON, before values became text.
            "body_text": F.when(wrapped, data).otherwise(F.col("payload")),
        },
    )
    suffix = F.when(
        F.col("stream").contains("@"), F.regexp_extract("stream", r"@(.*)$", 1)
    )
    has_quote = F.map_contains_key("body", F.lit("u"))
    for key in ("b", "a"):
        has_quote = has_quote & F.map_contains_key("body", F.lit(key))
    kind = F.coalesce(
        suffix, _field("body", "e"), F.when(has_quote, F.lit("bookTicker")), F.lit("unknown")
    )
    control = F.map_contains_key("__o", F.lit("result")) | F.map_contains_key("__o", F.lit("error"))
    readable = F.try_parse_json("payload").isNotNull()
    route = (
        F.when(F.col("__o").isNull(), F.when(readable, "ignored").otherwise("malformed"))
        .when(control, "control")
        .otherwise(kind)
    )
    return _computed(parsed, {"route": route}).drop("__o")


def malformed_frames(routed: DataFrame, producer_id: str = "feed") -> DataFrame:
    """Dead letters for frames that are not JSON at all."""
    bad = _prepared(routed, producer_id).filter("route = 'malformed'")
    return dead_letters(
        bad.withColumns(
            {"error_type": F.lit(UNREADABLE), "error_message": F.lit("payload is not JSON")}
        ),
        "unknown",
    )


# -- trades ----------------------------------------------------------------------------


def normalise_trades(
    routed: DataFrame, producer_id: str = "feed", exchange: str = VENUE, keep_raw: bool = True
) -> Normalised:
    """Trade frames -> trade records. A missing envelope time falls back to the trade time."""
    rows = _prepared(routed, producer_id).filter("route = 'trade'")
    rows = _computed(
        rows,
        {
            "__symbol": _field("body", "s"), "__id": _whole("body", "t"),
            "__price": _number("body", "p"), "__size": _number("body", "q"),
            "__printed": _whole("body", "T"), "__sent_text": _field("body", "E"),
            "__flag": _field("body", "m"),
        },
    )
    rows = _computed(rows, {"__notional": money.multiply(F.col("__price"), F.col("__size"))})
    name, number = F.col("__symbol"), F.col("__id")
    price, size, printed = F.col("__price"), F.col("__size"), F.col("__printed")
    own_time = F.col("__sent_text").try_cast("bigint")
    sent = F.coalesce(own_time, printed)
    bad_sent = F.col("__sent_text").isNotNull() & own_time.isNull()
    flag = F.coalesce(F.lower("__flag"), F.lit("false"))
    rules = [
        (BAD_SHAPE, name.isNull() | number.isNull(), "missing identity fields"),
        (BAD_SHAPE, printed.isNull(), "trade time is missing or not epoch milliseconds"),
        (BAD_SHAPE, bad_sent, "event time is not epoch milliseconds"),
        (BAD_SHAPE, price.isNull(), "price is missing or not a decimal"),
        (BAD_SHAPE, size.isNull(), "quantity is missing or not a decimal"),
        (BAD_EPOCH, clock.out_of_range(printed) | clock.out_of_range(sent), _NO_TIME),
        (BAD_VALUE, number < 0, "trade id must not be negative"),
        (BAD_VALUE, price <= 0, "price must be positive"),
        (BAD_VALUE, size <= 0, "quantity must be positive"),
        (BAD_VALUE, (price > 0) & (size > 0) & F.col("__notional").isNull(),
         "price times quantity does not fit"),
    ]
    checked = _computed(
        rows,
        {
            **_first_error(rules),
            "schema_version": F.lit(SCHEMA_VERSION),
            "exchange": F.lower(F.lit(exchange)),
            "symbol": F.upper(F.trim(name)),
            "trade_id": number,
            "price": price,
            "quantity": size,
            "quote_quantity": F.col("__notional"),
            "buyer_is_maker": ~flag.isin("false", "0", ""),
            "trade_time": clock.epoch_millis(printed),
            "event_time": clock.epoch_millis(sent),
            "ingested_at": F.col("received_at"),
            "raw_payload": F.col("body_text") if keep_raw else F.lit(None).cast("string"),
        },
    )
    return Normalised(checked, TRADE, TRADE_TOPIC)


# -- quotes ----------------------------------------------------------------------------


def normalise_quotes(
    routed: DataFrame, producer_id: str = "feed", exchange: str = VENUE, keep_raw: bool = True
) -> Normalised:
    """Top-of-book frames -> quote records. Without a venue time the receipt time is used."""
    rows = _prepared(routed, producer_id).filter("route = 'bookTicker'")
    numbers = {"bid_price": "b", "bid_quantity": "B", "ask_price": "a", "ask_quantity": "A"}
    # A zero or absent time means "not given".
    stated = F.coalesce(
        *[F.when(~_field("body", k).isin("0", "", "false"), _field("body", k)) for k in ("E", "T")]
    )
    rows = _computed(
        rows,
        {
            **{f"__{n}": _number("body", key) for n, key in numbers.items()},
            "__symbol": _field("body", "s"), "__id": _whole("body", "u"), "__stated": stated,
        },
    )
    values = {n: F.col(f"__{n}") for n in numbers}
    name, number, given = F.col("__symbol"), F.col("__id"), F.col("__stated")
    moment = given.try_cast("bigint")
    rules = [
        (BAD_SHAPE, name.isNull() | number.isNull(), "missing identity fields"),
        (BAD_EPOCH, given.isNotNull() & moment.isNull(), "event time is not epoch milliseconds"),
        (BAD_EPOCH, clock.out_of_range(moment), _NO_TIME),
        *[(BAD_SHAPE, v.isNull(), f"{n} is missing or not a decimal") for n, v in values.items()],
        (BAD_VALUE, number < 0, "update id must not be negative"),
        (BAD_VALUE, (values["bid_price"] <= 0) | (values["ask_price"] <= 0),
         "prices must be positive"),
        (BAD_VALUE, (values["bid_quantity"] < 0) | (values["ask_quantity"] < 0),
         "sizes must not be negative"),
        (BAD_VALUE, values["bid_price"] >= values["ask_price"], "crossed or locked book"),
    ]
    checked = _computed(
        rows,
        {
            **_first_error(rules),
            **values,
            "schema_version": F.lit(SCHEMA_VERSION),
            "exchange": F.lower(F.lit(exchange)),
            "symbol": F.upper(F.trim(name)),
            "update_id": number,
            "event_time": F.coalesce(clock.epoch_millis(moment), F.col("received_at")),
            "ingested_at": F.col("received_at"),
            "raw_payload": F.col("body_text") if keep_raw else F.lit(None).cast("string"),
        },
    )
    return Normalised(checked, QUOTE, QUOTE_TOPIC)


# -- candles ---------------------------------------------------------------------------

# Positions in the venue's candle array.
KLINE_POSITIONS = {
    "open_time": 0, "open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "close_time": 6,
    "quote_volume": 7, "trade_count": 8, "taker_buy_base_volume": 9, "taker_buy_quote_volume": 10,
}


def normalise_klines(
    raw: DataFrame, producer_id: str = "backfill", exchange: str = VENUE, keep_raw: bool = True
) -> Normalised:
    """Candle rows (``payload`` array text, ``symbol``, ``interval``) -> candle records.

    A row with fewer than eleven entries is rejected whole: a missing entry
    would shift every later column.
    """
    rows = _computed(
        _prepared(raw, producer_id), {"__a": F.from_json("payload", "array<string>")}
    )

    def at(name: str) -> Column:
        return F.get("__a", F.lit(KLINE_POSITIONS[name]))

    ids = ("open_time", "close_time", "trade_count")
    rows = _computed(
        rows,
        {
            f"__{n}": at(n).try_cast("bigint" if n in ids else MONEY) for n in KLINE_POSITIONS
        },
    )
    whole = {n: F.col(f"__{n}") for n in ids}
    dec = {n: F.col(f"__{n}") for n in KLINE_POSITIONS if n not in ids}
    unread = F.lit(False)
    for c in dec.values():
        unread = unread | c.isNull()
    negative = whole["trade_count"] < 0
    for name in ("volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume"):
        negative = negative | (dec[name] < 0)
    unpriced = F.lit(False)
    for name in ("open", "high", "low", "close"):
        unpriced = unpriced | (dec[name] <= 0)
    top = F.greatest(dec["open"], dec["close"])
    bottom = F.least(dec["open"], dec["close"])
    rules = [
        (UNREADABLE, F.col("__a").isNull(), "payload is not a JSON array"),
        (BAD_SHAPE, F.size("__a") < 11, "candle row has too few columns"),
        (BAD_EPOCH, whole["open_time"].isNull() | whole["close_time"].isNull()
         | whole["trade_count"].isNull(), "time or count is not a whole number"),
        (BAD_EPOCH, clock.out_of_range(whole["open_time"])
         | clock.out_of_range(whole["close_time"]), _NO_TIME),
        (BAD_SHAPE, unread, "a price or volume is not a decimal"),
        (BAD_VALUE, unpriced, "prices must be positive"),
        (BAD_VALUE, negative, "volumes and counts must not be negative"),
        (BAD_VALUE, (dec["high"] < top) | (dec["low"] > bottom), "open/high/low/close out of order"),
        (BAD_VALUE, whole["close_time"] <= whole["open_time"], "close time must follow open time"),
        (BAD_VALUE, dec["taker_buy_base_volume"] > dec["volume"],
         "taker volume exceeds total volume"),
    ]
    checked = _computed(
        rows,
        {
            **_first_error(rules),
            **dec,
            "schema_version": F.lit(SCHEMA_VERSION),
            "exchange": F.lower(F.lit(exchange)),
            "symbol": F.upper(F.trim("symbol")),
            "open_time": clock.epoch_millis(whole["open_time"]),
            "close_time": clock.epoch_millis(whole["close_time"]),
            "trade_count": whole["trade_count"],
            "is_closed": F.lit(True),
            "ingested_at": F.col("received_at"),
            "raw_payload": F.col("payload") if keep_raw else F.lit(None).cast("string"),
        },
    )
    return Normalised(checked, KLINE, KLINE_TOPIC)


# -- reference rates -------------------------------------------------------------------

_LOCAL_OFFSET = "-05:00"  # publications are in Bogota civil time, without daylight saving


def normalise_fx(raw: DataFrame, producer_id: str = "fx", keep_raw: bool = True) -> Normalised:
    """Published rate rows -> rate records with a half-open UTC validity interval.

    The source's end date is inclusive, so a day is added. A bad row becomes a
    dead letter and the rest of the batch goes on.
    """
    rows = _computed(_prepared(raw, producer_id), {"body": F.from_json("payload", _OBJECT)})

    def moment(key: str) -> Column:
        local = F.regexp_replace(_field("body", key), "Z", "").try_cast("timestamp_ntz")
        return F.to_utc_timestamp(local.cast("timestamp"), _LOCAL_OFFSET)

    unit = F.upper(F.trim(F.coalesce(_field("body", "unidad"), F.lit("COP"))))
    rows = _computed(
        rows,
        {
            "__rate": _number("body", "valor"),
            "__begins": moment("vigenciadesde"),
            "__ends": clock.plus_seconds(moment("vigenciahasta"), 86_400),
            "__quote": F.when(unit == "", F.lit("COP")).otherwise(unit),
        },
    )
    rate, begins, ends = F.col("__rate"), F.col("__begins"), F.col("__ends")
    quote = F.col("__quote")
    rules = [
        (UNREADABLE, F.col("body").isNull(), "payload is not a JSON object"),
        (BAD_SHAPE, rate.isNull(), "no usable rate"),
        (BAD_SHAPE, begins.isNull() | ends.isNull(), "unparseable validity interval"),
        (BAD_VALUE, ~quote.rlike("^[A-Za-z]{3}$"), "currency code must be three letters"),
        (BAD_VALUE, rate <= 0, "rate must be positive"),
        (BAD_VALUE, ends <= begins, "validity must end after it begins"),
    ]
    checked = _computed(
        rows,
        {
            **_first_error(rules),
            "schema_version": F.lit(SCHEMA_VERSION),
            "source": F.lit(FX_SOURCE),
            "base_currency": F.lit("USD"),
            "quote_currency": quote,
            "rate": rate,
            "valid_from": begins,
            "valid_to": ends,
            "ingested_at": F.col("received_at"),
            "raw_payload": F.col("payload") if keep_raw else F.lit(None).cast("string"),
        },
    )
    return Normalised(checked, FX_RATE, FX_TOPIC)


# -- instrument metadata ---------------------------------------------------------------


def instrument_observations(raw: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """Exchange-information payloads -> one observation per instrument.

    ``received_at`` is when we asked, and is shared by the whole batch. An
    absent or unreadable filter value is null: a made-up tick size would let the
    price-grid check pass for the wrong reason.
    """
    entry = T.StructType(
        [
            T.StructField(n, T.StringType())
            for n in ("symbol", "status", "baseAsset", "quoteAsset")
        ]
        + [T.StructField("filters", T.ArrayType(T.MapType(T.StringType(), T.StringType())))]
    )
    body = T.StructType([T.StructField("symbols", T.ArrayType(entry))])
    one = raw.select(
        F.col("received_at").alias("observed_at"),
        F.explode(F.from_json("payload", body)["symbols"]).alias("i"),
    )

    def filter_value(kind: str, key: str) -> Column:
        matching = F.filter(
            F.col("i.filters"), lambda f: F.try_element_at(f, F.lit("filterType")) == kind
        )
        last = F.try_element_at(matching, F.lit(-1))
        return F.try_element_at(last, F.lit(key)).try_cast(MONEY)

    smallest = filter_value("NOTIONAL", "minNotional")
    out = one.select(
        F.upper(F.coalesce("i.symbol", F.lit(""))).alias("symbol"),
        F.upper(F.coalesce("i.baseAsset", F.lit(""))).alias("base_asset"),
        F.upper(F.coalesce("i.quoteAsset", F.lit(""))).alias("quote_asset"),
        F.upper(F.coalesce("i.status", F.lit("UNKNOWN"))).alias("status"),
        "observed_at",
        filter_value("PRICE_FILTER", "tickSize").alias("tick_size"),
        filter_value("LOT_SIZE", "stepSize").alias("step_size"),
        F.coalesce(
            F.when(smallest != 0, smallest), filter_value("MIN_NOTIONAL", "minNotional")
        ).alias("min_notional"),
    ).filter("symbol <> ''")
    if symbols:
        out = out.filter(F.col("symbol").isin([s.upper() for s in symbols]))
    return conform(out, INSTRUMENT_OBSERVATION)
