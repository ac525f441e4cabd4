import json
from datetime import datetime
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from tickhouse.operators import ingest
from tickhouse.sources.staged import stage

NOW = datetime(2024, 1, 2, 3, 4, 5)
TRADE = {"e": "trade", "E": 1704067200500, "s": "btcusdt", "t": 7, "p": "64250.10000000",
         "q": "0.01", "T": 1704067200123, "m": True, "M": True}
QUOTE = {"u": 11, "s": "BTCUSDT", "b": "64250.10", "B": "1.5", "a": "64250.11", "A": "2"}
KLINE = [1704067200000, "10", "12", "9", "11", "100", 1704067259999, "1000", 5, "40", "400", "0"]
FX = {"valor": "3950.25", "unidad": "COP", "vigenciadesde": "2024-01-06T00:00:00.000",
      "vigenciahasta": "2024-01-08T00:00:00.000"}


def raw(spark, *payloads, **extra):
    text = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    names = "payload string, received_at timestamp" + "".join(f", {k} string" for k in extra)
    return spark.createDataFrame([(t, NOW, *extra.values()) for t in text], names)


def frames(spark, *payloads):
    return ingest.route_frames(raw(spark, *payloads))


def verdict(normalised):
    bad = rows(normalised.dead_letters)
    return [(r["error_type"], r["error_message"]) for r in bad]


def test_routes(spark):
    got = [r["route"] for r in frames(
        spark, {"stream": "btcusdt@trade", "data": TRADE}, TRADE, QUOTE, {"x": 1},
        {"result": None, "id": 1}, "[1, 2]", "5", '{"e": "trade"', "", {"stream": "a@b", "data": 3},
        {"stream": "btcusdt@bookTicker", "data": {**QUOTE, "e": "trade"}}).collect()]
    assert got == ["trade", "trade", "bookTicker", "unknown", "control", "ignored", "ignored",
                   "malformed", "malformed", "unknown", "bookTicker"]


def test_trade_fields(spark):
    out = rows(ingest.normalise_trades(
        frames(spark, {"stream": "btcusdt@trade", "data": TRADE})).valid)[0]
    assert out["symbol"] == "BTCUSDT" and out["exchange"] == "binance" and out["buyer_is_maker"]
    assert out["price"] == Decimal("64250.1") and out["quote_quantity"] == Decimal("642.501")
    assert out["trade_time"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert out["event_time"] == datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert out["ingested_at"] == NOW and json.loads(out["raw_payload"]) == TRADE


def test_missing_envelope_time_falls_back(spark):
    trade = {k: v for k, v in TRADE.items() if k not in ("E", "m")}
    out = rows(ingest.normalise_trades(frames(spark, trade)).valid)[0]
    assert out["event_time"] == out["trade_time"] and out["buyer_is_maker"] is False


def test_bad_trades_become_dead_letters(spark):
    cases = [
        ({k: v for k, v in TRADE.items() if k != "s"}, "NormalizationError"),
        ({k: v for k, v in TRADE.items() if k != "t"}, "NormalizationError"),
        ({k: v for k, v in TRADE.items() if k != "T"}, "NormalizationError"),
        ({**TRADE, "p": "n/a"}, "NormalizationError"),
        ({**TRADE, "T": -5}, "ValueError"),
        ({**TRADE, "t": -1}, "ValidationError"),
        ({**TRADE, "p": "0"}, "ValidationError"),
        ({**TRADE, "q": "-1"}, "ValidationError"),
    ]
    for payload, expected in cases:
        out = ingest.normalise_trades(frames(spark, payload))
        assert out.valid.count() == 0, payload
        assert verdict(out)[0][0] == expected, payload


def test_every_trade_frame_comes_out_once(spark):
    out = ingest.normalise_trades(frames(spark, TRADE, {**TRADE, "p": "x"}, {**TRADE, "q": "0"}))
    assert out.valid.count() == 1 and out.dead_letters.count() == 2


def test_quote_uses_receipt_time_and_rejects_crossed_books(spark):
    good = rows(ingest.normalise_quotes(frames(spark, QUOTE)).valid)[0]
    assert good["event_time"] == NOW and good["update_id"] == 11
    timed = rows(ingest.normalise_quotes(frames(spark, {**QUOTE, "E": 0, "T": 1704067200123})).valid)
    assert timed[0]["event_time"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    for ask in ("64250.10", "64250.09"):
        assert verdict(ingest.normalise_quotes(frames(spark, {**QUOTE, "a": ask}))) == [
            ("ValidationError", "crossed or locked book")]
    assert ingest.normalise_quotes(frames(spark, {**QUOTE, "B": "0"})).valid.count() == 1


def test_klines(spark):
    def run(row):
        text = row if isinstance(row, str) else json.dumps(row)
        return ingest.normalise_klines(raw(spark, text, symbol="btcusdt", interval="1m"))

    good = rows(run(KLINE).valid)[0]
    assert good["symbol"] == "BTCUSDT" and good["taker_buy_base_volume"] == 40 and good["is_closed"]
    assert run(KLINE[:11]).valid.count() == 1
    swapped = [KLINE[0], "10", "9", "12", *KLINE[4:]]
    assert verdict(run(KLINE[:10]))[0][0] == "NormalizationError"
    assert verdict(run(swapped))[0][0] == "ValidationError"
    assert verdict(run([*KLINE[:9], "101", *KLINE[10:]]))[0][0] == "ValidationError"
    assert verdict(run([*KLINE[:6], KLINE[0], *KLINE[7:]]))[0][0] == "ValidationError"
    assert verdict(run("{"))[0][0] == "JSONDecodeError"


def test_fx_is_local_civil_time_with_an_inclusive_end(spark):
    got = rows(ingest.normalise_fx(raw(spark, FX)).valid)[0]
    assert got["valid_from"] == datetime(2024, 1, 6, 5) and got["valid_to"] == datetime(2024, 1, 9, 5)
    assert (got["source"], got["base_currency"], got["quote_currency"]) == ("banrep-trm", "USD", "COP")
    nounit = {k: v for k, v in FX.items() if k != "unidad"}
    assert rows(ingest.normalise_fx(raw(spark, nounit)).valid)[0]["quote_currency"] == "COP"
    mixed = ingest.normalise_fx(raw(
        spark, FX, {**FX, "valor": "x"}, {**FX, "unidad": "C0P"}, {**FX, "valor": "-1"},
        {**FX, "vigenciadesde": "soon"}, {**FX, "vigenciahasta": "2024-01-01T00:00:00.000"}))
    assert mixed.valid.count() == 1 and mixed.dead_letters.count() == 5


def test_instrument_filters(spark):
    info = {"symbols": [
        {"symbol": "btcusdt", "status": "trading", "baseAsset": "btc", "quoteAsset": "usdt",
         "filters": [{"filterType": "NOTIONAL", "minNotional": "0"},
                     {"filterType": "LOT_SIZE", "stepSize": "bad"},
                     {"filterType": "PRICE_FILTER", "tickSize": "0.01"},
                     {"filterType": "MIN_NOTIONAL", "minNotional": "5"}]},
        {"symbol": "HALTED", "status": "BREAK", "filters": []},
        {"symbol": "", "status": "X", "filters": []}]}
    got = rows(ingest.instrument_observations(raw(spark, info)), "symbol")
    assert [r["symbol"] for r in got] == ["BTCUSDT", "HALTED"]
    assert got[0]["tick_size"] == Decimal("0.01") and got[0]["step_size"] is None
    assert got[0]["min_notional"] == 5 and got[1]["tick_size"] is None
    assert got[0]["observed_at"] == NOW and got[1]["status"] == "BREAK"
    only = ingest.instrument_observations(raw(spark, info), symbols=["btcusdt"])
    assert [r["symbol"] for r in rows(only)] == ["BTCUSDT"]


def test_extreme_messages_become_results_or_dead_letters(spark):
    odd = [{"q": "20000000000"}, {"p": "0.0000000001234", "q": "1000"}, {"T": 2**63 - 1},
           {"p": "9" * 20, "q": "2"}, {"p": "1" + "0" * 25}]
    out = ingest.normalise_trades(frames(spark, *[{**TRADE, **change} for change in odd], TRADE))
    good = [r["quote_quantity"] for r in rows(out.valid)]
    assert good == [Decimal(TRADE["p"]) * 20_000_000_000, Decimal("0.0000001234"), Decimal("642.501")]
    kinds = [r["error_type"] for r in rows(out.dead_letters)]
    assert kinds == ["ValueError", "ValidationError", "NormalizationError"]


def test_oversized_payload_is_kept_unless_a_width_is_given(spark):
    text = '{"e":"trade","pad":"' + "x" * 70_000 + '"'
    letter = rows(ingest.malformed_frames(frames(spark, text)))[0]
    assert letter["raw_payload"] == text and letter["origin_topic"] == "unknown"
    bad = frames(spark, text).withColumns(
        {c: F.lit("x") for c in ("error_type", "error_message", "producer_id")})
    cut = rows(ingest.dead_letters(bad, "t", payload_width=10))[0]
    assert cut["raw_payload"] == text[:10] and cut["payload_length"] == len(text)
    assert letter["error_type"] == "JSONDecodeError" and letter["failed_at"] == NOW
    padded = {**TRADE, "pad": "x" * 70_000}
    kept = rows(ingest.normalise_trades(frames(spark, padded)).valid)[0]
    assert len(kept["raw_payload"]) > 70_000


def test_stored_verdicts_are_parsed_once_and_alike(spark):
    raw = spark.createDataFrame([
        ('{"e":"trade","s":"a","t":1,"p":"2","q":"3","m":true,"T":5}', datetime(2024, 1, 1)),
        ('{"e":"trade","s":"a","t":2,"p":"-2","q":"3","m":true,"T":5}', datetime(2024, 1, 1)),
    ], "payload string, received_at timestamp")
    lazy = ingest.normalise_trades(ingest.route_frames(raw))
    stored = lazy.stored(stage)
    for name in ("valid", "dead_letters"):
        a, b = getattr(lazy, name), getattr(stored, name)
        assert a.schema.names == b.schema.names and a.collect() == b.collect() and b.count() == 1
        assert "from_json" not in b._jdf.queryExecution().optimizedPlan().toString()
