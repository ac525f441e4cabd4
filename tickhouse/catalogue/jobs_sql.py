"""SQL counterparts of the job queries: the batch answer each job must arrive at."""

from __future__ import annotations

from tickhouse.catalogue.market_sql import BAR_NUMBERS, CTES
from tickhouse.catalogue.market_sql import ORACLES as MARKET
from tickhouse.catalogue.sqltext import dbl, dbls

CTES.add("c_quote_rows", """
SELECT 'binance' AS exchange_id, event_type AS symbol, event_id * 7 AS update_id,
       CAST(value AS DECIMAL(18,2)) AS bid_price, user_id + 1 AS bid_quantity,
       CAST(value AS DECIMAL(18,2)) + CAST((k + 1) * 0.01 AS DECIMAL(18,2)) AS ask_price,
       k + 1 AS ask_quantity, ts AS event_time, ingested_at, koff AS kafka_offset
FROM c_arr
""")

_BRONZE = CTES.query(f"""
        SELECT 'binance' AS exchange, event_type AS symbol, event_id AS trade_id,
               {dbl("CAST(value AS DECIMAL(18,2))", "price")}, {dbl("k + 1", "quantity")},
               {dbl("CAST(value AS DECIMAL(18,2)) * CAST(k + 1 AS DECIMAL(6,0))",
                    "quote_quantity")},
               user_id % 2 = 0 AS buyer_is_maker, ts AS trade_time, ingested_at,
               'trades' AS _kafka_topic, CAST(0 AS BIGINT) AS _kafka_partition,
               event_id AS _kafka_offset, event_type AS _kafka_key, 'binance' AS _source
        FROM c_ev WHERE event_id % 101 <> 0""")
_STREAM_BARS = CTES.query(f"""
        SELECT exchange_id, symbol, bar_start, bar_end, trade_count,
               {dbls(*[c for c in BAR_NUMBERS if c != "mean_ingestion_lag_ms"])},
               first_trade_time, last_trade_time, first_trade_id, last_trade_id
        FROM c_bars_h""")

ORACLES = {
    "parse_extremes": CTES.query("""
        SELECT event_id AS trade_id, error_type,
               CASE WHEN error_type IS NULL THEN CAST(CAST(CASE event_id % 5
                 WHEN 0 THEN CAST(CAST(cents * (k + 1) AS DECIMAL(20,2))
                                  * CAST(1000000000000000 AS DECIMAL(16,0)) AS DECIMAL(38,18))
                 WHEN 1 THEN CAST('0.' || lpad(CAST(event_id + 1 AS VARCHAR), 15, '0') AS DECIMAL(38,18))
                 ELSE CAST(cents * (k + 2) AS DECIMAL(38,18)) END AS DECIMAL(38,18)) AS VARCHAR)
                 END AS notional,
               '{"e":"trade","s":"' || event_type || '","t":' || event_id || ',"p":"' ||
               CASE event_id % 5
                 WHEN 1 THEN '0.' || lpad(CAST(event_id + 1 AS VARCHAR), 18, '0')
                 WHEN 3 THEN repeat('9', 20) ELSE CAST(cents AS VARCHAR) END || '","q":"' ||
               CASE event_id % 5 WHEN 0 THEN (k + 1) || repeat('0', 15) WHEN 1 THEN '1000'
                 ELSE CAST(k + 2 AS VARCHAR) END || '","m":true,"T":' ||
               CASE event_id % 5 WHEN 2 THEN '9223372036854775807'
                 ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END || '}' AS raw_payload
        FROM (SELECT *, CASE WHEN event_id % 5 = 2 THEN 'ValueError'
                             WHEN event_id % 5 = 3 THEN 'ValidationError'
                             WHEN event_id % 5 <> 1 AND cents <= 0 THEN 'ValidationError'
                        END AS error_type
              FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS cents FROM c_ev))"""),
    "dead_letter_texts": CTES.query("""
        SELECT md5(payload) AS payload_md5, length(payload) AS payload_length,
               'JSONDecodeError' AS error_type, ts AS failed_at
        FROM (SELECT ts, '{"cut": "' || repeat(event_type, CASE WHEN event_id % 1000 = 0
                THEN 40000 ELSE CAST(k + 1 AS BIGINT) END) AS payload FROM c_ev)"""),
    "landing_repeated_batch": CTES.query("""
        SELECT event_type AS symbol, count(*) FILTER (event_id % 101 <> 0) AS landed,
               nullif(count(*) FILTER (event_id % 101 = 0), 0) AS quarantined
        FROM c_ev GROUP BY 1"""),
    "upsert_repeated_keys": CTES.query(f"""
        SELECT symbol, trade_id, {dbl("any_value(price)", "price")},
               any_value(event_time) AS event_time, max(lake_ingested_at) AS lake_ingested_at
        FROM c_landed GROUP BY symbol, trade_id"""),
    "open_interval_join": CTES.query("""
        SELECT t.currency_pair, count(*) AS trades, count(f.rate) AS with_rate,
               max(f.valid_from) AS newest
        FROM c_tape t LEFT JOIN c_order_fx f ON t.currency_pair = f.currency_pair
          AND t.event_time >= f.valid_from
          AND (t.event_time < f.valid_to OR f.valid_to = f.source_valid_to)
        GROUP BY 1"""),
    "rebuild_tape": CTES.query("""
        SELECT symbol, strftime(event_time, '%Y-%m-%d') AS dt, count(*) AS trades
        FROM c_trades GROUP BY 1, 2"""),
    "stored_failures": CTES.query("""
        SELECT symbol, trade_id, ingestion_lag_ms, 'lag' AS check_name
        FROM c_landed WHERE ingestion_lag_ms > 4000"""),
    "seed_reference": """
        SELECT CAST(p_partkey + 100 AS VARCHAR) AS symbol, p_brand AS base_asset,
               p_type AS quote_asset, 'spot' AS instrument_class, CAST(0.01 AS DOUBLE) AS tick_size,
               CAST(1 AS DOUBLE) AS step_size, CAST(5 AS DOUBLE) AS min_notional,
               p_size <= 40 AS is_tracked, '2024-01-01' AS listed_on
        FROM part""",
    "message_keys": CTES.query("""
        SELECT symbol AS message_key, count(*) AS messages, max(trade_id) AS last_id
        FROM c_landed GROUP BY 1"""),
    "merge_upsert": CTES.query(f"""
        SELECT symbol, trade_id,
               {dbl("quantity + CASE WHEN event_time >= TIMESTAMP '2024-01-15' THEN 1 ELSE 0 END",
                    "quantity")},
               CASE WHEN event_time >= TIMESTAMP '2024-01-15' AND quantity > 90
                    THEN event_time + INTERVAL 1 DAY ELSE event_time END AS event_time,
               event_time >= TIMESTAMP '2024-01-15' AS is_corrected
        FROM c_trades"""),
    "incremental_bars": MARKET["bars_1h"],
    "incremental_bars_rebuilt": CTES.query(f"""
        SELECT exchange_id, symbol, bar_start,
               {dbls("open_price", "close_price", "base_volume", "log_return")}, trade_count
        FROM c_bars_h"""),
    "compact_report": CTES.query("""
        SELECT strftime(event_time, '%Y-%m-%d') AS dt, true AS was_split,
               CAST(1 AS BIGINT) AS files_after, count(*) AS trades
        FROM c_landed GROUP BY 1"""),
    "stream_bronze": _BRONZE,
    "stream_quarantine": CTES.query("""
        SELECT 'trades' AS _kafka_topic, event_id AS _kafka_offset, ts AS _kafka_timestamp,
               event_type AS _kafka_key, 'avro_decode_failed' AS _reason
        FROM c_ev WHERE event_id % 101 = 0"""),
    "stream_dedup": CTES.query(f"""
        SELECT exchange_id, symbol, trade_id, {dbls("price", "quantity", "notional")}, event_time
        FROM c_trades"""),
    "compact_landed": _BRONZE,
    "land_quotes": CTES.query(f"""
        SELECT exchange_id AS exchange, symbol, update_id,
               {dbls("bid_price", "bid_quantity", "ask_price", "ask_quantity")}, event_time,
               ingested_at, 'quote' AS _kafka_topic, kafka_offset AS _kafka_offset,
               symbol AS _kafka_key, 'binance' AS _source, NULL::VARCHAR AS _reason
        FROM c_quote_rows WHERE kafka_offset % 101 <> 0
        UNION ALL BY NAME
        SELECT 'quote' AS _kafka_topic, kafka_offset AS _kafka_offset, symbol AS _kafka_key,
               'avro_decode_failed' AS _reason
        FROM c_quote_rows WHERE kafka_offset % 101 = 0"""),
    "land_klines": CTES.query(f"""
        SELECT exchange_id AS exchange, symbol, '1h' AS interval, bar_start AS open_time,
               bar_start + INTERVAL '3599.999' SECOND AS close_time,
               {dbl("open_price", "open")}, {dbl("high_price", "high")}, {dbl("low_price", "low")},
               {dbl("close_price", "close")}, {dbl("base_volume", "volume")},
               {dbls("quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")},
               trade_count, true AS is_closed, symbol || ':1h' AS _kafka_key
        FROM c_venue"""),
    "land_fx": CTES.query(f"""
        SELECT 'sample' AS source, 'USD' AS base_currency, 'COP' AS quote_currency,
               {dbl("rate", "rate")}, valid_from, source_valid_to AS valid_to,
               'USDCOP' AS _kafka_key
        FROM c_fx"""),
    "stream_bars": _STREAM_BARS,
    "stream_bars_closed": _STREAM_BARS,
    "stream_sequence": CTES.query("""
        SELECT symbol, kafka_offset, session, update_id, high IS NULL AS first_seen,
               coalesce(update_id <= high, false) AS regressed,
               CASE WHEN high IS NULL OR update_id <= high THEN 0
                    ELSE update_id - high - 1 END AS span
        FROM (SELECT *, max(update_id) OVER (PARTITION BY symbol, session ORDER BY kafka_offset
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM c_seq)"""),
}
