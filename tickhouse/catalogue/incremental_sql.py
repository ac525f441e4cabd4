"""SQL counterparts: the answer from all rows at once."""

from __future__ import annotations

from tickhouse.catalogue import delivery_sql  # noqa: F401 - adds its CTEs
from tickhouse.catalogue.market_sql import CTES
from tickhouse.catalogue.market_sql import ORACLES as MARKET
from tickhouse.catalogue.sqltext import dbl

CTES.add("c_present", """
SELECT DISTINCT 'binance' AS exchange, event_type AS symbol, CAST(ts AS DATE) AS day,
       epoch_us(ts) // 60000000 AS minute
FROM c_ev WHERE ts IS NOT NULL
""")
# Each present minute with the one before it in its day; a day ends with a sentinel.
CTES.add("c_steps", """
SELECT exchange, symbol, day, midnight, minute,
       coalesce(lag(minute) OVER (PARTITION BY exchange, symbol, day ORDER BY minute),
                midnight - 1) AS before
FROM (
  SELECT *, epoch_us(CAST(day AS TIMESTAMP)) // 60000000 AS midnight FROM c_present
  UNION ALL
  SELECT DISTINCT exchange, symbol, day, epoch_us(CAST(day AS TIMESTAMP)) // 60000000 + 1440,
         epoch_us(CAST(day AS TIMESTAMP)) // 60000000 FROM c_present)
""")
CTES.add("c_days", """
SELECT exchange, symbol, day,
       lead(day) OVER (PARTITION BY exchange, symbol ORDER BY day) AS next_day
FROM (SELECT DISTINCT exchange, symbol, day FROM c_present)
""")

CTES.add("c_slices", """
SELECT *, CASE WHEN event_id % 13 = 0 THEN least(own + 2, 4) ELSE own END AS batch_id
FROM (SELECT *, (epoch_us(ts) - min(epoch_us(ts)) OVER ()) * 5
                // (max(epoch_us(ts)) OVER () - min(epoch_us(ts)) OVER () + 1) AS own
      FROM c_ev)
""")
CTES.add("c_marks", """
SELECT batch_id, max(max(ts)) OVER (ORDER BY batch_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
FROM c_slices GROUP BY batch_id
""")
CTES.add("c_outcomes", """
SELECT CASE WHEN route = 'malformed' THEN 'malformed' ELSE 'trade' END AS kind,
       CASE WHEN route = 'malformed' THEN 'JSONDecodeError'
            WHEN fault = 'shape' THEN 'NormalizationError'
            WHEN fault = 'value' THEN 'ValidationError' END AS error_type, ingested_at AS moment
FROM c_trade_rows WHERE route IN ('malformed', 'trade')
UNION ALL
SELECT 'bookTicker', CASE WHEN event_id % 107 = 0 THEN 'NormalizationError'
            WHEN event_id % 103 = 0 OR CAST(value AS DECIMAL(18,2)) <= 0 THEN 'ValidationError'
       END, ingested_at
FROM c_ev
""")

ORACLES = {
    "incremental_fact": MARKET["market_fact"],
    "market_fact_bucketed": MARKET["market_fact"],
    "kline_reconciliation_bucketed": MARKET["kline_reconciliation"],
    "lag_percentiles_rolled": CTES.query("""
        SELECT symbol, strftime(event_time, '%Y-%m-%d') AS day, count(*) AS observations,
               max(ingestion_lag_ms) AS max_lag_ms,
               quantile_disc(ingestion_lag_ms, 0.5) AS p50_lag_ms,
               quantile_disc(ingestion_lag_ms, 0.95) AS p95_lag_ms,
               quantile_disc(ingestion_lag_ms, 0.99) AS p99_lag_ms
        FROM c_landed GROUP BY 1, 2"""),
    "stream_late_rows": CTES.query("""
        SELECT event_id, ts, event_type, batch_id,
               coalesce(ts < mark - INTERVAL 1 HOUR, false) AS is_late
        FROM c_slices JOIN c_marks USING (batch_id)"""),
    "message_outcomes": CTES.query(f"""
        SELECT date_trunc('hour', moment) AS window_start, kind, error_type, count(*) AS messages,
               {dbl("count(*) / 3600.0", "messages_per_second")}
        FROM c_outcomes GROUP BY 1, 2, 3"""),
    "quarantine_check": CTES.query("""
        SELECT TIMESTAMP '2024-01-01' + to_days(CAST(d AS INTEGER)) AS as_of,
               count(event_id) AS quarantined, count(event_id) = 0 AS passed
        FROM range(24, 31) r(d) LEFT JOIN c_ev
          ON event_id % 101 = 0 AND ts < TIMESTAMP '2024-01-01' + to_days(CAST(d AS INTEGER))
         AND ts >= TIMESTAMP '2024-01-01' + to_days(CAST(d AS INTEGER)) - INTERVAL 24 HOUR
        GROUP BY 1"""),
    "instrument_scd2_incremental": MARKET["instrument_scd2_deletes"],
    "instrument_scd2_incremental_changes": MARKET["instrument_scd2"],
    "completeness_bitmap": CTES.query("""
        SELECT exchange, symbol, strftime(day, '%Y-%m-%d') AS day,
               count(*) - 1 AS minutes_present,
               round((count(*) - 1) / 1440.0, 6)::DOUBLE AS minute_coverage_ratio,
               count(*) FILTER (minute > before + 1) AS gaps,
               max(minute - before - 1) AS longest_gap,
               any_value(coalesce(date_diff('day', day, next_day) - 1, 0)) AS days_missing
        FROM c_steps JOIN c_days USING (exchange, symbol, day) GROUP BY 1, 2, c_steps.day"""),
    "backfill_bitmap": CTES.query("""
        SELECT exchange, symbol, make_timestamp(s * 60000000) AS starts_at,
               make_timestamp(least(s + 600, b) * 60000000) AS ends_at,
               least(s + 600, b) - s AS minutes
        FROM (
          SELECT exchange, symbol, b, unnest(range(a, b, 600)) AS s
          FROM (SELECT exchange, symbol, before + 1 AS a, minute AS b FROM c_steps
                WHERE minute > before + 1
                UNION ALL
                SELECT exchange, symbol,
                       epoch_us(CAST(day + 1 AS TIMESTAMP)) // 60000000,
                       epoch_us(CAST(next_day AS TIMESTAMP)) // 60000000
                FROM c_days WHERE next_day > day + 1))"""),
}
