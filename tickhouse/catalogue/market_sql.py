"""SQL counterparts of the market queries, in DuckDB's dialect."""

from __future__ import annotations

from tickhouse.catalogue.sqltext import Ctes, dbl, dbls, mean, r6

CTES = Ctes()

CTES.add("c_ev", """
SELECT event_id, user_id, event_type, value, ts,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       ts + to_milliseconds(event_id % 5000) AS ingested_at
FROM events
""")
CTES.add("c_arr", """
SELECT *, event_id * 2 + copy AS koff,
       ingested_at + to_seconds(60 + copy * 3600) AS lake
FROM (SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM c_ev)
""")

# Trades --------------------------------------------------------------------------------
CTES.add("c_landed", """
SELECT 'binance' AS exchange_id, event_type AS symbol, event_id AS trade_id,
       CAST(value AS DECIMAL(18,2)) AS price, k + 1 AS quantity,
       CAST(value AS DECIMAL(18,2)) * CAST(k + 1 AS DECIMAL(6,0)) AS notional,
       user_id % 2 = 0 AS buyer_is_maker, ts AS event_time,
       ingested_at AS producer_ingested_at, lake AS lake_ingested_at, koff AS kafka_offset,
       epoch_us(ingested_at) // 1000 - epoch_us(ts) // 1000 AS ingestion_lag_ms
FROM c_arr
""")
CTES.add("c_trades", """
SELECT * EXCLUDE (rn), CASE WHEN buyer_is_maker THEN -quantity ELSE quantity END AS signed_quantity,
       time_bucket(INTERVAL 1 MINUTE, event_time) AS bar_start_1m,
       time_bucket(INTERVAL 5 MINUTE, event_time) AS bar_start_5m
FROM (
  SELECT *,
         row_number() OVER (PARTITION BY exchange_id, symbol, trade_id
                            ORDER BY lake_ingested_at, kafka_offset) AS rn,
         count(*) OVER (PARTITION BY exchange_id, symbol, trade_id) AS _duplicate_count
  FROM c_landed)
WHERE rn = 1
""")


def _bars_cte(name: str, seconds: int, source: str = "c_trades", keys: str = "exchange_id, symbol"):
    floor = (f"make_timestamp((epoch_us(event_time) // {seconds * 1_000_000})"
             f" * {seconds * 1_000_000})")
    CTES.add(name + "_agg", f"""
SELECT {keys}, {floor} AS bar_start,
       first(price ORDER BY event_time, trade_id) AS open_price,
       max(price) AS high_price, min(price) AS low_price,
       last(price ORDER BY event_time, trade_id) AS close_price,
       CAST(sum(quantity) AS DECIMAL(38,2)) AS base_volume, sum(notional) AS quote_volume,
       count(*) AS trade_count,
       round(CAST(sum(notional) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE), 10) AS vwap,
       CAST(coalesce(sum(quantity) FILTER (WHERE NOT buyer_is_maker), 0) AS DECIMAL(38,2))
         AS taker_buy_base_volume,
       coalesce(sum(notional) FILTER (WHERE NOT buyer_is_maker), 0) AS taker_buy_quote_volume,
       round(CAST(sum(CASE WHEN buyer_is_maker THEN -quantity ELSE quantity END) AS DOUBLE)
             / CAST(sum(quantity) AS DOUBLE), 10) AS order_flow_imbalance,
       max(quantity) AS largest_trade_size,
       min(event_time) AS first_trade_time, max(event_time) AS last_trade_time,
       min(trade_id) AS first_trade_id, max(trade_id) AS last_trade_id,
       avg(ingestion_lag_ms) AS mean_ingestion_lag_ms, max(ingestion_lag_ms) AS max_ingestion_lag_ms,
       CAST(count(*) FILTER (WHERE _duplicate_count > 1) AS BIGINT) AS duplicated_trade_count,
       max(lake_ingested_at) AS built_from_data_as_of
FROM {source} GROUP BY ALL
""")
    CTES.add(name, f"""
SELECT *, bar_start + to_seconds({seconds}) AS bar_end,
       CAST(base_volume AS DOUBLE) / trade_count AS mean_trade_size,
       {r6("CAST(taker_buy_base_volume AS DOUBLE) / CAST(base_volume AS DOUBLE)")}
         AS taker_buy_ratio,
       {r6("CAST(high_price - low_price AS DOUBLE) * 20000 / CAST(high_price + low_price AS DOUBLE)")}
         AS range_bps,
       ln(CAST(close_price AS DOUBLE)
          / CAST(lag(close_price) OVER (PARTITION BY {keys} ORDER BY bar_start) AS DOUBLE))
         AS log_return
FROM {name}_agg
""")


_bars_cte("c_bars_m", 60)
_bars_cte("c_bars_f", 300)
_bars_cte("c_bars_h", 3_600)
_bars_cte("c_bars_w", 604_800)

BAR_NUMBERS = ("open_price", "high_price", "low_price", "close_price", "base_volume",
               "quote_volume", "vwap", "taker_buy_base_volume", "taker_buy_quote_volume",
               "order_flow_imbalance", "largest_trade_size", "mean_trade_size",
               "taker_buy_ratio", "range_bps", "mean_ingestion_lag_ms")
BAR_REST = ("bar_start, bar_end, trade_count, first_trade_time, last_trade_time, first_trade_id, "
            "last_trade_id, max_ingestion_lag_ms, duplicated_trade_count, built_from_data_as_of")


def _bars_sql(name: str, leave_out: tuple = ()) -> str:
    numbers = [c for c in (*BAR_NUMBERS, "log_return") if c not in leave_out]
    return CTES.query(f"SELECT exchange_id, symbol, {BAR_REST}, {dbls(*numbers)} FROM {name}")


CTES.add("c_tape", """
SELECT 'tape' AS exchange_id, 'S' || l_suppkey AS symbol, l_orderkey * 10 + l_linenumber AS trade_id,
       price, CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
       price * CAST(l_quantity AS DECIMAL(10,2)) AS notional,
       l_returnflag = 'R' AS buyer_is_maker, l_shipdate AS event_time,
       l_shipdate AS lake_ingested_at, CAST(l_linenumber * 1000 AS BIGINT) AS ingestion_lag_ms,
       1 AS _duplicate_count,
       ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][l_linenumber % 5 + 1]
         AS currency_pair
FROM (SELECT *, CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT))
                     * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS price FROM lineitem)
""")
_bars_cte("c_bars_tape", 86_400, "c_tape")

# Quotes --------------------------------------------------------------------------------
CTES.add("c_staged_quotes", f"""
SELECT *,
       (bid_price + ask_price) * 0.5 AS mid_price, ask_price - bid_price AS spread_absolute,
       CASE WHEN bid_price > 0 AND ask_price > bid_price THEN
         CAST({r6("CAST(ask_price - bid_price AS DOUBLE) * 20000"
                  " / CAST(bid_price + ask_price AS DOUBLE)")}
              AS DECIMAL(18,6)) END AS spread_bps,
       CAST({r6("CAST(bid_quantity - ask_quantity AS DOUBLE)"
                " / CAST(bid_quantity + ask_quantity AS DOUBLE)")}
            AS DECIMAL(18,6)) AS touch_imbalance
FROM (
  SELECT 'binance' AS exchange_id, event_type AS symbol, event_id * 7 AS update_id,
         CAST(value AS DECIMAL(18,2)) AS bid_price, user_id + 1 AS bid_quantity,
         CAST(value AS DECIMAL(18,2)) + CAST((k + 1) * 0.01 AS DECIMAL(18,2)) AS ask_price,
         k + 1 AS ask_quantity, ts AS event_time, lake AS lake_ingested_at, koff AS kafka_offset
  FROM c_arr)
""")
CTES.add("c_quotes", """
SELECT *, epoch_us(next_event_time) // 1000 - epoch_us(event_time) // 1000 AS prevailing_ms,
       time_bucket(INTERVAL 1 MINUTE, event_time) AS bar_start_1m
FROM (
  SELECT *,
         lead(event_time) OVER (PARTITION BY exchange_id, symbol ORDER BY event_time, update_id)
           AS next_event_time,
         greatest(coalesce(update_id - lag(update_id)
           OVER (PARTITION BY exchange_id, symbol ORDER BY update_id) - 1, 0), 0)
           AS book_updates_between
  FROM (SELECT *, row_number() OVER (PARTITION BY exchange_id, symbol, update_id
                                     ORDER BY lake_ingested_at, kafka_offset) AS rn
        FROM c_staged_quotes)
  WHERE rn = 1)
""")


def _metrics_cte(name: str, width: str, ms: int) -> None:
    CTES.add(name, f"""
SELECT exchange_id, symbol, time_bucket(INTERVAL {width}, event_time) AS bar_start,
       count(*) AS quote_count, CAST(sum(prevailing_ms) AS BIGINT) AS covered_ms,
       {mean("spread_bps")} AS mean_spread_bps,
       {r6("CAST(sum(spread_bps * CAST(prevailing_ms AS DECIMAL(18,0))) AS DOUBLE)"
           " / nullif(CAST(sum(prevailing_ms) AS DOUBLE), 0)")} AS time_weighted_spread_bps,
       min(spread_bps) AS min_spread_bps, max(spread_bps) AS max_spread_bps,
       quantile_disc(spread_bps, 0.5) AS median_spread_bps,
       {mean("bid_quantity + ask_quantity")} AS mean_touch_depth,
       {mean("touch_imbalance")}
         AS mean_touch_imbalance,
       last(mid_price ORDER BY event_time, update_id) AS closing_mid_price,
       CAST(sum(book_updates_between) AS BIGINT) AS book_updates_skipped,
       least({r6(f"CAST(sum(prevailing_ms) AS DOUBLE) / {ms}")}, 1.0) AS quote_coverage_ratio
FROM c_quotes WHERE prevailing_ms >= 0 GROUP BY ALL
""")


_metrics_cte("c_metrics_h", "1 HOUR", 3_600_000)
_metrics_cte("c_metrics_m", "1 MINUTE", 60_000)

# Rates ---------------------------------------------------------------------------------
CTES.add("c_fx", """
SELECT 'sample' AS rate_source, 'USDCOP' AS currency_pair, rate, valid_from,
       coalesce(lead(valid_from) OVER (ORDER BY valid_from), source_valid_to) AS valid_to,
       source_valid_to
FROM (
  SELECT make_timestamp((epoch_us(ts) // 172800000000) * 172800000000 + 21600000000) AS valid_from,
         4000 + max(CAST(value AS DECIMAL(18,2))) AS rate,
         make_timestamp((epoch_us(ts) // 172800000000) * 172800000000 + 21600000000)
           + INTERVAL 3 DAY AS source_valid_to
  FROM c_ev GROUP BY ALL)
""")
CTES.add("c_order_fx", """
SELECT currency_pair, rate, valid_from, publication_id,
       coalesce(lead(valid_from) OVER (PARTITION BY currency_pair ORDER BY valid_from),
                source_valid_to) AS valid_to,
       source_valid_to
FROM (SELECT o_orderpriority AS currency_pair, CAST(o_totalprice AS DECIMAL(18,2)) AS rate,
             o_orderdate AS valid_from, o_orderdate + INTERVAL 7 DAY AS source_valid_to,
             o_orderkey AS publication_id,
             row_number() OVER (PARTITION BY o_orderpriority, o_orderdate
                                ORDER BY o_orderkey DESC) AS rn
      FROM orders)
WHERE rn = 1
""")
FX_DERIVED = """date_diff('day', valid_from, valid_to) AS validity_days,
       valid_to <> source_valid_to AS was_rebounded"""

# Gold ----------------------------------------------------------------------------------


def _fact_cte(name: str, bars: str, metrics: str) -> None:
    CTES.add(name, f"""
SELECT b.exchange_id, b.symbol, b.bar_start, b.bar_end, b.open_price, b.high_price, b.low_price,
       b.close_price, b.vwap, b.base_volume, b.quote_volume, b.trade_count, b.log_return,
       b.range_bps, b.order_flow_imbalance, b.taker_buy_ratio, b.taker_buy_base_volume,
       b.largest_trade_size, b.mean_trade_size,
       q.time_weighted_spread_bps, q.mean_spread_bps, q.median_spread_bps, q.mean_touch_depth,
       q.mean_touch_imbalance, q.quote_count, q.quote_coverage_ratio, q.book_updates_skipped,
       f.rate AS usdcop_rate,
       CAST(b.close_price AS DECIMAL(18,2)) * CAST(f.rate AS DECIMAL(12,2)) AS close_price_cop,
       CAST(b.quote_volume AS DECIMAL(20,2)) * CAST(f.rate AS DECIMAL(12,2)) AS quote_volume_cop,
       b.max_ingestion_lag_ms, b.duplicated_trade_count,
       q.quote_count IS NULL AS is_quote_gap,
       coalesce(q.quote_coverage_ratio, 0) < 0.95 AS is_low_quote_coverage
FROM {bars} b
LEFT JOIN {metrics} q USING (exchange_id, symbol, bar_start)
LEFT JOIN c_fx f ON b.bar_start >= f.valid_from AND b.bar_start < f.valid_to
""")


_fact_cte("c_fact_h", "c_bars_h", "c_metrics_h")
_fact_cte("c_fact_m", "c_bars_m", "c_metrics_m")
FACT_NUMBERS = ("open_price", "high_price", "low_price", "close_price", "vwap", "base_volume",
                "quote_volume", "log_return", "range_bps", "order_flow_imbalance",
                "taker_buy_ratio", "taker_buy_base_volume", "largest_trade_size",
                "mean_trade_size", "time_weighted_spread_bps", "mean_spread_bps",
                "median_spread_bps", "mean_touch_depth", "mean_touch_imbalance",
                "quote_coverage_ratio", "usdcop_rate", "close_price_cop", "quote_volume_cop")

CTES.add("c_daily_agg", f"""
SELECT exchange_id, symbol, CAST(bar_start AS DATE) AS trading_date,
       first(open_price ORDER BY bar_start) AS open_price, max(high_price) AS high_price,
       min(low_price) AS low_price, last(close_price ORDER BY bar_start) AS close_price,
       sum(base_volume) AS base_volume, sum(quote_volume) AS quote_volume,
       CAST(sum(trade_count) AS BIGINT) AS trade_count,
       round(CAST(sum(CAST(CAST(vwap AS DECIMAL(18,9)) * CAST(base_volume AS DECIMAL(19,2))
             AS DECIMAL(38,11))) AS DOUBLE) / CAST(sum(base_volume) AS DOUBLE), 10) AS daily_vwap,
       {mean("time_weighted_spread_bps")} AS mean_spread_bps,
       quantile_disc(time_weighted_spread_bps, 0.5) AS median_spread_bps,
       {mean("mean_touch_depth")} AS mean_touch_depth,
       count(time_weighted_spread_bps) AS minutes_with_quotes, count(*) AS minutes_with_trades,
       {mean("order_flow_imbalance", 10)} AS mean_order_flow_imbalance,
       sum(taker_buy_base_volume) AS taker_buy_base_volume,
       stddev_samp(log_return) * sqrt(525600 // 60) AS realised_volatility_annualised,
       stddev_samp(log_return) AS minute_return_stddev,
       max(range_bps) AS max_minute_range_bps, max(usdcop_rate) AS usdcop_rate,
       count(*) FILTER (WHERE is_quote_gap) AS quote_gap_minutes,
       CAST(sum(book_updates_skipped) AS BIGINT) AS book_updates_skipped,
       max(max_ingestion_lag_ms) AS max_ingestion_lag_ms,
       sum(quote_volume_cop) AS quote_volume_cop_from_minutes
FROM c_fact_h GROUP BY ALL
""")
CTES.add("c_daily", f"""
SELECT *, {r6("CAST(minutes_with_trades AS DOUBLE) / 24")} AS minute_coverage_ratio,
       CAST(close_price - open_price AS DOUBLE) / CAST(open_price AS DOUBLE) AS daily_return,
       CAST(quote_volume AS DECIMAL(20,2)) * CAST(usdcop_rate AS DECIMAL(12,2)) AS quote_volume_cop,
       row_number() OVER (PARTITION BY trading_date
                          ORDER BY quote_volume DESC NULLS LAST, symbol, exchange_id)
         AS turnover_rank
FROM c_daily_agg
""")
DAILY_NUMBERS = ("open_price", "high_price", "low_price", "close_price", "base_volume",
                 "quote_volume", "daily_vwap", "mean_spread_bps", "median_spread_bps",
                 "mean_touch_depth", "mean_order_flow_imbalance", "taker_buy_base_volume",
                 "realised_volatility_annualised", "minute_return_stddev",
                 "max_minute_range_bps", "usdcop_rate", "quote_volume_cop_from_minutes",
                 "minute_coverage_ratio", "daily_return", "quote_volume_cop")

CTES.add("c_venue", """
SELECT 'binance' AS exchange_id, event_type AS symbol,
       time_bucket(INTERVAL 1 HOUR, ts) AS bar_start,
       first(CAST(value AS DECIMAL(18,2)) ORDER BY ts, event_id) AS open_price,
       max(CAST(value AS DECIMAL(18,2))) AS high_price,
       min(CAST(value AS DECIMAL(18,2))) AS low_price,
       last(CAST(value AS DECIMAL(18,2)) ORDER BY ts, event_id) AS close_price,
       CAST(sum(k + 1) AS DECIMAL(38,2)) AS base_volume,
       sum(CAST(value AS DECIMAL(18,2)) * CAST(k + 1 AS DECIMAL(6,0))) AS quote_volume,
       count(*) AS trade_count,
       coalesce(sum(k + 1) FILTER (WHERE user_id % 2 <> 0), 0) AS taker_buy_base_volume,
       coalesce(sum(CAST(value AS DECIMAL(18,2)) * CAST(k + 1 AS DECIMAL(6,0)))
                FILTER (WHERE user_id % 2 <> 0), 0) AS taker_buy_quote_volume
FROM c_ev WHERE k <> 13 GROUP BY ALL
""")
CTES.add("c_recon_raw", """
SELECT exchange_id, symbol, bar_start,
       o.close_price AS our_close_price, v.close_price AS venue_close_price,
       o.base_volume AS our_base_volume, v.base_volume AS venue_base_volume,
       o.trade_count AS our_trade_count, v.trade_count AS venue_trade_count,
       round(abs(CAST(o.close_price - v.close_price AS DOUBLE)) / CAST(v.close_price AS DOUBLE), 10)
         AS close_price_rel_diff,
       round(abs(CAST(o.base_volume - v.base_volume AS DOUBLE)) / CAST(v.base_volume AS DOUBLE), 10)
         AS volume_rel_diff,
       o.trade_count - v.trade_count AS trade_count_diff,
       CASE WHEN o.trade_count IS NULL THEN 'missing_from_ours'
            WHEN v.trade_count IS NULL THEN 'missing_from_venue' ELSE 'matched' END AS match_status
FROM c_bars_h o FULL OUTER JOIN c_venue v USING (exchange_id, symbol, bar_start)
""")
CTES.add("c_recon", """
SELECT *, CASE WHEN match_status <> 'matched' THEN 'unmatched'
               WHEN coalesce(close_price_rel_diff, 0) > 0.0001 THEN 'price_divergence'
               WHEN coalesce(volume_rel_diff, 0) > 0.005 THEN 'volume_divergence'
               WHEN abs(coalesce(trade_count_diff, 0)) > 2 THEN 'count_divergence'
               ELSE 'ok' END AS reconciliation_status
FROM c_recon_raw
""")
CTES.add("c_recon_daily", """
SELECT exchange_id, symbol, CAST(bar_start AS DATE) AS trading_date,
       count(*) AS reconciled_minutes,
       count(*) FILTER (WHERE reconciliation_status = 'ok') AS matched_minutes,
       count(*) FILTER (WHERE reconciliation_status = 'volume_divergence')
         AS volume_divergence_minutes,
       count(*) FILTER (WHERE match_status = 'missing_from_ours') AS minutes_we_missed,
       max(volume_rel_diff) AS worst_volume_rel_diff
FROM c_recon GROUP BY ALL
""")
CTES.add("c_delivery", """
SELECT exchange_id, symbol, CAST(event_time AS DATE) AS trading_date, count(*) AS trades,
       count(*) FILTER (WHERE _duplicate_count > 1) AS replayed_trades,
       avg(ingestion_lag_ms) AS mean_ingestion_lag_ms,
       quantile_disc(ingestion_lag_ms, 0.99) AS p99_ingestion_lag_ms
FROM c_trades GROUP BY ALL
""")
CTES.add("c_health_raw", f"""
SELECT exchange_id, symbol, trading_date, d.minutes_with_trades, d.minute_coverage_ratio,
       d.quote_gap_minutes, d.book_updates_skipped, d.max_ingestion_lag_ms,
       r.reconciled_minutes, r.matched_minutes, r.volume_divergence_minutes, r.minutes_we_missed,
       r.worst_volume_rel_diff, t.trades, t.replayed_trades, t.mean_ingestion_lag_ms,
       t.p99_ingestion_lag_ms,
       {r6("CAST(r.matched_minutes AS DOUBLE) / nullif(r.reconciled_minutes, 0)")}
         AS reconciliation_pass_ratio,
       {r6("CAST(t.replayed_trades AS DOUBLE) / nullif(t.trades, 0)")} AS duplicate_ratio
FROM c_daily d
LEFT JOIN c_recon_daily r USING (exchange_id, symbol, trading_date)
LEFT JOIN c_delivery t USING (exchange_id, symbol, trading_date)
""")
CTES.add("c_health", """
SELECT *, CASE WHEN minute_coverage_ratio < 0.90 OR coalesce(minutes_we_missed, 0) > 5
                 THEN 'incomplete'
               WHEN coalesce(reconciliation_pass_ratio, 1) < 0.98 THEN 'divergent'
               WHEN coalesce(p99_ingestion_lag_ms, 0) > 30000 THEN 'delayed'
               WHEN quote_gap_minutes > 120 THEN 'degraded_liquidity_view'
               ELSE 'good' END AS quality_verdict
FROM c_health_raw
""")
HEALTH_NUMBERS = ("minute_coverage_ratio", "worst_volume_rel_diff", "mean_ingestion_lag_ms",
                  "reconciliation_pass_ratio", "duplicate_ratio")
CTES.add("c_ranking", f"""
SELECT *,
       rank() OVER (PARTITION BY window_days ORDER BY quote_volume DESC NULLS LAST) AS turnover_rank,
       rank() OVER (PARTITION BY window_days ORDER BY mean_spread_bps NULLS LAST) AS tightness_rank,
       rank() OVER (PARTITION BY window_days ORDER BY liquidity_score DESC NULLS LAST)
         AS liquidity_rank
FROM (
  SELECT *, {r6("CAST(quote_volume AS DOUBLE) / mean_spread_bps")} AS liquidity_score
  FROM (
    SELECT CAST(w.days AS BIGINT) AS window_days, d.exchange_id, d.symbol,
           sum(d.quote_volume) AS quote_volume,
           {mean("d.mean_spread_bps")} AS mean_spread_bps,
           {mean("d.mean_touch_depth")} AS mean_touch_depth,
           {r6("avg(d.realised_volatility_annualised)")} AS realised_volatility,
           CAST(sum(d.trade_count) AS BIGINT) AS trade_count, count(*) AS days_observed
    FROM c_daily d
    JOIN c_health h USING (exchange_id, symbol, trading_date)
    JOIN (VALUES (1), (7), (30)) w(days)
      ON d.trading_date >= DATE '2024-01-31' - CAST(w.days AS INTEGER)
    WHERE h.quality_verdict = 'good'
    GROUP BY 1, 2, 3))
""")
RANK_NUMBERS = ("quote_volume", "mean_spread_bps", "mean_touch_depth", "realised_volatility",
                "liquidity_score")

# Instruments ---------------------------------------------------------------------------
CTES.add("c_dim", """
SELECT coalesce(r.symbol, o.symbol) AS symbol, r.base_asset, r.quote_asset, r.instrument_class,
       r.tick_size, r.step_size, r.min_notional, coalesce(r.is_tracked, false) AS is_tracked,
       o.first_trade_seen_at, o.last_trade_seen_at,
       coalesce(o.lifetime_trade_count, 0) AS lifetime_trade_count,
       coalesce(o.lifetime_notional, 0) AS lifetime_notional,
       CASE WHEN r.symbol IS NULL THEN 'unexpected_in_lake'
            WHEN o.symbol IS NULL AND r.is_tracked THEN 'tracked_but_absent'
            WHEN o.symbol IS NULL THEN 'reference_only' ELSE 'ok' END AS coverage_status
FROM (SELECT CAST(p_partkey + 100 AS VARCHAR) AS symbol, p_brand AS base_asset,
             p_type AS quote_asset, 'spot' AS instrument_class, 0.01 AS tick_size,
             1.0 AS step_size, 5.0 AS min_notional, p_size <= 40 AS is_tracked FROM part) r
FULL OUTER JOIN (
  SELECT CAST(l_partkey AS VARCHAR) AS symbol, min(l_shipdate) AS first_trade_seen_at,
         max(l_shipdate) AS last_trade_seen_at, count(*) AS lifetime_trade_count,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS lifetime_notional
  FROM lineitem GROUP BY 1) o ON r.symbol = o.symbol
""")
CTES.add("c_obs", """
SELECT 'S' || o_custkey AS symbol, o_orderstatus AS status,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) / 100.0 AS tick_size, 0.001 AS step_size,
       CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) > 2 THEN 5.0 ELSE 10.0 END
         AS min_notional,
       o_orderdate AS observed_at, o_orderkey AS observation_id
FROM orders
""")
CTES.add("c_obs_latest", """
SELECT * FROM c_obs
QUALIFY row_number() OVER (PARTITION BY symbol, observed_at ORDER BY observation_id DESC) = 1
""")
CTES.add("c_history", """
SELECT symbol, status, tick_size, step_size, min_notional, observed_at AS valid_from,
       lead(observed_at) OVER (PARTITION BY symbol ORDER BY observed_at) AS valid_to
FROM (SELECT *, lag((status, tick_size, step_size, min_notional))
                  OVER (PARTITION BY symbol ORDER BY observed_at) AS was,
             row_number() OVER (PARTITION BY symbol ORDER BY observed_at) AS rn
      FROM c_obs_latest)
WHERE rn = 1 OR was IS DISTINCT FROM (status, tick_size, step_size, min_notional)
""")
CTES.add("c_poll", """
SELECT symbol, status, tick_size, step_size, min_notional,
       date_trunc('quarter', observed_at) AS observed_at, observation_id
FROM c_obs
QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('quarter', observed_at)
                           ORDER BY observation_id DESC) = 1
""")
CTES.add("c_poll_batches", """
SELECT observed_at, lead(observed_at) OVER (ORDER BY observed_at) AS next_batch
FROM (SELECT DISTINCT observed_at FROM c_poll)
""")
CTES.add("c_poll_runs", """
SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END)
            OVER (PARTITION BY symbol ORDER BY observed_at) AS version
FROM (
  SELECT p.*, b.next_batch,
         lag(b.next_batch) OVER w IS DISTINCT FROM p.observed_at
         OR lag((status, tick_size, step_size, min_notional)) OVER w
            IS DISTINCT FROM (status, tick_size, step_size, min_notional) AS starts
  FROM c_poll p JOIN c_poll_batches b USING (observed_at)
  WINDOW w AS (PARTITION BY p.symbol ORDER BY p.observed_at))
""")
HISTORY_NUMBERS = dbls("tick_size", "step_size", "min_notional")

CTES.add("c_seq", """
SELECT event_type AS symbol, event_id AS kafka_offset,
       strftime(ts, '%Y-%m-%d') AS session,
       event_id * 7 - CASE WHEN k < 10 THEN 500 ELSE 0 END AS update_id
FROM c_ev
""")

ORACLES = {
    "dedup_trades": CTES.query(f"""
        SELECT exchange_id, symbol, trade_id,
               {dbls("price", "quantity", "notional", "signed_quantity")},
               event_time, producer_ingested_at, lake_ingested_at, kafka_offset, ingestion_lag_ms,
               bar_start_1m, bar_start_5m, _duplicate_count
        FROM c_trades"""),
    "dedup_lineitem": f"""
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate, l_partkey,
               l_suppkey, {dbls("l_quantity", "l_extendedprice")}, copies
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies,
                     row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                       ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                                l_extendedprice DESC) AS rn
              FROM lineitem) WHERE rn = 1""",
    "duplicate_rate": CTES.query(f"""
        SELECT exchange_id, symbol, count(*) AS trades,
               count(*) FILTER (WHERE _duplicate_count > 1) AS replayed_trades,
               CAST(sum(_duplicate_count) AS BIGINT) AS landed_rows,
               {dbl("count(*) FILTER (WHERE _duplicate_count > 1) / CAST(count(*) AS DOUBLE)",
                    "duplicate_ratio")}
        FROM c_trades GROUP BY ALL"""),
    "stage_trades": CTES.query(f"""
        SELECT exchange_id, symbol, trade_id, {dbls("price", "quantity", "notional")},
               buyer_is_maker, NOT buyer_is_maker AS is_buyer_aggressor, event_time,
               event_time AS venue_publish_time, producer_ingested_at, lake_ingested_at,
               kafka_offset, CAST(1 AS BIGINT) AS schema_version, ingestion_lag_ms,
               {dbl("CASE WHEN buyer_is_maker THEN -quantity ELSE quantity END",
                    "signed_quantity")},
               time_bucket(INTERVAL 1 MINUTE, event_time) AS bar_start_1m,
               time_bucket(INTERVAL 5 MINUTE, event_time) AS bar_start_5m
        FROM c_landed"""),
    "stage_quotes": CTES.query(f"""
        SELECT exchange_id, symbol, update_id,
               {dbls("bid_price", "bid_quantity", "ask_price", "ask_quantity", "mid_price",
                     "spread_bps", "spread_absolute", "touch_imbalance")},
               event_time, lake_ingested_at, kafka_offset
        FROM c_staged_quotes"""),
    "stage_klines": CTES.query(f"""
        SELECT exchange_id, symbol, '1h' AS bar_interval, bar_start,
               bar_start + INTERVAL 1 HOUR AS bar_end,
               {dbls("open_price", "high_price", "low_price", "close_price", "base_volume",
                     "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")},
               trade_count
        FROM c_venue"""),
    "stage_fx": CTES.query(f"""
        SELECT rate_source, 'USD' AS base_currency, 'COP' AS quote_currency, currency_pair,
               {dbls("rate")}, valid_from, source_valid_to AS valid_to,
               date_diff('day', valid_from, source_valid_to) AS validity_days
        FROM c_fx"""),
    "bars_1m": _bars_sql("c_bars_m"),
    "bars_5m": _bars_sql("c_bars_f"),
    "bars_1h": _bars_sql("c_bars_h"),
    "bars_1w": _bars_sql("c_bars_w"),
    "bars_lineitem_daily": _bars_sql("c_bars_tape", ("open_price", "close_price", "log_return")),
    "quote_durations": CTES.query(f"""
        SELECT exchange_id, symbol, update_id, {dbls("spread_bps", "mid_price")}, event_time,
               next_event_time, prevailing_ms, book_updates_between, bar_start_1m
        FROM c_quotes"""),
    "quote_metrics_1h": CTES.query(f"""
        SELECT exchange_id, symbol, bar_start, quote_count, covered_ms, book_updates_skipped,
               {dbls("mean_spread_bps", "time_weighted_spread_bps", "min_spread_bps",
                     "max_spread_bps", "median_spread_bps", "mean_touch_depth",
                     "mean_touch_imbalance", "closing_mid_price", "quote_coverage_ratio")}
        FROM c_metrics_h"""),
    "quote_metrics_1h_clipped": CTES.query(f"""
        SELECT exchange_id, symbol, bar_start, count(*) AS quote_count,
               CAST(sum(ms) AS BIGINT) AS covered_ms,
               {dbl("CAST(sum(spread_bps * CAST(ms AS DECIMAL(18,0))) AS DOUBLE)"
                    " / nullif(CAST(sum(ms) AS DOUBLE), 0)", "time_weighted_spread_bps")},
               CAST(sum(churn) AS BIGINT) AS book_updates_skipped,
               {dbl("least(sum(ms) / 3600000.0, 1.0)", "quote_coverage_ratio")}
        FROM (
          SELECT exchange_id, symbol, spread_bps, bar AS bar_start,
                 epoch_us(least(next_event_time, bar + INTERVAL 1 HOUR)) // 1000
                   - epoch_us(greatest(event_time, bar)) // 1000 AS ms,
                 CASE WHEN bar <= event_time THEN book_updates_between ELSE 0 END AS churn
          FROM (SELECT *, unnest(generate_series(date_trunc('hour', event_time),
                         greatest(date_trunc('hour', next_event_time - INTERVAL 1 MICROSECOND),
                                  date_trunc('hour', event_time)),
                         INTERVAL 1 HOUR)) AS bar
                FROM c_quotes WHERE prevailing_ms >= 0))
        GROUP BY ALL"""),
    "fx_intervals": CTES.query(f"""
        SELECT currency_pair, {dbls("rate")}, valid_from, valid_to, source_valid_to,
               publication_id, {FX_DERIVED} FROM c_order_fx"""),
    "fx_intervals_events": CTES.query(f"""
        SELECT rate_source, currency_pair, {dbls("rate")}, valid_from, valid_to, source_valid_to,
               {FX_DERIVED} FROM c_fx"""),
}

_range_join = CTES.query(f"""
    SELECT t.trade_id, t.symbol, t.event_time, t.currency_pair, {dbl("t.notional", "notional")},
           {dbl("f.rate", "rate")}, f.valid_from
    FROM c_tape t LEFT JOIN c_order_fx f
      ON t.currency_pair = f.currency_pair
     AND t.event_time >= f.valid_from AND t.event_time < f.valid_to""")

ORACLES |= {
    "fx_range_join": _range_join,
    "fx_range_join_bucketed": _range_join,
    "market_fact": CTES.query(f"""
        SELECT exchange_id, symbol, bar_start, bar_end, trade_count, {dbls(*FACT_NUMBERS)},
               quote_count, book_updates_skipped, max_ingestion_lag_ms, duplicated_trade_count,
               is_quote_gap, is_low_quote_coverage
        FROM c_fact_h"""),
    "market_fact_1m": CTES.query(f"""
        SELECT exchange_id, symbol, bar_start, trade_count,
               {dbls("close_price", "vwap", "log_return", "time_weighted_spread_bps",
                     "quote_coverage_ratio", "usdcop_rate", "close_price_cop",
                     "quote_volume_cop")},
               is_quote_gap, is_low_quote_coverage
        FROM c_fact_m"""),
    "symbol_daily": CTES.query(f"""
        SELECT exchange_id, symbol, CAST(trading_date AS VARCHAR) AS trading_date,
               {dbls(*DAILY_NUMBERS)}, trade_count, minutes_with_quotes, minutes_with_trades,
               quote_gap_minutes, book_updates_skipped, max_ingestion_lag_ms, turnover_rank
        FROM c_daily"""),
    "realised_volatility": CTES.query(f"""
        SELECT exchange_id, symbol, {dbl("stddev_samp(log_return)", "return_stddev")},
               {dbl("stddev_samp(log_return) * sqrt(8760)", "realised_volatility_annualised")}
        FROM c_bars_h GROUP BY ALL"""),
    "turnover_rank": CTES.query(f"""
        SELECT CAST(trading_date AS VARCHAR) AS trading_date, exchange_id, symbol,
               {dbls("quote_volume")}, turnover_rank FROM c_daily"""),
    "kline_reconciliation": CTES.query(f"""
        SELECT exchange_id, symbol, bar_start,
               {dbls("our_close_price", "venue_close_price", "our_base_volume",
                     "venue_base_volume", "close_price_rel_diff", "volume_rel_diff")},
               our_trade_count, venue_trade_count, trade_count_diff, match_status,
               reconciliation_status FROM c_recon"""),
    "reconciliation_daily": CTES.query(f"""
        SELECT exchange_id, symbol, CAST(trading_date AS VARCHAR) AS trading_date,
               reconciled_minutes, matched_minutes, volume_divergence_minutes, minutes_we_missed,
               {dbls("worst_volume_rel_diff")} FROM c_recon_daily"""),
    "delivery_daily": CTES.query(f"""
        SELECT exchange_id, symbol, CAST(trading_date AS VARCHAR) AS trading_date, trades,
               replayed_trades, {dbls("mean_ingestion_lag_ms")}, p99_ingestion_lag_ms
        FROM c_delivery"""),
    "instrument_day_health": CTES.query(f"""
        SELECT exchange_id, symbol, CAST(trading_date AS VARCHAR) AS trading_date,
               minutes_with_trades, quote_gap_minutes, book_updates_skipped, max_ingestion_lag_ms,
               reconciled_minutes, matched_minutes, volume_divergence_minutes, minutes_we_missed,
               trades, replayed_trades, p99_ingestion_lag_ms, {dbls(*HEALTH_NUMBERS)},
               quality_verdict FROM c_health"""),
    "liquidity_ranking": CTES.query(f"""
        SELECT window_days, exchange_id, symbol, {dbls(*RANK_NUMBERS)}, trade_count,
               days_observed, turnover_rank, tightness_rank, liquidity_rank FROM c_ranking"""),
    "dim_instrument": CTES.query(f"""
        SELECT symbol, base_asset, quote_asset, instrument_class,
               {dbls("tick_size", "step_size", "min_notional", "lifetime_notional")}, is_tracked,
               first_trade_seen_at, last_trade_seen_at, lifetime_trade_count, coverage_status
        FROM c_dim"""),
    "instrument_scd2": CTES.query(f"""
        SELECT symbol, status, {HISTORY_NUMBERS}, valid_from, valid_to,
               valid_to IS NULL AS is_current FROM c_history"""),
    "instrument_scd2_deletes": CTES.query(f"""
        SELECT symbol, first(status ORDER BY observed_at) AS status,
               {dbl("first(tick_size ORDER BY observed_at)", "tick_size")},
               {dbl("first(step_size ORDER BY observed_at)", "step_size")},
               {dbl("first(min_notional ORDER BY observed_at)", "min_notional")},
               min(observed_at) AS valid_from, last(next_batch ORDER BY observed_at) AS valid_to,
               last(next_batch ORDER BY observed_at) IS NULL AS is_current
        FROM c_poll_runs GROUP BY symbol, version"""),
    "tick_asof": CTES.query(f"""
        SELECT t.trade_id, t.symbol, t.event_time, {dbl("t.price", "price")},
               {dbl("h.tick_size", "tick_size")}, h.valid_from,
               CAST(t.price * 100 AS BIGINT) % CAST(h.tick_size * 100 AS BIGINT) <> 0 AS is_off_grid
        FROM c_tape t LEFT JOIN c_history h
          ON t.symbol = h.symbol AND t.event_time >= h.valid_from
         AND (h.valid_to IS NULL OR t.event_time < h.valid_to)"""),
    "sequence_observations": CTES.query("""
        SELECT symbol, kafka_offset, session, update_id, high IS NULL AS first_seen,
               coalesce(update_id <= high, false) AS regressed,
               CASE WHEN high IS NULL OR update_id <= high THEN 0
                    ELSE update_id - high - 1 END AS span
        FROM (SELECT *, max(update_id) OVER (PARTITION BY symbol, session ORDER BY kafka_offset
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM c_seq)"""),
    "serve_instruments": CTES.query(f"""
        SELECT symbol, base_asset, quote_asset, instrument_class, {dbls("tick_size")}, is_tracked,
               coverage_status, first_trade_seen_at, last_trade_seen_at, lifetime_trade_count
        FROM c_dim WHERE is_tracked"""),
    "serve_candles": CTES.query(f"""
        SELECT symbol, bar_start, {dbls("open_price", "high_price", "low_price", "close_price",
               "vwap", "base_volume", "quote_volume", "order_flow_imbalance",
               "time_weighted_spread_bps")}, trade_count, is_quote_gap
        FROM c_fact_h
        WHERE symbol = 'click' AND bar_start >= TIMESTAMP '2024-01-05'
          AND bar_start < TIMESTAMP '2024-01-12'
        ORDER BY bar_start LIMIT 500"""),
    "serve_liquidity": CTES.query(f"""
        SELECT window_days, symbol, {dbls(*RANK_NUMBERS)}, liquidity_rank, turnover_rank,
               tightness_rank, days_observed
        FROM c_ranking WHERE window_days = 30 ORDER BY liquidity_rank, symbol LIMIT 50"""),
    "serve_quality": CTES.query(f"""
        SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, quality_verdict,
               {dbls("minute_coverage_ratio", "reconciliation_pass_ratio", "duplicate_ratio")},
               p99_ingestion_lag_ms, quote_gap_minutes, book_updates_skipped
        FROM c_health
        WHERE symbol = 'view' AND trading_date >= DATE '2024-01-31' - 30"""),
}
