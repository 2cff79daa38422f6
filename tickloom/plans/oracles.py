"""The same queries in SQL for an independent engine, written from the rules and not from the plans."""

from __future__ import annotations

from tickloom.plans.queries import LATE_SHIFT_SECONDS, RANGE_END, RANGE_START, SUBSCRIBED
from tickloom.plans.upkeep_queries import FAR_AHEAD, LOOKUP_END, LOOKUP_START, LOOKUP_SYMBOL, SILENT_AFTER

_SUBSCRIBED = ", ".join(f"'{symbol}'" for symbol in SUBSCRIBED)


# Only text of four digits for the year, a time and an offset is a time.
_TIME = "CASE WHEN regexp_matches({0}, '^[0-9]{{4}}-[0-9-]+T[0-9:.]+[+]00:00$') THEN try_cast(left({0}, 26) AS TIMESTAMP) END"
_TRADE_TIME, _ARRIVAL = _TIME.format("trade_timestamp"), _TIME.format("ingestion_timestamp")


_FIELDS = ["symbol", "price", "volume", "trade_timestamp", "ingestion_timestamp", "source"]
_decoded = ", ".join(f"CASE WHEN event_id % 59 <> 0 THEN {field} END AS {field}" for field in _FIELDS)
_pairs = ", ".join(f"'{field}', {field}" for field in _FIELDS)


def _wire(name: str, shift_seconds: int = 0) -> str:
    return f"""
{name}_fields AS (
  SELECT event_id,
    CASE WHEN event_id % 19 <> 0 THEN event_type END AS symbol,
    CASE WHEN event_id % 13 = 0 THEN '-1' WHEN event_id % 17 = 0 THEN 'abc'
         WHEN event_id % 61 = 0 THEN '12345678.5' WHEN event_id % 67 = 0 THEN '0.000125'
         ELSE CAST(value AS VARCHAR) END AS price,
    CASE WHEN event_id % 29 = 0 THEN '-5' WHEN event_id % 37 = 0 THEN '10.5'
         ELSE json_extract_string(props, '$.k') END AS volume,
    CASE WHEN event_id % 69 = 0 THEN '10:00:00' WHEN event_id % 115 = 0 THEN '99999-01-01T00:00:00+00:00'
         WHEN event_id % 23 = 0 THEN 'nope'
         ELSE strftime(ts + to_seconds({shift_seconds}), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS trade_timestamp,
    strftime(ts + to_seconds({shift_seconds} + 1 + 5 * replay), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
      AS ingestion_timestamp,
    'events' AS source
  FROM (SELECT *, unnest(CASE WHEN event_id % 11 = 0 THEN [0, 1] ELSE [0] END) AS replay FROM events)
),
{name} AS (
  SELECT {_decoded},
    CASE WHEN event_id % 59 = 0 THEN 'garbage ' || event_id
         ELSE CAST(json_object({_pairs}) AS VARCHAR) END AS message
  FROM {name}_fields
)"""


def _typed(name: str, wire: str) -> str:
    return f"""
{name} AS (
  SELECT symbol,
         try_cast(price AS DOUBLE) AS price,
         CAST(trunc(try_cast(volume AS DECIMAL(38, 9))) AS BIGINT) AS volume,
         {_TRADE_TIME} AS trade_timestamp,
         {_ARRIVAL} AS ingestion_timestamp,
         source
  FROM {wire}
)"""


def _clean(name: str, typed: str, literal: bool = False) -> str:
    timed = "" if literal else "AND trade_timestamp IS NOT NULL AND ingestion_timestamp IS NOT NULL"
    return f"""
{name} AS (
  SELECT *, CAST(trade_timestamp AS DATE) AS trade_date FROM {typed}
  WHERE symbol <> '' AND price > 0 AND price < 'infinity' AND volume >= 0 {timed}
)"""


def _dedup(name: str, clean: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY symbol, trade_timestamp ORDER BY ingestion_timestamp, price, volume, source) AS copy
    FROM {clean})
  WHERE copy = 1
)"""


def _windows(name: str, trades: str, width: str = "1 minute") -> str:
    return f"""
{name} AS (
  SELECT symbol, window_start, window_start + INTERVAL {width} AS window_end,
         avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price,
         CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS trade_count,
         CAST(window_start AS DATE) AS trade_date
  FROM (SELECT *, time_bucket(INTERVAL {width}, trade_timestamp) AS window_start FROM {trades}
        WHERE trade_timestamp IS NOT NULL)
  GROUP BY symbol, window_start
)"""


_WATERMARK = """
mark AS (SELECT date_trunc('milliseconds', max(trade_timestamp)) - INTERVAL 2 MINUTE AS watermark FROM clean)"""

# Runs of trades of a symbol without a longer pause; a new one starts behind every pause.
_SPANS = f"""
paused AS (
  SELECT symbol, trade_timestamp,
         CASE WHEN trade_timestamp > lag(trade_timestamp) OVER (PARTITION BY symbol ORDER BY trade_timestamp) + INTERVAL {SILENT_AFTER}
              THEN 1 ELSE 0 END AS fresh FROM trades),
numbered AS (
  SELECT symbol, trade_timestamp, sum(fresh) OVER (PARTITION BY symbol ORDER BY trade_timestamp) AS span FROM paused),
spans AS (
  SELECT symbol, min(trade_timestamp) AS first_trade, max(trade_timestamp) AS last_trade,
         max(trade_timestamp) + INTERVAL {SILENT_AFTER} AS silent_at, count(*) AS trade_count FROM numbered GROUP BY symbol, span)"""

_CLEAN = [_wire("wire"), _typed("typed", "wire"), _clean("clean", "typed")]
_CLEAN_LITERAL = [_wire("wire"), _typed("typed", "wire"), _clean("clean", "typed", literal=True)]
_TRADES = [*_CLEAN, _dedup("trades", "clean")]
_WINDOWS = [*_TRADES, _windows("windows", "trades")]
_LATE = [
    *_TRADES,
    _WATERMARK,
    _wire("late_wire", LATE_SHIFT_SECONDS),
    _typed("late_typed", "late_wire"),
    _clean("late", "late_typed"),
]

_MESSAGES = """
messages AS (
  SELECT event_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE WHEN event_id % 31 = 0 OR event_id % 37 = 0 THEN 'other'
              WHEN event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 = 0 THEN 'malformed'
              ELSE 'usable' END AS kind
  FROM events
)"""

_VENDOR = [
    _MESSAGES,
    """
vendor AS (
  SELECT event_type AS symbol, value AS price, k AS volume,
         date_trunc('milliseconds', ts) AS trade_timestamp, 'events' AS source
  FROM messages WHERE kind = 'usable'
  UNION ALL
  SELECT event_type, value, k, date_trunc('milliseconds', ts) + INTERVAL 1 MILLISECOND, 'events'
  FROM messages WHERE kind = 'usable' AND event_id % 5 = 0
)""",
]

_STORED = "symbol, price, volume, trade_timestamp, source, trade_date"
_WINDOW_ROW = (
    "symbol, window_start, window_end, round(avg_price, 6) AS avg_price, min_price, max_price, "
    "total_volume, trade_count"
)
_ISO = (
    "CASE WHEN {0} = date_trunc('second', {0}) THEN strftime({0}, '%Y-%m-%dT%H:%M:%S') "
    "ELSE strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00'"
)


def _sql(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


_PRICE = "try_cast(price AS DOUBLE)"
_VOLUME = "trunc(try_cast(volume AS DECIMAL(38, 9)))"


def _judged(name: str, wire: str) -> str:
    """The wire text with the first rule it fails."""
    return f"""
{name} AS (
  SELECT *, CASE
    WHEN message LIKE 'garbage%' THEN 'json'
    WHEN symbol IS NULL OR symbol = '' THEN 'symbol'
    WHEN {_PRICE} IS NULL OR NOT ({_PRICE} > 0 AND {_PRICE} < 'infinity') THEN 'price'
    WHEN {_VOLUME} IS NULL OR {_VOLUME} < 0 THEN 'volume'
    WHEN {_TRADE_TIME} IS NULL OR {_ARRIVAL} IS NULL THEN 'time'
    ELSE 'accepted' END AS reject_reason
  FROM {wire}
)"""


ORACLES: dict[str, str] = {
    "wire_decode": _sql([_wire("wire")], "SELECT * EXCLUDE (message) FROM wire"),
    "trade_clean": _sql(_CLEAN, "SELECT * FROM clean"),
    "trade_clean_literal": _sql(_CLEAN_LITERAL, "SELECT * FROM clean"),
    "trade_dedup": _sql(_TRADES, "SELECT * FROM trades"),
    "trade_dedup_literal": _sql([*_CLEAN_LITERAL, _dedup("trades", "clean")], "SELECT * FROM trades"),
    "trade_agg_1m": _sql(_WINDOWS, f"SELECT {_WINDOW_ROW}, trade_date FROM windows"),
    "trade_agg_5m": _sql(
        [*_TRADES, _windows("windows", "trades", "5 minutes")], f"SELECT {_WINDOW_ROW}, trade_date FROM windows"
    ),
    "symbol_summary": _sql(
        _WINDOWS,
        """
SELECT symbol, max(window_start) AS latest_window_start, CAST(sum(total_volume) AS BIGINT) AS total_volume,
       CAST(sum(trade_count) AS BIGINT) AS trade_count, round(avg(avg_price), 6) AS avg_price
FROM windows GROUP BY symbol""",
    ),
    "latest_trades": _sql(_TRADES, "SELECT * FROM trades ORDER BY trade_timestamp DESC, symbol LIMIT 20"),
    "latest_windows": _sql(
        _WINDOWS, f"SELECT {_WINDOW_ROW} FROM windows ORDER BY window_start DESC, symbol LIMIT 50"
    ),
    "raw_count": _sql(_TRADES, "SELECT count(*) AS raw_count FROM trades"),
    "aggregated_count": _sql(_WINDOWS, "SELECT count(*) AS aggregated_count FROM windows"),
    "chart_price_series": _sql(
        _TRADES, "SELECT trade_timestamp, symbol, price FROM trades ORDER BY trade_timestamp, symbol"
    ),
    "chart_price_range": _sql(
        _TRADES,
        f"""
SELECT symbol, time_bucket(INTERVAL 1 HOUR, trade_timestamp) AS bucket_start,
       arg_min(price, trade_timestamp) AS first_price, min(price) AS min_price, max(price) AS max_price,
       arg_max(price, trade_timestamp) AS last_price
FROM trades
WHERE trade_timestamp >= TIMESTAMP '{RANGE_START}' AND trade_timestamp < TIMESTAMP '{RANGE_END}'
  AND symbol IN ({_SUBSCRIBED})
GROUP BY 1, 2""",
    ),
    "chart_avg_price": _sql(
        _WINDOWS,
        "SELECT window_start, symbol, round(avg_price, 6) AS avg_price FROM windows ORDER BY window_start, symbol",
    ),
    "chart_volume_by_symbol": _sql(
        _WINDOWS, "SELECT symbol, CAST(sum(total_volume) AS BIGINT) AS total_volume FROM windows GROUP BY symbol"
    ),
    "chart_total_trades": _sql(
        _WINDOWS, "SELECT CAST(coalesce(sum(trade_count), 0) AS BIGINT) AS trade_count FROM windows"
    ),
    "activity_heatmap": _sql(
        _TRADES,
        """
SELECT symbol, time_bucket(INTERVAL 1 HOUR, trade_timestamp) AS bucket_start, count(*) AS trade_count
FROM trades GROUP BY 1, 2""",
    ),
    "vendor_explode": _sql(_VENDOR, "SELECT * FROM vendor"),
    "vendor_malformed": _sql([_MESSAGES], "SELECT event_id FROM messages WHERE kind = 'malformed'"),
    "vendor_ingest": _sql(
        _VENDOR,
        f"""
SELECT *, CAST(trade_timestamp AS DATE) AS trade_date FROM vendor
WHERE symbol IN ({_SUBSCRIBED}) AND price > 0 AND volume >= 0""",
    ),
    "vendor_rejects": _sql(
        [
            _MESSAGES,
            """
items AS (
  SELECT event_type AS s, value AS p, CAST(k AS DECIMAL(12, 2)) AS v, epoch_us(ts) // 1000 AS t FROM messages WHERE kind = 'usable'
  UNION ALL
  SELECT event_type, value, NULL, epoch_us(ts) // 1000 FROM messages WHERE kind = 'usable' AND event_id % 7 = 0
  UNION ALL
  SELECT event_type, value, CAST(k AS DECIMAL(12, 2)) + 0.75, epoch_us(ts) // 1000 + 1
  FROM messages WHERE kind = 'usable' AND event_id % 5 = 0
  UNION ALL
  SELECT event_type, NULL, CAST(k AS DECIMAL(12, 2)), epoch_us(ts) // 1000 FROM messages
  WHERE event_id % 47 = 0 AND event_id % 31 <> 0 AND event_id % 37 <> 0 AND event_id % 41 <> 0 AND event_id % 43 <> 0
),
judged AS (
  SELECT s AS symbol, CAST(p AS VARCHAR) AS price, CAST(CAST(v AS DOUBLE) AS VARCHAR) AS volume, CAST(t AS VARCHAR) AS trade_timestamp,
         CASE WHEN p IS NULL OR p <= 0 THEN 'price' WHEN v IS NULL OR v < 0 THEN 'volume' END AS reject_reason
  FROM items
)""",
        ],
        "SELECT * FROM judged WHERE reject_reason IS NOT NULL",
    ),
    "reject_report": _sql(
        [_wire("wire"), _judged("judged", "wire")],
        "SELECT reject_reason AS outcome, count(*) AS trade_count FROM judged GROUP BY outcome",
    ),
    "reject_rows": _sql(
        [_wire("wire"), _judged("judged", "wire")], "SELECT * FROM judged WHERE reject_reason <> 'accepted'"
    ),
    "symbol_allow_list": _sql(_CLEAN, f"SELECT * FROM clean WHERE symbol IN ({_SUBSCRIBED})"),
    "kafka_payload": _sql(
        _TRADES,
        f"""
SELECT symbol AS key,
       CAST(json_object('symbol', symbol, 'price', CASE WHEN price = 0.000125 THEN '0.000125' ELSE CAST(price AS VARCHAR) END, 'volume', volume,
            'trade_timestamp', {_ISO.format('trade_timestamp')},
            'ingestion_timestamp', {_ISO.format('ingestion_timestamp')}, 'source', source) AS VARCHAR) AS value
FROM trades""",
    ),
    "raw_table_roundtrip": _sql(_TRADES, "SELECT * FROM trades"),
    "raw_table_pruned_read": _sql(
        _TRADES,
        f"""
SELECT * FROM trades
WHERE trade_timestamp >= TIMESTAMP '{RANGE_START}' AND trade_timestamp < TIMESTAMP '{RANGE_END}'
  AND symbol IN ({_SUBSCRIBED})""",
    ),
    "idempotent_append": _sql(_TRADES, "SELECT * FROM trades"),
    "freshness_report": _sql(
        _TRADES,
        """
SELECT symbol, count(*) AS row_count, max(trade_timestamp) AS last_trade,
       max(ingestion_timestamp) AS last_ingestion,
       CAST(date_diff('second', max(trade_timestamp), max(ingestion_timestamp)) AS BIGINT) AS ingest_lag_seconds
FROM trades GROUP BY symbol""",
    ),
    "aggregated_table_range": _sql(
        _WINDOWS,
        f"""
SELECT {_WINDOW_ROW}, trade_date FROM windows
WHERE window_start >= TIMESTAMP '{RANGE_START}' AND window_start < TIMESTAMP '{RANGE_END}'""",
    ),
    "reconcile_raw_agg": _sql(
        _TRADES,
        """
SELECT symbol, trade_date, count(*) AS raw_count, count(*) AS aggregated_count,
       CAST(0 AS BIGINT) AS difference
FROM trades GROUP BY symbol, trade_date""",
    ),
    "stream_raw": _sql(_TRADES, f"SELECT {_STORED} FROM trades"),
    "stream_agg_1m": _sql(
        [*_WINDOWS, _WATERMARK],
        f"SELECT {_WINDOW_ROW}, trade_date FROM windows, mark WHERE window_end <= watermark",
    ),
    "stream_batch_append": _sql(_TRADES, f"SELECT {_STORED} FROM trades"),
    "stream_restart": _sql(
        [*_WINDOWS, _WATERMARK],
        f"SELECT {_WINDOW_ROW}, trade_date FROM windows, mark WHERE window_end <= watermark",
    ),
    "stream_late_data": _sql(
        [
            *_LATE,
            f"""
both_waves AS (
  SELECT * FROM trades UNION ALL SELECT late.* FROM late, mark WHERE trade_timestamp > watermark
)""",
            _dedup("stored", "both_waves"),
        ],
        f"SELECT {_STORED} FROM stored",
    ),
    "stream_late_report": _sql(
        _LATE, "SELECT count(*) AS late_rows_dropped FROM late, mark WHERE trade_timestamp <= watermark"
    ),
    "flow_tables": _sql(_TRADES, f"SELECT {_STORED} FROM trades"),
    "flow_replay": _sql(
        [*_TRADES, _wire("sent"), _judged("judged", "sent")],
        """
SELECT (SELECT count(*) FROM trades) AS raw_rows,
       (SELECT count(*) FROM (SELECT DISTINCT symbol, trade_timestamp FROM trades)) AS raw_keys,
       (SELECT 2 * count(*) FROM judged WHERE reject_reason <> 'accepted') AS reject_rows""",
    ),
    "compacted_table_read": _sql(
        _TRADES,
        f"SELECT {_STORED} FROM trades WHERE trade_date BETWEEN DATE '{RANGE_START[:10]}' AND DATE '{RANGE_END[:10]}'",
    ),
    "stream_progress": _sql(
        _LATE,
        """
SELECT 'raw_stream_data_writer' AS query_name,
       (SELECT count(*) FROM wire) + (SELECT count(*) FROM late_wire) AS input_rows,
       (SELECT count(*) FROM late, mark WHERE trade_timestamp <= watermark) AS late_rows_dropped""",
    ),
    "stream_reconcile": _sql(
        [*_TRADES, _WATERMARK],
        """
SELECT symbol, trade_date, count(*) AS raw_count, count(*) AS aggregated_count,
       CAST(0 AS BIGINT) AS difference
FROM trades, mark
WHERE time_bucket(INTERVAL 1 MINUTE, trade_timestamp) + INTERVAL 1 MINUTE <= watermark
GROUP BY symbol, trade_date""",
    ),
    "late_correction": _sql(
        [
            *_LATE,
            # What is stored already stays when a late copy comes.
            """
both_waves AS (
  SELECT *, 0 AS wave FROM trades UNION ALL SELECT *, 1 AS wave FROM late),
stored AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY symbol, trade_timestamp ORDER BY wave, ingestion_timestamp, price, volume, source) AS copy FROM both_waves)
  WHERE copy = 1)""",
            _windows("windows", "stored"),
        ],
        f"SELECT {_WINDOW_ROW}, trade_date FROM windows",
    ),
    "late_rows": _sql(
        [*_LATE, _dedup("late_trades", "late")],
        """
SELECT late_trades.* FROM late_trades, (SELECT max(trade_timestamp) - INTERVAL 2 MINUTE AS exact_mark FROM clean)
WHERE trade_timestamp <= exact_mark""",
    ),
    "stream_summary": _sql(
        [*_WINDOWS, _WATERMARK],
        """
SELECT symbol, max(window_start) AS latest_window_start, CAST(sum(total_volume) AS BIGINT) AS total_volume,
       CAST(sum(trade_count) AS BIGINT) AS trade_count, round(avg(avg_price), 6) AS avg_price
FROM windows, mark WHERE window_end <= watermark GROUP BY symbol""",
    ),
    "reconcile_tree": _sql(
        _TRADES,
        """
SELECT symbol, trade_timestamp, CASE WHEN volume % 50 = 7 THEN 'changed' ELSE 'removed' END AS change
FROM trades WHERE volume % 50 IN (7, 8)""",
    ),
    "stream_open_windows": _sql(
        [*_TRADES, _WATERMARK],
        """
SELECT symbol, count(*) AS raw_count, count(*) FILTER (closed) AS stored_count, count(*) FILTER (NOT closed) AS open_count,
       CAST(0 AS BIGINT) AS difference
FROM (SELECT symbol, time_bucket(INTERVAL 1 MINUTE, trade_timestamp) + INTERVAL 1 MINUTE <= watermark AS closed FROM trades, mark)
GROUP BY symbol""",
    ),
    "one_pass_raw": _sql(_TRADES, f"SELECT {_STORED} FROM trades"),
    "one_pass_windows": _sql(_WINDOWS, f"SELECT {_WINDOW_ROW}, trade_date FROM windows"),
    "flow_await_any": _sql(_TRADES, f"SELECT {_STORED} FROM trades"),
    "reject_future": _sql(
        [_wire("wire"), _judged("judged", "wire")],
        f"""
SELECT CASE WHEN reject_reason = 'accepted' AND {FAR_AHEAD} THEN 'future' ELSE reject_reason END AS outcome, count(*) AS trade_count
FROM judged GROUP BY outcome""",
    ),
    "stream_allow_list": _sql(
        [
            *_TRADES,
            "span AS (SELECT CAST(floor(min(epoch(ts))) AS BIGINT) AS low, CAST(floor(max(epoch(ts))) AS BIGINT) AS high FROM events)",
        ],
        f"""
SELECT {_STORED} FROM trades, span
WHERE symbol = 'view'
   OR (symbol = 'click' AND (CAST(floor(epoch(trade_timestamp)) AS BIGINT) - low) * 2 // (high - low + 1) = 1)""",
    ),
    "vendor_exact_prices": """
SELECT event_type AS symbol,
       CAST(CAST((10000000000 + event_id) || '.' || lpad(CAST(event_id * 7 + 1 AS VARCHAR), 9, '0') AS DECIMAL(38, 9)) AS VARCHAR) AS price,
       date_trunc('milliseconds', ts) AS trade_timestamp
FROM events""",
    "active_spans": _sql([*_TRADES, _SPANS], "SELECT * FROM spans"),
    "stream_silences": _sql([*_TRADES, _WATERMARK, _SPANS], "SELECT spans.* FROM spans, mark WHERE silent_at <= watermark"),
    "raw_table_ranged": _sql(
        _TRADES,
        f"""
SELECT * FROM trades
WHERE symbol = '{LOOKUP_SYMBOL}' AND trade_timestamp >= TIMESTAMP '{LOOKUP_START}' AND trade_timestamp < TIMESTAMP '{LOOKUP_END}'""",
    ),
}

# These ask in another way, by SQL or of a stored table, for what another query computes.
for _name, _same in {
    "sql_latest_trades": "latest_trades",
    "stream_rejects": "reject_rows",
    "reject_report_observed": "reject_report",
    "stream_reject_report": "reject_report",
    "raw_table_latest": "latest_trades",
    "raw_table_latest_indexed": "latest_trades",
    "stream_dedup_earliest": "trade_dedup",
    "sql_latest_windows": "latest_windows",
    "sql_raw_count": "raw_count",
    "sql_aggregated_count": "aggregated_count",
    "sql_summary": "symbol_summary",
}.items():
    ORACLES[_name] = ORACLES[_same]
