"""The query catalogue: every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampType

from tickloom.config import TradeFlow
from tickloom.operators import (
    activity_heatmap,
    aggregate_windows,
    allow_symbols,
    avg_price_series,
    classify,
    clean_and_deduplicate,
    clean_trades,
    freshness_report,
    latest_stored,
    latest_trades,
    latest_windows,
    price_range_series,
    price_series,
    reconcile,
    register_views,
    reject_counts,
    rejected_input,
    row_count,
    symbol_summary,
    total_trades,
    volume_by_symbol,
)
from tickloom.plans.event_feed import (
    SOURCE,
    read_events,
    stream_events,
    vendor_messages,
    wire_messages,
)
from tickloom.plans.trade_flow import (
    bootstrap,
    ingest,
    run_trade_flow,
    start_aggregated,
    start_raw,
    start_rejects,
    window_metrics,
)
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT, REJECT_SCHEMA
from tickloom.session import prepare_session, scratch_dir
from tickloom.sources import (
    decode_wire,
    explode_messages,
    malformed_messages,
    read_table,
    read_wire_files,
    time_range,
)
from tickloom.streaming import (
    ProgressLog,
    append_batch,
    compact,
    late_rows_dropped,
    progress_report,
    query_totals,
    start_batch_stream,
    trade_messages,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Late wave of the late-data queries: the whole feed once more, six hours later.
LATE_SHIFT_SECONDS = 6 * 3600
# The span that the range reads ask for.
RANGE_START, RANGE_END = "2024-01-10T06:00:00", "2024-01-17T18:30:00"
SUBSCRIBED = ["view", "click"]


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone and rounded averages, as another engine prints them."""
    columns = []
    for field in df.schema:
        if isinstance(field.dataType, TimestampType):
            columns.append(f"cast({field.name} AS timestamp_ntz) AS {field.name}")
        elif field.name == "avg_price":
            columns.append("round(avg_price, 6) AS avg_price")
        else:
            columns.append(field.name)
    return df.selectExpr(*columns)


# --- inputs ---------------------------------------------------------------------------


def wire(spark: SparkSession, folder: str) -> DataFrame:
    return decode_wire(wire_messages(read_events(spark, folder)))


def wire_with_messages(spark: SparkSession, folder: str) -> DataFrame:
    return decode_wire(wire_messages(read_events(spark, folder)), keep_message=True)


def wire_stream(spark: SparkSession, folder: str) -> DataFrame:
    return decode_wire(wire_messages(stream_events(spark, folder)), keep_message=True)


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return clean_and_deduplicate(wire(spark, folder))


def windows(spark: SparkSession, folder: str) -> DataFrame:
    return window_metrics(wire(spark, folder))


def stored_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table, written under the scratch folder and read back."""
    path = scratch_dir(spark, "raw")
    write_table(trades(spark, folder), path, RAW_LAYOUT)
    return read_table(spark, path, RAW_LAYOUT)


def stored_windows(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """The aggregate of a stored raw table, written and read back."""
    path = scratch_dir(spark, "aggregated")
    write_table(aggregate_windows(raw), path, AGGREGATED_LAYOUT)
    return read_table(spark, path, AGGREGATED_LAYOUT)


# --- decoding, quality, cleaning ------------------------------------------------------


def wire_decode(spark, folder):
    return wire(spark, folder)


def trade_clean(spark, folder):
    return clean_trades(wire(spark, folder))


def trade_clean_literal(spark, folder):
    return clean_trades(wire(spark, folder), keep_null_event_time=True)


def trade_dedup(spark, folder):
    return trades(spark, folder)


def trade_dedup_literal(spark, folder):
    return clean_and_deduplicate(wire(spark, folder), keep_null_event_time=True)


def reject_report(spark, folder):
    return reject_counts(classify(wire_with_messages(spark, folder)))


def reject_rows(spark, folder):
    return rejected_input(classify(wire_with_messages(spark, folder), keep_input=True))


def symbol_allow_list(spark, folder):
    return allow_symbols(clean_trades(wire(spark, folder)), SUBSCRIBED)


# --- aggregates and serving -----------------------------------------------------------


def trade_agg_1m(spark, folder):
    return windows(spark, folder)


def trade_agg_5m(spark, folder):
    return window_metrics(wire(spark, folder), width="5 minutes")


def symbol_summary_latest(spark, folder):
    return symbol_summary(windows(spark, folder))


def latest_trade_rows(spark, folder):
    return latest_trades(trades(spark, folder))


def latest_window_rows(spark, folder):
    return latest_windows(windows(spark, folder))


def raw_count(spark, folder):
    return row_count(trades(spark, folder), "raw_count")


def aggregated_count(spark, folder):
    return row_count(windows(spark, folder), "aggregated_count")


def chart_price_series(spark, folder):
    return price_series(trades(spark, folder))


def chart_price_range(spark, folder):
    return price_range_series(trades(spark, folder), RANGE_START, RANGE_END, SUBSCRIBED, "1 hour")


def chart_avg_price(spark, folder):
    return avg_price_series(windows(spark, folder))


def chart_volume_by_symbol(spark, folder):
    return volume_by_symbol(windows(spark, folder))


def chart_total_trades(spark, folder):
    return total_trades(windows(spark, folder))


def heatmap(spark, folder):
    return activity_heatmap(trades(spark, folder))


# The statements of a SQL client, on the tables' own names. The second sort key settles ties.
SQL = {
    "sql_latest_trades": "SELECT * FROM raw_stream_data ORDER BY trade_timestamp DESC, symbol LIMIT 20",
    "sql_latest_windows": """
        SELECT symbol, window_start, window_end, avg_price, min_price, max_price, total_volume, trade_count
        FROM aggregated_data ORDER BY window_start DESC, symbol LIMIT 50""",
    "sql_raw_count": "SELECT count(*) AS raw_count FROM raw_stream_data",
    "sql_aggregated_count": "SELECT count(*) AS aggregated_count FROM aggregated_data",
    "sql_summary": "SELECT * FROM stock_summary_latest",
}


def sql_query(statement: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        register_views(trades(spark, folder), windows(spark, folder))
        return spark.sql(statement)

    return run


# --- vendor messages and publishing ---------------------------------------------------


def vendor_explode(spark, folder):
    rows = explode_messages(vendor_messages(read_events(spark, folder)), SOURCE)
    return rows.withColumn("price", F.col("price").cast("double")).drop("ingestion_timestamp")


def vendor_malformed(spark, folder):
    return malformed_messages(vendor_messages(read_events(spark, folder))).select("event_id")


def vendor_ingest(spark, folder):
    good, _, _ = ingest(vendor_messages(read_events(spark, folder)), SOURCE, SUBSCRIBED)
    return clean_trades(decode_wire(trade_messages(good))).drop("ingestion_timestamp")


def vendor_rejects(spark, folder):
    """Items that a rule rejects, with their text; the list of symbols does not hide them."""
    _, bad, _ = ingest(vendor_messages(read_events(spark, folder)), SOURCE, SUBSCRIBED)
    return bad.drop("ingestion_timestamp", "source")


def kafka_payload(spark, folder):
    messages = trade_messages(trades(spark, folder))
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))


# --- stored tables and checks ---------------------------------------------------------


def raw_table_roundtrip(spark, folder):
    return stored_raw(spark, folder)


def raw_table_pruned_read(spark, folder):
    return allow_symbols(time_range(stored_raw(spark, folder), RANGE_START, RANGE_END), SUBSCRIBED)


def raw_table_latest(spark, folder):
    return latest_stored(stored_raw(spark, folder), 20, "trade_timestamp")


def aggregated_table_range(spark, folder):
    stored = stored_windows(spark, trades(spark, folder))
    return time_range(stored, RANGE_START, RANGE_END, time_column="window_start")


def idempotent_append(spark, folder):
    """A batch applied twice, a batch of the same number by another query, and one without rows."""
    target = scratch_dir(spark, "append")
    rows = trades(spark, folder).persist()
    try:
        ours, theirs = rows.where("volume % 2 = 0"), rows.where("volume % 2 <> 0")
        for query_id, batch_id, batch in (("a", 0, ours), ("a", 0, ours), ("b", 0, theirs), ("b", 1, rows.limit(0))):
            append_batch(batch, batch_id, target, RAW_LAYOUT, query_id)
    finally:
        rows.unpersist()
    return read_table(spark, target, RAW_LAYOUT)


def freshness(spark, folder):
    return freshness_report(trades(spark, folder))


def reconcile_raw_agg(spark, folder):
    raw = stored_raw(spark, folder)
    return reconcile(raw, stored_windows(spark, raw))


# --- streams --------------------------------------------------------------------------


def _flow(root: str) -> TradeFlow:
    return TradeFlow(checkpoint_root=f"{root}/checkpoints", trigger={"availableNow": True})


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def _stored(df: DataFrame) -> DataFrame:
    # Which of two copies a stream saw first is not fixed, so their arrival is left out.
    return df.drop("ingestion_timestamp")


def stream_raw(spark, folder):
    root = scratch_dir(spark, "stream-raw")
    _finish(start_raw(wire_stream(spark, folder), f"{root}/raw", _flow(root)))
    return _stored(read_table(spark, f"{root}/raw", RAW_LAYOUT))


def stream_rejects(spark, folder):
    root = scratch_dir(spark, "stream-rejects")
    _finish(start_rejects(wire_stream(spark, folder), f"{root}/rejects", _flow(root)))
    return spark.read.schema(REJECT_SCHEMA).parquet(f"{root}/rejects")


def stream_agg_1m(spark, folder):
    root = scratch_dir(spark, "stream-agg")
    _finish(start_aggregated(wire_stream(spark, folder), f"{root}/aggregated", _flow(root)))
    return read_table(spark, f"{root}/aggregated", AGGREGATED_LAYOUT)


def stream_batch_append(spark, folder):
    root = scratch_dir(spark, "stream-batches")
    rows = clean_and_deduplicate(wire_stream(spark, folder))
    once = {"availableNow": True}
    _finish(start_batch_stream(rows, f"{root}/raw", RAW_LAYOUT, f"{root}/checkpoint", "raw_batches", once))
    return _stored(read_table(spark, f"{root}/raw", RAW_LAYOUT))


def stream_restart(spark, folder):
    """Half of the feed, a restart with the other half, and one with nothing new."""
    root = scratch_dir(spark, "stream-restart")
    events = read_events(spark, folder)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    middle = events.agg(((F.min(seconds) + F.max(seconds)) / 2).cast("bigint")).first()[0]
    for wave in (events.where(seconds < middle), events.where(seconds >= middle), None):
        if wave is not None:
            _send(wire_messages(wave), f"{root}/feed")
        _finish(start_aggregated(read_wire_files(spark, f"{root}/feed"), f"{root}/aggregated", _flow(root)))
    return read_table(spark, f"{root}/aggregated", AGGREGATED_LAYOUT)


def _run_flow(spark: SparkSession, folder: str, runs: int) -> list[str]:
    """The whole flow into catalog tables, in three waves of rising time; ``runs`` times, each with new checkpoints.

    Both table queries and the dead letters are live at once. Returns the names of the three tables.
    """
    root = scratch_dir(spark, "flow")
    namespace = f"flow_{root.rsplit('-', 1)[1]}"
    raw, aggregated = bootstrap(spark, namespace, provider="parquet")
    rejects = f"{namespace}.rejects"
    events = read_events(spark, folder)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(seconds), F.max(seconds)).first()
    wave = F.floor((seconds - low) * 3 / (high - low + 1))
    for number in range(3):
        _send(wire_messages(events.where(wave == number)), f"{root}/feed")
        for run in range(runs if number == 2 else 1):
            flow = TradeFlow(checkpoint_root=f"{root}/checkpoints{run}", trigger={"availableNow": True})
            for query in run_trade_flow(read_wire_files(spark, f"{root}/feed"), raw, aggregated, flow, rejects):
                _finish(query)
    return [raw, aggregated, rejects]


def flow_tables(spark, folder):
    raw, _, _ = _run_flow(spark, folder, runs=1)
    return _stored(read_table(spark, raw, RAW_LAYOUT))


def flow_replay(spark, folder):
    """After a lost checkpoint all is read again: tables with keys do not grow, dead letters come a second time."""
    raw, _, rejects = _run_flow(spark, folder, runs=2)
    rows = read_table(spark, raw, RAW_LAYOUT)
    keys = rows.select("symbol", "trade_timestamp", F.lit(1).alias("raw"), F.lit(0).alias("reject"))
    nothing = F.lit(None)
    letters = spark.table(rejects).select(
        nothing.cast("string").alias("symbol"), nothing.cast("timestamp").alias("trade_timestamp"), F.lit(0).alias("raw"), F.lit(1).alias("reject")
    )
    return keys.unionByName(letters).agg(
        F.sum("raw").alias("raw_rows"),
        F.count_distinct("symbol", "trade_timestamp").alias("raw_keys"),
        F.sum("reject").alias("reject_rows"),
    )


def compacted_table_read(spark, folder):
    """A streamed table, its closed dates rewritten, and these read."""
    root = scratch_dir(spark, "compact")
    _finish(start_raw(wire_stream(spark, folder), f"{root}/raw", _flow(root)))
    stored = read_table(spark, f"{root}/raw", RAW_LAYOUT)
    for _ in range(2):
        compact(stored, f"{root}/closed", RAW_LAYOUT, RANGE_START[:10], RANGE_END[:10])
    return _stored(read_table(spark, f"{root}/closed", RAW_LAYOUT))


def _send(messages: DataFrame, path: str) -> None:
    messages.select(F.col("value").cast("string")).write.mode("append").text(path)


def _run_late_wave(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """The whole feed, then all of it again with shifted times, most of them behind the watermark.

    Returns where the rows are, and the progress log of both runs.
    """
    root = scratch_dir(spark, "stream-late")
    events = read_events(spark, folder)
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        for shift in (0, LATE_SHIFT_SECONDS):
            _send(wire_messages(events, shift), f"{root}/feed")
            log.wait_for(_finish(start_raw(read_wire_files(spark, f"{root}/feed"), f"{root}/raw", _flow(root))))
    finally:
        spark.streams.removeListener(log)
    return f"{root}/raw", progress_report(spark, f"{root}/progress")


def stream_late_data(spark, folder):
    path, _ = _run_late_wave(spark, folder)
    return _stored(read_table(spark, path, RAW_LAYOUT))


def stream_late_report(spark, folder):
    _, progress = _run_late_wave(spark, folder)
    return late_rows_dropped(progress)


def stream_progress(spark, folder):
    """What the late-data run reports per query: input and late rows of all batches."""
    _, progress = _run_late_wave(spark, folder)
    return query_totals(progress).drop("state_rows")


def stream_reconcile(spark, folder):
    """Both streams on one feed; the windows still open are left out of the comparison."""
    root = scratch_dir(spark, "stream-both")
    flow = _flow(root)
    _finish(start_raw(wire_stream(spark, folder), f"{root}/raw", flow))
    _finish(start_aggregated(wire_stream(spark, folder), f"{root}/aggregated", flow))
    raw = read_table(spark, f"{root}/raw", RAW_LAYOUT)
    aggregated = read_table(spark, f"{root}/aggregated", AGGREGATED_LAYOUT)
    newest = raw.agg(F.max("trade_timestamp").cast("string")).first()[0]
    watermark = F.lit(newest).cast("timestamp") - F.expr(f"interval {flow.watermark_delay}")
    return reconcile(raw, aggregated, closed_before=watermark)


QUERIES: dict[str, Query] = {
    "wire_decode": wire_decode,
    "trade_clean": trade_clean,
    "trade_clean_literal": trade_clean_literal,
    "trade_dedup": trade_dedup,
    "trade_dedup_literal": trade_dedup_literal,
    "trade_agg_1m": trade_agg_1m,
    "trade_agg_5m": trade_agg_5m,
    "symbol_summary": symbol_summary_latest,
    "latest_trades": latest_trade_rows,
    "latest_windows": latest_window_rows,
    "raw_count": raw_count,
    "aggregated_count": aggregated_count,
    "chart_price_series": chart_price_series,
    "chart_price_range": chart_price_range,
    "chart_avg_price": chart_avg_price,
    "chart_volume_by_symbol": chart_volume_by_symbol,
    "chart_total_trades": chart_total_trades,
    "activity_heatmap": heatmap,
    "vendor_explode": vendor_explode,
    "vendor_malformed": vendor_malformed,
    "vendor_ingest": vendor_ingest,
    "vendor_rejects": vendor_rejects,
    "reject_report": reject_report,
    "reject_rows": reject_rows,
    "symbol_allow_list": symbol_allow_list,
    "kafka_payload": kafka_payload,
    "raw_table_roundtrip": raw_table_roundtrip,
    "raw_table_pruned_read": raw_table_pruned_read,
    "raw_table_latest": raw_table_latest,
    "idempotent_append": idempotent_append,
    "freshness_report": freshness,
    "aggregated_table_range": aggregated_table_range,
    "reconcile_raw_agg": reconcile_raw_agg,
    "stream_raw": stream_raw,
    "stream_rejects": stream_rejects,
    "stream_agg_1m": stream_agg_1m,
    "stream_batch_append": stream_batch_append,
    "stream_restart": stream_restart,
    "stream_late_data": stream_late_data,
    "stream_late_report": stream_late_report,
    "stream_progress": stream_progress,
    "flow_tables": flow_tables,
    "flow_replay": flow_replay,
    "compacted_table_read": compacted_table_read,
    "stream_reconcile": stream_reconcile,
    **{name: sql_query(statement) for name, statement in SQL.items()},
}
