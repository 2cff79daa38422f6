"""Queries on what keeps the tables right over time: copies out of order, late trades, failures, summaries, state, indexes."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.config import AGGREGATED_TABLE, OUTCOMES, TradeFlow
from tickloom.functions import message_value, to_event_time, to_exact_decimal
from tickloom.operators import (
    active_spans,
    classify,
    clean_and_deduplicate,
    differing_rows,
    leaves,
    observe_outcomes,
    observed_counts,
    reject_counts,
    rejected_input,
    tree_differences,
)
from tickloom.plans.event_feed import COPIED, SOURCE, long_price_messages, read_events, wire_messages
from tickloom.plans.queries import (
    LATE_SHIFT_SECONDS,
    Query,
    _finish,
    _flow,
    _send,
    _stored,
    stored_raw,
    trades,
    wire_stream,
    wire_with_messages,
)
from tickloom.plans.trade_flow import (
    await_all,
    await_any,
    ingest,
    run_trade_flow,
    start_aggregated,
    start_raw,
    start_rejects,
    window_metrics,
)
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT
from tickloom.session import children, remove_folder, scratch_dir
from tickloom.sources import decode_wire, read_table, read_wire_files
from tickloom.streaming import (
    OnePassTables,
    OutcomeLog,
    account,
    apply_late,
    arrange,
    latest_indexed,
    open_windows,
    outcome_report,
    publish_list,
    publish_windows,
    read_span,
    read_summary,
    start_allowed,
    start_one_pass,
    start_silences,
    start_summary,
    symbols_of,
    trade_messages,
    write_indexed,
    write_ranged,
)
from tickloom.streaming.silence import SPAN_SCHEMA
from tickloom.streaming.tables import checkpoint_identity

# A pause after which a symbol counts as silent, and what the look-up in the ranged table asks for.
SILENT_AFTER = "90 minutes"
LOOKUP_SYMBOL, LOOKUP_START, LOOKUP_END = "click", "2024-01-12T00:00:00", "2024-01-12T12:00:00"
RANGED_FILES = 16
# Files that a wave of messages is sent in, and that a micro-batch takes: these at least, and
# as many as there are cores if each file of the copies then has this many messages.
WAVE_FILES, FILE_MESSAGES = 4, 1000
# Slices of the feed's time, and a delay that is longer than one of them.
SLICES, SLICE_DELAY = 5, timedelta(days=7)


def _slices(events: DataFrame, count: int) -> list[DataFrame]:
    """The events by stretches of time."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(seconds), F.max(seconds)).first()
    return [events.where(F.floor((seconds - low) * count / (high - low + 1)) == number) for number in range(count)]


def stream_dedup_earliest(spark: SparkSession, folder: str) -> DataFrame:
    """Copies come before what they are copies of, a micro-batch apart; the stream keeps the earliest arrival all the same.

    A last message behind the end of the feed closes it, so that no trade is left in the state.
    """
    root = scratch_dir(spark, "stream-earliest")
    events = read_events(spark, folder)
    newest, copies = events.agg(F.max("ts").cast("timestamp"), F.count_if(F.expr(COPIED))).first()
    files = max(WAVE_FILES, min(spark.sparkContext.defaultParallelism, copies // (SLICES * FILE_MESSAGES)))
    for part in _slices(events, SLICES):
        for replay in (1, 0):
            # Events are dealt to files; their messages are larger and need no exchange.
            _send(wire_messages(part.repartition(files, "event_id"), replay=replay), f"{root}/feed")
    end = newest + SLICE_DELAY + timedelta(seconds=1)
    time = F.lit(end.isoformat() + "+00:00")
    last = message_value(symbol=F.lit("end"), price=F.lit("1"), volume=F.lit("0"), trade_timestamp=time, ingestion_timestamp=time, source=F.lit("end"))
    _send(spark.range(1).select(last.alias("value")), f"{root}/feed")
    flow = TradeFlow(f"{root}/checkpoints", f"{SLICE_DELAY.days} days", earliest_copy=True, trigger={"availableNow": True})
    _finish(start_raw(read_wire_files(spark, f"{root}/feed", files), f"{root}/raw", flow))
    return read_table(spark, f"{root}/raw", RAW_LAYOUT)


def _one_pass_waves(spark: SparkSession, folder: str) -> tuple[OnePassTables, TradeFlow]:
    """The feed, then all of it again with shifted times, most of them behind the watermark."""
    root = scratch_dir(spark, "one-pass-late")
    tables, flow = OnePassTables(f"{root}/tables"), _flow(root)
    for shift in (0, LATE_SHIFT_SECONDS):
        _send(wire_messages(read_events(spark, folder), shift), f"{root}/feed")
        _finish(start_one_pass(read_wire_files(spark, f"{root}/feed"), tables, flow))
    return tables, flow


def late_correction(spark: SparkSession, folder: str) -> DataFrame:
    """The published aggregate table after late trades were applied and their dates replaced, twice."""
    tables, flow = _one_pass_waves(spark, folder)
    path = scratch_dir(spark, "published")
    publish_windows(spark, tables, path)
    for _ in range(2):
        publish_windows(spark, tables, path, apply_late(spark, tables, flow))
    return read_table(spark, path, AGGREGATED_LAYOUT)


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The side table of late trades."""
    tables, _ = _one_pass_waves(spark, folder)
    return tables.late(spark).drop("part")


class _Broken(Exception):
    """The failure that the query below brings about."""


def _one_pass_with_failures(spark: SparkSession, folder: str) -> OnePassTables:
    """Three waves; during the second the query fails behind the raw table, and once more behind the windows."""
    root = scratch_dir(spark, "one-pass")
    tables, flow = OnePassTables(f"{root}/tables"), _flow(root)
    failures = ["raw", "partials"]
    for number, part in enumerate(_slices(read_events(spark, folder), 3)):
        _send(wire_messages(part), f"{root}/feed")

        def fail(sink: str, batch_id: int, number: int = number) -> None:
            if number == 1 and failures and sink == failures[0]:
                raise _Broken(failures.pop(0))

        for attempt in range(3):
            query = start_one_pass(read_wire_files(spark, f"{root}/feed"), tables, flow, fail)
            try:
                _finish(query)
                break
            except Exception as error:
                if "_Broken" not in str(error) or attempt == 2:
                    raise
                spark.streams.resetTerminated()  # the failure was meant
    return tables


def one_pass_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(_one_pass_with_failures(spark, folder).raw(spark))


def one_pass_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The windows of the same pass; the open ones are among them, as partials need not wait."""
    return _one_pass_with_failures(spark, folder).windows(spark)


def stream_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary after three waves of windows; the last batch of the second wave is run twice."""
    root = scratch_dir(spark, "stream-summary")
    checkpoint = f"{root}/checkpoint"
    for number, part in enumerate(_slices(read_events(spark, folder), 3)):
        _send(wire_messages(part), f"{root}/feed")
        for _ in range(2 if number == 1 else 1):
            windows = window_metrics(read_wire_files(spark, f"{root}/feed"))
            _finish(start_summary(windows, f"{root}/summary", checkpoint, trigger={"availableNow": True}))
            if number == 1:
                forget_commit(spark, checkpoint)
    return read_summary(spark, f"{root}/summary", checkpoint_identity(spark, checkpoint))


def forget_commit(spark: SparkSession, checkpoint: str) -> None:
    """What a driver that dies before its last commit leaves behind: the batch is planned, not committed."""
    last = max((name for name in children(spark, f"{checkpoint}/commits") if name.isdigit()), key=int)
    remove_folder(spark, f"{checkpoint}/commits/{last}")


def reconcile_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table against itself with changed prices, where all counts stay equal, and with trades left out."""
    raw = stored_raw(spark, folder)
    other = raw.where("volume % 50 <> 8").withColumn("price", F.expr("if(volume % 50 = 7, price + 1, price)"))
    columns = ["symbol", "price", "volume", "trade_timestamp", "source"]
    trees = []
    for table in (raw, other):
        path = scratch_dir(spark, "tree")
        leaves(table, columns).write.parquet(path)
        trees.append(spark.read.parquet(path))
    path = scratch_dir(spark, "unequal")
    tree_differences(*trees).write.parquet(path)
    return differing_rows(raw, other, spark.read.parquet(path), RAW_LAYOUT.keys, columns)


def stream_open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Per symbol: every trade of the raw table is in a stored window or in one that the stopped query holds."""
    root = scratch_dir(spark, "stream-open")
    flow = _flow(root)
    _finish(start_raw(wire_stream(spark, folder), f"{root}/raw", flow))
    _finish(start_aggregated(wire_stream(spark, folder), f"{root}/aggregated", flow))
    raw = read_table(spark, f"{root}/raw", RAW_LAYOUT)
    stored = read_table(spark, f"{root}/aggregated", AGGREGATED_LAYOUT)
    return account(raw, stored, open_windows(spark, flow.checkpoint(AGGREGATED_TABLE)))


def raw_table_latest_indexed(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "indexed")
    write_indexed(arrange(trades(spark, folder), RAW_LAYOUT), f"{path}/raw", f"{path}/files", RAW_LAYOUT)
    return latest_indexed(spark, f"{path}/raw", f"{path}/files", 20, RAW_LAYOUT)


def flow_await_any(spark: SparkSession, folder: str) -> DataFrame:
    """Both tables' queries: when one ends the other is stopped, wherever it is; a second start finishes the work."""
    root = scratch_dir(spark, "flow-any")
    targets = f"{root}/raw", f"{root}/aggregated"
    await_any(spark, run_trade_flow(wire_stream(spark, folder), *targets, _flow(root)))
    await_all(run_trade_flow(wire_stream(spark, folder), *targets, _flow(root)))
    return _stored(read_table(spark, targets[0], RAW_LAYOUT))


# --- rejects, symbols, prices ---------------------------------------------------------


def reject_report_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The outcomes counted while the rejected rows are written: the messages are read once."""
    observation = Observation(OUTCOMES)
    counted = observe_outcomes(classify(wire_with_messages(spark, folder), keep_input=True), observation)
    rejected_input(counted).write.parquet(scratch_dir(spark, "observed"))
    return observed_counts(spark, observation.get)


def stream_reject_report(spark: SparkSession, folder: str) -> DataFrame:
    """The same of a stream that writes its dead letters, over two waves, from its progress."""
    root = scratch_dir(spark, "stream-outcomes")
    log = OutcomeLog(spark, f"{root}/outcomes")
    spark.streams.addListener(log)
    try:
        for part in _slices(read_events(spark, folder), 2):
            _send(wire_messages(part), f"{root}/feed")
            log.wait_for(_finish(start_rejects(read_wire_files(spark, f"{root}/feed"), f"{root}/rejects", _flow(root))))
    finally:
        spark.streams.removeListener(log)
    return outcome_report(spark, f"{root}/outcomes")


# Which trades get a time in the year 9999, and how far ahead of its arrival a trade may be.
FAR_AHEAD, MAX_AHEAD = "symbol = 'view' AND price LIKE '%7'", "1 hour"


def reject_future(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes where some trades are dated in the year 9999."""
    far = F.expr(f"if({FAR_AHEAD} AND trade_timestamp LIKE '2024-%', concat('9999', substr(trade_timestamp, 5)), trade_timestamp)")
    dated = wire_with_messages(spark, folder).withColumn("trade_timestamp", far)
    return reject_counts(classify(dated, max_ahead=MAX_AHEAD))


def stream_allow_list(spark: SparkSession, folder: str) -> DataFrame:
    """A symbol that joins the list between two batches is let through from the second on."""
    root = scratch_dir(spark, "stream-list")
    for part, symbols in zip(_slices(read_events(spark, folder), 2), (" view, ", "click,view,"), strict=True):
        publish_list(symbols_of(spark.createDataFrame([(symbols,)], "symbols string")), f"{root}/list")
        _send(wire_messages(part), f"{root}/feed")
        rows = clean_and_deduplicate(read_wire_files(spark, f"{root}/feed"))
        once = {"availableNow": True}
        _finish(start_allowed(rows, f"{root}/list", f"{root}/raw", RAW_LAYOUT, f"{root}/checkpoint", "allowed", once))
    return _stored(read_table(spark, f"{root}/raw", RAW_LAYOUT))


def vendor_exact_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of twenty digits, from the vendor's message to the published one and back."""
    good, _, _ = ingest(long_price_messages(read_events(spark, folder)), SOURCE, exact=True)
    back = decode_wire(trade_messages(good))
    exact = to_exact_decimal(F.col("price")).cast("decimal(38,9)").cast("string")
    return back.select("symbol", exact.alias("price"), to_event_time(F.col("trade_timestamp")).alias("trade_timestamp"))


# --- silence, ranges ------------------------------------------------------------------


def active_spans_batch(spark: SparkSession, folder: str) -> DataFrame:
    return active_spans(trades(spark, folder), SILENT_AFTER)


def stream_silences(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches that ended before the watermark, each told once over two waves."""
    root = scratch_dir(spark, "stream-silences")
    for part in _slices(read_events(spark, folder), 2):
        _send(wire_messages(part), f"{root}/feed")
        _finish(start_silences(read_wire_files(spark, f"{root}/feed"), f"{root}/spans", _flow(root), SILENT_AFTER))
    return spark.read.schema(SPAN_SCHEMA).parquet(f"{root}/spans")


def raw_table_ranged(spark: SparkSession, folder: str) -> DataFrame:
    """A symbol and an hour of a table that is laid out by ranges."""
    path = scratch_dir(spark, "ranged")
    write_ranged(trades(spark, folder), f"{path}/raw", f"{path}/files", RAW_LAYOUT, RANGED_FILES)
    return read_span(spark, f"{path}/raw", f"{path}/files", LOOKUP_SYMBOL, LOOKUP_START, LOOKUP_END, RAW_LAYOUT)


QUERIES: dict[str, Query] = {
    "stream_dedup_earliest": stream_dedup_earliest,
    "late_correction": late_correction,
    "late_rows": late_rows,
    "stream_summary": stream_summary,
    "reconcile_tree": reconcile_tree,
    "stream_open_windows": stream_open_windows,
    "one_pass_raw": one_pass_raw,
    "one_pass_windows": one_pass_windows,
    "raw_table_latest_indexed": raw_table_latest_indexed,
    "flow_await_any": flow_await_any,
    "reject_report_observed": reject_report_observed,
    "stream_reject_report": stream_reject_report,
    "reject_future": reject_future,
    "stream_allow_list": stream_allow_list,
    "vendor_exact_prices": vendor_exact_prices,
    "active_spans": active_spans_batch,
    "stream_silences": stream_silences,
    "raw_table_ranged": raw_table_ranged,
}
