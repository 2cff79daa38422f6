"""The flows: stored tables from a trade stream, and a trade stream from vendor messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import (
    AGGREGATED_QUERY,
    AGGREGATED_TABLE,
    OUTCOMES,
    RAW_QUERY,
    RAW_TABLE,
    REJECT_QUERY,
    REJECT_TABLE,
    SERVING_AGGREGATED_QUERY,
    SERVING_AGGREGATED_TABLE,
    SERVING_RAW_QUERY,
    SERVING_RAW_TABLE,
    WATERMARK_DELAY,
    WINDOW_WIDTH,
    JdbcTarget,
    KafkaSink,
    TradeFlow,
)
from tickloom.functions import epoch_millis_to_time
from tickloom.operators import (
    aggregate_windows,
    allow_symbols,
    classify,
    clean_and_deduplicate,
    observe_outcomes,
    rejected_input,
)
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT
from tickloom.sources import explode_items, malformed_messages
from tickloom.sources.tables import is_path
from tickloom.streaming import (
    ensure_namespace,
    ensure_table,
    reject_messages,
    start_jdbc_stream,
    start_publishing,
    start_table_stream,
    trade_messages,
)
from tickloom.streaming.tables import stream_writer


def window_metrics(
    wire: DataFrame,
    width: str = WINDOW_WIDTH,
    watermark_delay: str = WATERMARK_DELAY,
    keep_null_event_time: bool = False,
    copy_fanout: int = 1,
    earliest: bool = False,
    max_ahead: str | None = None,
) -> DataFrame:
    """Decoded trades to the rows of the aggregate table."""
    needed = ("price", "volume")
    trades = clean_and_deduplicate(wire, watermark_delay, keep_null_event_time, needed, copy_fanout, earliest, max_ahead)
    return aggregate_windows(trades, width)


def _raw_rows(wire: DataFrame, flow: TradeFlow) -> DataFrame:
    return clean_and_deduplicate(
        wire,
        flow.watermark_delay,
        flow.keep_null_event_time,
        copy_fanout=flow.copy_fanout,
        earliest=flow.earliest_copy,
        max_ahead=flow.max_ahead,
    )


def _window_rows(wire: DataFrame, flow: TradeFlow) -> DataFrame:
    return window_metrics(
        wire,
        flow.window_width,
        flow.watermark_delay,
        flow.keep_null_event_time,
        flow.copy_fanout,
        flow.earliest_copy,
        flow.max_ahead,
    )


def bootstrap(spark: SparkSession, namespace: str, provider: str = "iceberg") -> tuple[str, str]:
    """Create the namespace and both tables where missing; their full names."""
    raw, aggregated = f"{namespace}.{RAW_TABLE}", f"{namespace}.{AGGREGATED_TABLE}"
    ensure_namespace(spark, namespace)
    ensure_table(spark, raw, RAW_LAYOUT, provider)
    ensure_table(spark, aggregated, AGGREGATED_LAYOUT, provider)
    return raw, aggregated


def start_raw(wire: DataFrame, target: str, flow: TradeFlow) -> StreamingQuery:
    return start_table_stream(
        _raw_rows(wire, flow),
        target,
        RAW_LAYOUT,
        flow.checkpoint(RAW_TABLE),
        RAW_QUERY,
        flow.trigger,
        flow.writers_per_partition,
    )


def start_aggregated(wire: DataFrame, target: str, flow: TradeFlow) -> StreamingQuery:
    return start_table_stream(
        _window_rows(wire, flow),
        target,
        AGGREGATED_LAYOUT,
        flow.checkpoint(AGGREGATED_TABLE),
        AGGREGATED_QUERY,
        flow.trigger,
        flow.writers_per_partition,
    )


def start_rejects(wire: DataFrame, target: str, flow: TradeFlow) -> StreamingQuery:
    """The rejected rows as they came in, each with its reason.

    A path gets Spark's file sink and belongs to this checkpoint. A table gets
    each micro-batch appended: rejected rows have no key, so a batch that is
    read again after a failure is there twice, and none is lost.

    The outcomes of all rows, accepted ones too, are counted on the way and go out
    with the query's progress (see ``OutcomeLog``).
    """
    classified = classify(wire, flow.keep_null_event_time, keep_input=True, max_ahead=flow.max_ahead)
    rows = rejected_input(observe_outcomes(classified, OUTCOMES))
    writer = stream_writer(rows, flow.checkpoint(REJECT_TABLE), REJECT_QUERY, flow.trigger)
    if is_path(target):
        return writer.format("parquet").partitionBy("reject_reason").start(target)

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").saveAsTable(target)

    return writer.foreachBatch(append).start()


def run_trade_flow(
    wire: DataFrame,
    raw_target: str,
    aggregated_target: str,
    flow: TradeFlow,
    reject_target: str | None = None,
) -> list[StreamingQuery]:
    """One decoded stream to both tables and, on request, its rejected rows to a third.

    Each query has its own checkpoint and reads the source for itself, so that
    one can fail, restart or be replayed without the others.
    """
    queries = [start_raw(wire, raw_target, flow), start_aggregated(wire, aggregated_target, flow)]
    if reject_target is not None:
        queries.append(start_rejects(wire, reject_target, flow))
    return queries


def run_serving_flow(wire: DataFrame, database: JdbcTarget, flow: TradeFlow) -> list[StreamingQuery]:
    """The same two streams into a serving database, whose times may not be NULL."""
    if flow.keep_null_event_time:
        raise ValueError("rows without event time cannot go to a serving database")
    sinks = [
        (_raw_rows(wire, flow), SERVING_RAW_TABLE, RAW_LAYOUT, SERVING_RAW_QUERY),
        (_window_rows(wire, flow), SERVING_AGGREGATED_TABLE, AGGREGATED_LAYOUT, SERVING_AGGREGATED_QUERY),
    ]
    return [
        start_jdbc_stream(rows, database, table, layout, flow.checkpoint(table), query, flow.trigger)
        for rows, table, layout, query in sinks
    ]


def await_any(spark: SparkSession, queries: list[StreamingQuery], timeout: int | None = None) -> None:
    """Wait until one query of the session ends, then stop the others. A failure is raised."""
    try:
        spark.streams.awaitAnyTermination(timeout)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
        spark.streams.resetTerminated()


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended; if one fails, stop the others and raise its error."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def ingest(
    messages: DataFrame, source: str, symbols: list[str] | None = None, exact: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vendor messages to accepted trades, rejected items and malformed messages.

    Accepted trades keep the text of their price, with ``exact`` all of its digits. Rejected items, incomplete ones
    too, keep all of their text and the reason; the list of subscribed symbols
    is applied to what the rules accept. Malformed messages carry no complete
    trade at all; they are returned as they came.
    """
    classified = classify(explode_items(messages, source, exact=exact), keep_input=True, trade_time=epoch_millis_to_time)
    good = classified.where(F.col("reject_reason").isNull()).select(
        "symbol", "original.price", "volume", "trade_timestamp", "ingestion_timestamp", "source"
    )
    if symbols is not None:
        good = allow_symbols(good, symbols)
    return good, rejected_input(classified), malformed_messages(messages)


def run_ingest(
    messages: DataFrame,
    source: str,
    trades_to: KafkaSink,
    flow: TradeFlow,
    symbols: list[str] | None = None,
    rejects_to: KafkaSink | None = None,
) -> list[StreamingQuery]:
    """Publish the accepted trades of a vendor message stream and, on request, its dead letters.

    Malformed messages are dead letters as well, with the reason ``message``.
    """
    good, bad, malformed = ingest(messages, source, symbols)
    started = [
        start_publishing(
            trade_messages(good), trades_to, flow.checkpoint(trades_to.topic), trades_to.client_id, flow.trigger
        )
    ]
    if rejects_to is not None:
        name = f"{trades_to.client_id}-rejects"
        whole = malformed.select(F.col("value").cast("string").alias("message"), F.lit("message").alias("reject_reason"))
        bad = bad.unionByName(whole, allowMissingColumns=True)
        started.append(
            start_publishing(reject_messages(bad), rejects_to, flow.checkpoint(rejects_to.topic), name, flow.trigger)
        )
    return started
