"""Symbols that fall silent, told by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import SILENCE, SILENCE_QUERY, TradeFlow
from tickloom.operators import active_spans, clean_and_deduplicate
from tickloom.streaming.tables import stream_writer

SPAN_SCHEMA = "symbol string, first_trade timestamp, last_trade timestamp, silent_at timestamp, trade_count bigint"


def start_silences(wire: DataFrame, path: str, flow: TradeFlow, gap: str = SILENCE) -> StreamingQuery:
    """Append a row for each stretch of trading that has ended, once; it says since when the symbol is silent."""
    trades = clean_and_deduplicate(
        wire, flow.watermark_delay, columns=(), copy_fanout=flow.copy_fanout, earliest=flow.earliest_copy, max_ahead=flow.max_ahead
    )
    writer = stream_writer(active_spans(trades, gap), flow.checkpoint("active_spans"), SILENCE_QUERY, flow.trigger)
    return writer.format("parquet").start(path)
