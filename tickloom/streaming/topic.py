"""Publishing trades to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from tickloom.config import KafkaSink
from tickloom.functions import iso_utc, message_key, message_value, plain_number
from tickloom.session import require_utc
from tickloom.streaming.tables import stream_writer


def kafka_sink_options(sink: KafkaSink) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": sink.brokers,
        "topic": sink.topic,
        "kafka.client.id": sink.client_id,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.retries": str(sink.retries),
        "kafka.linger.ms": str(sink.linger_ms),
        "kafka.compression.type": "snappy",
    }


def trade_messages(trades: DataFrame) -> DataFrame:
    """``key`` and ``value`` of each trade: price as text, volume as a number, times as ISO-8601 UTC."""
    require_utc(trades.sparkSession)
    # A price that is text is sent digit by digit as it came.
    is_text = isinstance(trades.schema["price"].dataType, StringType)
    price = F.col("price") if is_text else plain_number(F.col("price"))
    return trades.select(
        message_key(F.col("symbol")).alias("key"),
        message_value(
            symbol=F.col("symbol"),
            price=price,
            volume=F.col("volume"),
            trade_timestamp=iso_utc(F.col("trade_timestamp")),
            ingestion_timestamp=iso_utc(F.col("ingestion_timestamp")),
            source=F.col("source"),
        ).alias("value"),
    )


def reject_messages(rejected: DataFrame) -> DataFrame:
    """Dead letters: the original row, if it was kept, with the rule it failed."""
    spare = ("symbol", "reject_reason")
    body = {name: F.col(name) for name in rejected.columns if name not in spare}
    return rejected.select(
        message_key(F.col("symbol")).alias("key"),
        message_value(symbol=F.col("symbol"), **body, reject_reason=F.col("reject_reason")).alias("value"),
    )


def publish(messages: DataFrame, sink: KafkaSink) -> None:
    """Send a table of messages (needs the Kafka connector on the class path)."""
    messages.write.format("kafka").options(**kafka_sink_options(sink)).save()


def start_publishing(
    messages: DataFrame,
    sink: KafkaSink,
    checkpoint: str,
    query_name: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send a stream of messages (needs the Kafka connector on the class path)."""
    writer = stream_writer(messages, checkpoint, query_name, trigger)
    return writer.format("kafka").options(**kafka_sink_options(sink)).start()
