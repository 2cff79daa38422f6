"""Trades on the topic: the Kafka source and the decoding of its messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.config import KafkaSource
from tickloom.schema import WIRE_SCHEMA


def kafka_source_options(source: KafkaSource) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": source.brokers,
        "subscribe": source.topic,
        "startingOffsets": source.starting_offsets,
        "failOnDataLoss": str(source.fail_on_data_loss).lower(),
    }
    if source.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(source.max_offsets_per_trigger)
    if source.min_partitions is not None:
        options["minPartitions"] = str(source.min_partitions)
    return options


def read_wire_stream(spark: SparkSession, source: KafkaSource) -> DataFrame:
    """The decoded trade stream of a topic (needs the Kafka connector on the class path)."""
    messages = spark.readStream.format("kafka").options(**kafka_source_options(source)).load()
    return decode_wire(messages, keep_message=True)


def read_wire_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The decoded trade stream of a folder of JSON-lines files."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decode_wire(reader.text(path), keep_message=True)


def decode_wire(messages: DataFrame, column: str = "value", keep_message: bool = False) -> DataFrame:
    """JSON bytes or text to the six text columns of a trade.

    A message that is not JSON gives a row of NULLs, which the quality rules
    reject, so it is counted rather than lost. With ``keep_message`` its text
    stays as ``message``, for dead letters, with the topic, partition and offset
    of a Kafka source, and ``malformed`` tells whether it was no JSON.
    """
    text = F.col(column).cast("string")
    if not keep_message:
        return messages.select(F.inline(F.array(F.from_json(text, WIRE_SCHEMA))))
    schema = StructType([*WIRE_SCHEMA.fields, StructField("malformed", StringType(), True)])
    origin = [name for name in ("topic", "partition", "offset") if name in messages.columns]
    payload = F.from_json(text, schema, {"columnNameOfCorruptRecord": "malformed"})
    decoded = messages.select(*origin, text.alias("message"), F.inline(F.array(payload)))
    return decoded.select(*WIRE_SCHEMA.names, *origin, "message", F.col("malformed").isNotNull().alias("malformed"))
