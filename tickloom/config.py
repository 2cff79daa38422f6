"""Parameters of the trade flow, as plain frozen dataclasses.

Operators never read the environment: a job builds one of these objects (or
takes the defaults) and hands it over.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Names and limits that existing jobs, topics and SQL rely on.
TOPIC = "stock_trades"
CLIENT_ID = "stock-trade-producer"
RAW_TABLE = "raw_stream_data"
AGGREGATED_TABLE = "aggregated_data"
SERVING_RAW_TABLE = "raw_trades"
SERVING_AGGREGATED_TABLE = "aggregated_trades_1m"
SUMMARY_VIEW = "stock_summary_latest"
RAW_QUERY = "raw_stream_data_writer"
AGGREGATED_QUERY = "aggregated_data_writer"
SERVING_RAW_QUERY = "postgres_raw_trades_writer"
SERVING_AGGREGATED_QUERY = "postgres_aggregated_trades_writer"
WATERMARK_DELAY = "2 minutes"
WINDOW_WIDTH = "1 minute"
MAX_OFFSETS_PER_TRIGGER = 5000
PRODUCER_RETRIES = 10
PRODUCER_LINGER_MS = 100
SYMBOLS = "AAPL,MSFT,AMZN"

WRITERS_PER_PARTITION = 1
REJECT_TABLE = "rejected_stream_data"
REJECT_QUERY = "rejected_stream_data_writer"
ONE_PASS_QUERY = "one_pass_writer"
SILENCE_QUERY = "active_span_writer"
# Under this name the counts of accepted and rejected trades are in a query's progress.
OUTCOMES = "outcomes"
# A symbol that has no trade for this long is silent.
SILENCE = "15 minutes"
SUMMARY_QUERY = "symbol_summary_writer"


@dataclass(frozen=True)
class KafkaSource:
    """Where a trade stream is read from, and how fast."""

    brokers: str
    topic: str = TOPIC
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    # None lifts the limit; a backfill on a large cluster wants that.
    max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER
    # More read tasks than topic partitions, for topics with few partitions.
    min_partitions: int | None = None


@dataclass(frozen=True)
class KafkaSink:
    """Where trades are published to, and with which delivery settings."""

    brokers: str
    topic: str = TOPIC
    client_id: str = CLIENT_ID
    retries: int = PRODUCER_RETRIES
    linger_ms: int = PRODUCER_LINGER_MS


@dataclass(frozen=True)
class JdbcTarget:
    """A serving database reached over JDBC."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    # Bounds the open connections, however many partitions a batch has.
    connections: int = 8
    batch_size: int = 10_000

    @classmethod
    def postgres(cls, host: str, port: int, database: str, user: str, password: str, **more) -> JdbcTarget:
        return cls(f"jdbc:postgresql://{host}:{port}/{database}", user, password, **more)


@dataclass(frozen=True)
class TradeFlow:
    """The knobs shared by the raw and the aggregate stream."""

    checkpoint_root: str
    watermark_delay: str = WATERMARK_DELAY
    window_width: str = WINDOW_WIDTH
    keep_null_event_time: bool = False
    # Groups in which the copies of one trade are removed first; see deduplicate.
    copy_fanout: int = 1
    # Keep the earliest copy of a trade, as a table does, and pass it on behind the watermark; otherwise the
    # first copy seen, at once. See deduplicate.
    earliest_copy: bool = False
    # How far an event time may lie ahead of the arrival, e.g. "1 hour"; None admits any. One trade dated far in
    # the future moves the watermark past all others.
    max_ahead: str | None = None
    # Writer tasks that share one (date, symbol) partition of a micro-batch. One keeps files few; more
    # are for streams in which a single symbol is too much for a task.
    writers_per_partition: int = WRITERS_PER_PARTITION
    # Keyword arguments of DataStreamWriter.trigger; None means as soon as possible.
    trigger: dict | None = None

    def checkpoint(self, table: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{table}"


def parse_symbol_list(text: str) -> list[str]:
    """``" AAPL, MSFT,"`` -> ``["AAPL", "MSFT"]``."""
    return [symbol for symbol in (part.strip() for part in text.split(",")) if symbol]
