"""Trade messages derived from an ``events`` table, so that the flow can run on it.

Every event becomes a trade of the symbol ``event_type``. The table has no bad
rows, no copies and no extreme values, so they are put in by rules on the event
number; the rules add rows or change values, and no event is left out. Messages are
derived row by row, after one exchange that deals the events to tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import message_value

SOURCE = "events"
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events, dealt to as many tasks as the session has cores.

    A topic has partitions; this table may be one file of one row group, which a
    single task would turn into messages and decode again. The exchange stands for the
    topic's partitions and carries the few columns that messages are made of.
    """
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")
    return events.repartition(spark.sparkContext.defaultParallelism, "event_id")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    # Written as a pattern because a stream takes a plain path for a directory.
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parque[t]")


# Which events are sent twice.
COPIED = "event_id % 11 = 0"
_ISO = "concat(date_format({time}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
_K = "get_json_object(props, '$.k')"


def wire_columns(events: DataFrame, shift_seconds: int = 0, replay: int | None = None) -> DataFrame:
    """``event_id`` and the six text columns of a wire trade; every eleventh event is sent twice.

    ``replay`` picks the first (0) or the second (1) sending.
    """
    sent = events.selectExpr(
        "*",
        f"ts + make_dt_interval(0, 0, 0, {shift_seconds}) AS time",
        f"explode(if({COPIED}, array(0, 1), array(0))) AS replay",
    )
    if replay is not None:
        sent = sent.where(F.col("replay") == replay)
    arrival = "time + make_dt_interval(0, 0, 0, 1 + 5 * replay)"
    return sent.selectExpr(
        "event_id",
        "CASE WHEN event_id % 19 <> 0 THEN event_type END AS symbol",
        """CASE WHEN event_id % 13 = 0 THEN '-1' WHEN event_id % 17 = 0 THEN 'abc'
             WHEN event_id % 61 = 0 THEN '12345678.5' WHEN event_id % 67 = 0 THEN '0.000125'
             ELSE string(value) END AS price""",
        f"CASE WHEN event_id % 29 = 0 THEN '-5' WHEN event_id % 37 = 0 THEN '10.5' ELSE {_K} END AS volume",
        "CASE WHEN event_id % 69 = 0 THEN '10:00:00' WHEN event_id % 115 = 0 THEN '99999-01-01T00:00:00+00:00' "
        f"WHEN event_id % 23 = 0 THEN 'nope' ELSE {_ISO.format(time='time')} END AS trade_timestamp",
        f"{_ISO.format(time=arrival)} AS ingestion_timestamp",
        f"'{SOURCE}' AS source",
    )


def wire_messages(events: DataFrame, shift_seconds: int = 0, replay: int | None = None) -> DataFrame:
    """Wire trades as a topic delivers them: JSON bytes in ``value``, every 59th event as text that is no JSON."""
    wire = wire_columns(events, shift_seconds, replay)
    trade = message_value(**{name: F.col(name) for name in wire.columns if name != "event_id"})
    garbage = F.concat(F.lit("garbage "), F.col("event_id")).cast("binary")
    return wire.select(F.when(F.col("event_id") % 59 == 0, garbage).otherwise(trade).alias("value"))


# A price of twenty digits, half of them behind the point, that follows from the event's number.
LONG_PRICE = "concat(10000000000 + event_id, '.', lpad(string(event_id * 7 + 1), 9, '0'))"


def long_price_messages(events: DataFrame) -> DataFrame:
    """Vendor messages of one trade whose price has more digits than a double holds."""
    return events.selectExpr(
        f"""concat('{{"type":"trade","data":[{{"s":"', event_type, '","p":', {LONG_PRICE}, ',"v":', {_K},
            ',"t":', unix_millis(timestamp(ts)), '}}]}}') AS value"""
    )


_ITEM = "struct<s: string, p: double, v: decimal(12,2), t: bigint>"


def vendor_messages(events: DataFrame) -> DataFrame:
    """One vendor message per event, with up to three items; ``event_id`` and JSON text ``value``.

    The first matching rule decides what kind of message an event sends:
    31 ping, 37 text that is not JSON, 41 a trade without ``data``, 43 with an
    empty one, 47 with one item that lacks its price. All others send the trade
    itself; every seventh adds an item without volume, every fifth a second
    trade a millisecond later with a fractional volume. JSON leaves out fields
    that are NULL, which is how an item comes to lack one.
    """
    trade = events.selectExpr(
        "event_id", "event_type AS s", "value AS p", f"decimal({_K}) AS v", "unix_millis(timestamp(ts)) AS t"
    )
    nothing = f"cast(array() AS array<{_ITEM}>)"

    def items(p: str = "p", v: str = "v", t: str = "t") -> str:
        return f"cast(array(named_struct('s', s, 'p', {p}, 'v', {v}, 't', {t})) AS array<{_ITEM}>)"

    data = f"""CASE
        WHEN event_id % 43 = 0 THEN {nothing}
        WHEN event_id % 47 = 0 THEN {items(p="NULL")}
        ELSE concat(
          {items()},
          if(event_id % 7 = 0, {items(v="NULL")}, {nothing}),
          if(event_id % 5 = 0, {items(v="v + 0.75", t="t + 1")}, {nothing}))
        END"""
    message = f"""CASE
        WHEN event_id % 31 = 0 THEN '{{"type":"ping"}}'
        WHEN event_id % 37 = 0 THEN 'not json'
        WHEN event_id % 41 = 0 THEN '{{"type":"trade"}}'
        ELSE to_json(struct('trade' AS type, {data} AS data))
        END"""
    return trade.selectExpr("event_id", f"{message} AS value")
