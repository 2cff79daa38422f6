"""Schemas of the messages and tables, and how the tables are laid out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# A trade as it travels on the topic. Every field is read as text, so that one
# malformed value costs one field and not the whole message.
WIRE_SCHEMA = _struct(
    symbol=StringType(),
    price=StringType(),
    volume=StringType(),
    trade_timestamp=StringType(),
    ingestion_timestamp=StringType(),
    source=StringType(),
)

# A vendor message: a type and a list of trades with short keys
# (s symbol, p price, v volume, t epoch milliseconds).
VENDOR_SCHEMA = _struct(
    type=StringType(),
    data=ArrayType(_struct(s=StringType(), p=StringType(), v=StringType(), t=StringType())),
)

RAW_SCHEMA = _struct(
    symbol=StringType(),
    price=DoubleType(),
    volume=LongType(),
    trade_timestamp=TimestampType(),
    ingestion_timestamp=TimestampType(),
    source=StringType(),
    trade_date=DateType(),
)

# A rejected row: the wire text as it came in, the whole message, and the first rule it failed.
REJECT_SCHEMA = StructType(
    [*WIRE_SCHEMA.fields, *(StructField(name, StringType(), True) for name in ("message", "reject_reason"))]
)

AGGREGATED_SCHEMA = _struct(
    symbol=StringType(),
    window_start=TimestampType(),
    window_end=TimestampType(),
    avg_price=DoubleType(),
    min_price=DoubleType(),
    max_price=DoubleType(),
    total_volume=LongType(),
    trade_count=LongType(),
    trade_date=DateType(),
)


@dataclass(frozen=True)
class Layout:
    """How one table is stored: its columns, keys and physical order."""

    schema: StructType
    time_column: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ("trade_date", "symbol")

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def order_by(self) -> tuple[str, ...]:
        return (*self.partition_by, self.time_column)


RAW_LAYOUT = Layout(RAW_SCHEMA, "trade_timestamp", ("symbol", "trade_timestamp"))
AGGREGATED_LAYOUT = Layout(AGGREGATED_SCHEMA, "window_start", ("symbol", "window_start"))
