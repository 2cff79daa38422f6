"""Vendor messages: a JSON envelope that carries a list of trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import epoch_millis_to_time, to_volume
from tickloom.schema import VENDOR_SCHEMA


def _message(column: str) -> Column:
    return F.from_json(F.col(column).cast("string"), VENDOR_SCHEMA)


def _complete(item: Column) -> Column:
    return item["s"].isNotNull() & item["p"].isNotNull() & item["v"].isNotNull() & item["t"].isNotNull()


def _exact_items(messages: DataFrame, column: str) -> DataFrame:
    """The items' fields as text with all of their digits.

    A variant holds a number as it is written, as a decimal of up to 38 digits, where
    the reader of a fixed schema makes a double of it on the way to text.
    """
    parsed = messages.select(F.inline(F.array(F.struct(F.try_parse_json(F.col(column).cast("string")).alias("message")))))
    of_trades = parsed.where(F.expr("try_variant_get(message, '$.type', 'string') = 'trade'"))
    items = of_trades.select(F.explode(F.expr("try_variant_get(message, '$.data', 'array<variant>')")).alias("item"))
    return items.select(*[F.expr(f"try_variant_get(item, '$.{name}', 'string')").alias(name) for name in ("s", "p", "v", "t")])


def explode_items(messages: DataFrame, source: str, column: str = "value", exact: bool = False) -> DataFrame:
    """One row per item in messages of type ``trade``, complete or not, its fields as text.

    The time is the text of epoch milliseconds. With ``exact`` no number goes through a double.
    """
    if exact:
        items = _exact_items(messages, column)
    else:
        envelope = messages.select(F.inline(F.array(_message(column))))
        items = envelope.where(F.col("type") == "trade").select(F.inline("data"))
    return items.select(
        F.col("s").alias("symbol"),
        F.col("p").alias("price"),
        F.col("v").alias("volume"),
        F.col("t").alias("trade_timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.lit(source).alias("source"),
    )


def explode_messages(messages: DataFrame, source: str, column: str = "value", exact: bool = False) -> DataFrame:
    """One row per complete trade in messages of type ``trade``.

    ``price`` stays text as the JSON reader gives it (a number passes through a
    double there, but not with ``exact``); volume and time are typed. Items that lack a symbol, price,
    volume or time are skipped, as are messages of other types and text that is
    not JSON.
    """
    complete = explode_items(messages, source, column, exact).dropna(subset=["symbol", "price", "volume", "trade_timestamp"])
    return complete.withColumns(
        {
            "volume": to_volume(F.col("volume")),
            "trade_timestamp": epoch_millis_to_time(F.col("trade_timestamp")),
        }
    )


def malformed_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """The messages of type ``trade`` that carry no complete trade, unchanged."""
    envelope = messages.select("*", F.inline(F.array(_message(column))))
    usable = F.exists("data", _complete)
    return envelope.where((F.col("type") == "trade") & ~F.coalesce(usable, F.lit(False))).select(*messages.columns)
