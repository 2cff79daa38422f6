"""Reads that dashboards and analysts run on the two tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import (
    AGGREGATED_TABLE,
    RAW_TABLE,
    SERVING_AGGREGATED_TABLE,
    SERVING_RAW_TABLE,
    SUMMARY_VIEW,
)
from tickloom.operators.aggregate import symbol_summary
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT
from tickloom.sources.tables import time_range


def latest(df: DataFrame, count: int, by: str, ties: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """The ``count`` newest rows, newest first; every task keeps only its own top rows."""
    return df.orderBy(F.col(by).desc(), *ties).limit(count)


def latest_trades(trades: DataFrame, count: int = 20) -> DataFrame:
    return latest(trades.select(*RAW_LAYOUT.columns), count, "trade_timestamp")


def latest_windows(windows: DataFrame, count: int = 50) -> DataFrame:
    """The newest windows without their partition date."""
    columns = [name for name in AGGREGATED_LAYOUT.columns if name != "trade_date"]
    return latest(windows.select(*columns), count, "window_start")


def latest_stored(table: DataFrame, count: int, by: str, date_column: str = "trade_date") -> DataFrame:
    """``latest`` on a table partitioned by the date of ``by``, without reading the rows of its older partitions.

    The newest date is the maximum of a partition column, for which Spark opens the
    footers of all files; each step then counts the rows from one date on and takes
    the span back to twice as many days, until ``count`` rows lie in it or the oldest date is reached.
    Where appends keep an index of the files (``streaming.file_index``),
    ``latest_indexed`` opens the newest files alone.
    """
    dates = table.select(date_column).where(F.col(date_column).isNotNull()).distinct()
    ends = dates.agg(F.min(date_column).alias("first"), F.max(date_column).alias("last")).first()
    days = 1
    while ends["last"] is not None and (since := ends["last"] - timedelta(days=days - 1)) > ends["first"]:
        recent = table.where(F.col(date_column) >= F.lit(since))
        if recent.limit(count).count() >= count:
            return latest(recent, count, by)
        days *= 2
    return latest(table, count, by)


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def price_series(trades: DataFrame) -> DataFrame:
    """Price over event time, trade by trade. The sort key is unique, so range partitions come out even."""
    return trades.select("trade_timestamp", "symbol", "price").orderBy("trade_timestamp", "symbol")


def price_range_series(
    trades: DataFrame, start: str | datetime, end: str | datetime, symbols: list[str], width: str
) -> DataFrame:
    """First, lowest, highest and last price per symbol and bucket of time, for a chart of a span.

    Its size follows from the span and the width, not from the number of trades.
    """
    bucket = F.window("trade_timestamp", width).getField("start").alias("bucket_start")
    order = F.struct("trade_timestamp", "price")
    return (
        time_range(trades, start, end)
        .where(F.col("symbol").isin(list(symbols)))
        .groupBy("symbol", bucket)
        .agg(
            F.min_by("price", order).alias("first_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.max_by("price", order).alias("last_price"),
        )
    )


def avg_price_series(windows: DataFrame) -> DataFrame:
    return windows.select("window_start", "symbol", "avg_price").orderBy("window_start", "symbol")


def register_views(trades: DataFrame, windows: DataFrame) -> None:
    """Temporary views for SQL: both tables, their serving copies and the summary."""
    for name in (RAW_TABLE, SERVING_RAW_TABLE):
        trades.createOrReplaceTempView(name)
    for name in (AGGREGATED_TABLE, SERVING_AGGREGATED_TABLE):
        windows.createOrReplaceTempView(name)
    symbol_summary(windows).createOrReplaceTempView(SUMMARY_VIEW)
