"""Data checks on the two tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.config import SILENCE, WINDOW_WIDTH


def freshness_report(trades: DataFrame, as_of: str | datetime | Column | None = None) -> DataFrame:
    """Per symbol: rows, newest event and arrival, and how far behind they are.

    ``ingest_lag_seconds`` is the distance of the newest arrival from the newest
    event. With ``as_of`` the report also tells the age of the newest event.
    """
    report = trades.groupBy("symbol").agg(
        F.count("*").alias("row_count"),
        F.max("trade_timestamp").alias("last_trade"),
        F.max("ingestion_timestamp").alias("last_ingestion"),
    )
    report = report.withColumn("ingest_lag_seconds", _seconds("last_ingestion") - _seconds("last_trade"))
    if as_of is None:
        return report
    now = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")
    return report.withColumn("age_seconds", F.unix_seconds(now) - _seconds("last_trade"))


def active_spans(trades: DataFrame, gap: str = SILENCE) -> DataFrame:
    """Per symbol the stretches in which no two neighbouring trades are more than ``gap`` apart.

    Between two stretches the symbol was silent. Stretches are merged per task before
    the shuffle, so a busy symbol sends few rows. In a watermarked stream a stretch
    is told once, when the watermark is ``gap`` past its last trade: the symbol has been silent since.
    """
    spans = trades.groupBy("symbol", F.session_window("trade_timestamp", gap).alias("span")).agg(
        F.min("trade_timestamp").alias("first_trade"),
        F.max("trade_timestamp").alias("last_trade"),
        F.count("*").alias("trade_count"),
    )
    return spans.select("symbol", "first_trade", "last_trade", F.col("span.end").alias("silent_at"), "trade_count")


def _seconds(column: str) -> Column:
    return F.unix_seconds(F.col(column))


def reconcile(
    trades: DataFrame,
    windows: DataFrame,
    closed_before: str | datetime | Column | None = None,
    width: str = WINDOW_WIDTH,
) -> DataFrame:
    """Per symbol and day: trades in the raw table against trades in the aggregate.

    A stream still holds the windows that end after its watermark; pass the
    watermark as ``closed_before`` to leave their trades out. Both sides are
    aggregated before the join, so it sees one row per symbol and day.
    """
    if closed_before is not None:
        limit = closed_before if isinstance(closed_before, Column) else F.lit(str(closed_before)).cast("timestamp")
        trades = trades.where(F.window("trade_timestamp", width)["end"] <= limit)
        windows = windows.where(F.col("window_end") <= limit)
    keys = ["symbol", "trade_date"]
    raw = trades.groupBy(*keys).agg(F.count("*").alias("raw_count"))
    aggregated = windows.groupBy(*keys).agg(F.sum("trade_count").alias("aggregated_count"))
    both = raw.join(aggregated, keys, "full_outer").na.fill(0, ["raw_count", "aggregated_count"])
    return both.withColumn("difference", F.col("raw_count") - F.col("aggregated_count"))
