"""Per-symbol aggregates over tumbling event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import WINDOW_WIDTH


def aggregate_windows(trades: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """Price and volume metrics per symbol and window ``[start, end)``, aligned to the epoch.

    Works on a table of trades and on a watermarked stream of them; there a
    window appears once the watermark has passed its end. A volume total beyond
    the bigint range is NULL instead of an error that would stop the stream.
    """
    windows = trades.groupBy("symbol", F.window("trade_timestamp", width).alias("window")).agg(
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.try_sum("volume").alias("total_volume"),
        F.count("*").alias("trade_count"),
    )
    metrics = ("avg_price", "min_price", "max_price", "total_volume", "trade_count")
    return windows.selectExpr(
        "symbol",
        "window.start AS window_start",
        "window.end AS window_end",
        *metrics,
        "to_date(window.start) AS trade_date",
    )


def symbol_summary(windows: DataFrame) -> DataFrame:
    """Per symbol: the latest window, totals, and the plain mean of the window averages."""
    return windows.groupBy("symbol").agg(
        F.max("window_start").alias("latest_window_start"),
        F.try_sum("total_volume").alias("total_volume"),
        F.sum("trade_count").alias("trade_count"),
        F.avg("avg_price").alias("avg_price"),
    )


def volume_by_symbol(windows: DataFrame) -> DataFrame:
    return windows.groupBy("symbol").agg(F.try_sum("total_volume").alias("total_volume"))


def total_trades(windows: DataFrame) -> DataFrame:
    return windows.agg(F.coalesce(F.sum("trade_count"), F.lit(0)).alias("trade_count"))


def activity_heatmap(trades: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Number of trades per symbol and time bucket."""
    return (
        trades.groupBy("symbol", F.window("trade_timestamp", bucket).alias("window"))
        .agg(F.count("*").alias("trade_count"))
        .select("symbol", F.col("window.start").alias("bucket_start"), "trade_count")
    )
