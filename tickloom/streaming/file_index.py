"""An index of a table's files: date, symbol, least and greatest time and rows of each.

It is written with every append, from the rows as they were stored. A read for the
newest rows, or for a symbol and a time span, takes the files from it and opens no others.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.serving import latest
from tickloom.schema import Layout
from tickloom.sources.tables import time_range

INDEX_SCHEMA = "trade_date date, symbol string, file string, first_time timestamp, last_time timestamp, row_count bigint"


def file_rows(stored: DataFrame, layout: Layout) -> DataFrame:
    """The index rows of the files that a scan reads."""
    time = F.col(layout.time_column)
    return stored.groupBy("trade_date", "symbol", F.col("_metadata.file_path").alias("file")).agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count("*").alias("row_count")
    )


def write_indexed(df: DataFrame, folder: str, index: str, layout: Layout) -> None:
    """Replace the files of a folder and the index of them; the time column is read back, nothing else.

    The index comes last, so files that a failure left without an index are seen by no read that uses it.
    """
    df.write.mode("overwrite").partitionBy(*layout.partition_by).parquet(folder)
    stored = df.sparkSession.read.schema(layout.schema).parquet(folder)
    file_rows(stored, layout).coalesce(1).write.mode("overwrite").parquet(index)


def write_ranged(df: DataFrame, folder: str, index: str, layout: Layout, files: int) -> None:
    """Replace a table that is laid out by ranges, and its index.

    Rows are cut into ranges of (date, symbol, time) by bounds that Spark samples, so files are
    even however unevenly symbols trade, and a symbol with little trade shares a
    file with others instead of having a folder of tiny ones. Row groups carry a
    Bloom filter of the symbol besides their least and greatest time.
    """
    order = ("trade_date", "symbol", layout.time_column)
    rows = df.select(*layout.columns).repartitionByRange(files, *order).sortWithinPartitions(*order)
    options = {"parquet.bloom.filter.enabled#symbol": "true", "parquet.bloom.filter.expected.ndv#symbol": "10000"}
    rows.write.mode("overwrite").options(**options).partitionBy("trade_date").parquet(folder)
    stored = df.sparkSession.read.schema(layout.schema).parquet(folder)
    file_rows(stored, layout).coalesce(1).write.mode("overwrite").parquet(index)


def read_index(spark: SparkSession, index: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(index)


def read_files(spark: SparkSession, table: str, files: list[str], layout: Layout) -> DataFrame:
    """The rows of some files of a table; partition values come from their paths below ``table``."""
    if not files:
        return spark.createDataFrame([], layout.schema)
    return spark.read.schema(layout.schema).option("basePath", table).parquet(*files).select(*layout.columns)


def newest_files(index: DataFrame, count: int) -> list[str]:
    """Files that can hold one of the ``count`` newest rows.

    Files that begin late enough hold ``count`` rows from their earliest beginning on, so no file that
    ends before it is needed. The running sum sees the files of the newest dates only:
    those from which on there are ``count`` rows of whole dates.
    """
    per_date = index.groupBy("trade_date").agg(F.sum("row_count").alias("row_count"))
    newer = Window.orderBy(F.col("trade_date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    dates = per_date.withColumn("newer", F.coalesce(F.sum("row_count").over(newer), F.lit(0))).where(F.col("newer") < count)
    since = dates.agg(F.min("trade_date")).first()[0]
    if since is None:
        return []
    recent = index.where(F.col("trade_date") >= F.lit(since))
    upto = Window.orderBy(F.col("first_time").desc(), "file")
    begun = recent.withColumn("begun", F.sum("row_count").over(upto))
    least = begun.where(F.col("begun") >= count).agg(F.max("first_time")).first()[0]
    if least is not None:
        recent = recent.where(F.col("last_time") >= F.lit(least))
    return [row["file"] for row in recent.select("file").collect()]


def latest_indexed(spark: SparkSession, table: str, index: str, count: int, layout: Layout) -> DataFrame:
    """The ``count`` newest rows of a table; only files that can hold one of them are opened."""
    files = newest_files(read_index(spark, index), count)
    return latest(read_files(spark, table, files, layout), count, layout.time_column)


def read_span(spark: SparkSession, table: str, index: str, symbol: str, start: str | datetime, end: str | datetime, layout: Layout) -> DataFrame:
    """The rows of a symbol in ``[start, end)``; only files that hold some are opened."""
    rows = read_files(spark, table, files_for(read_index(spark, index), symbol, start, end), layout)
    return time_range(rows.where(F.col("symbol") == symbol), start, end, layout.time_column)


def files_for(index: DataFrame, symbol: str, start: str | datetime, end: str | datetime) -> list[str]:
    """Files with rows of a symbol in ``[start, end)``, as far as their first and last time tell."""
    low, high = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    dates = F.col("trade_date").between(F.to_date(low), F.to_date(high))
    rows = index.where(dates & (F.col("symbol") == symbol) & (F.col("first_time") < high) & (F.col("last_time") >= low))
    return [row["file"] for row in rows.select("file").collect()]
