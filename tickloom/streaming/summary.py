"""The symbol summary kept up to date by a stream, without reading the aggregate table.

A symbol's line is made of parts that can be merged: the newest window, sums and
counts. Every micro-batch merges what its windows say into the totals of the batch
before it and writes the result as its own, so a batch that is run again starts from the
same totals and replaces what it wrote. There is one row per symbol in a batch's
totals, however long the stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import SUMMARY_QUERY
from tickloom.session import children, remove_folder
from tickloom.streaming.tables import checkpoint_identity, stream_writer

TOTALS_SCHEMA = (
    "symbol string, latest_window_start timestamp, volume_sum decimal(38,0), trade_count bigint, avg_sum double, window_count bigint"
)
# Totals that stay behind the newest: the one that a replay starts from, and one that a reader may be at.
KEPT_BATCHES = 3


def summary_totals(windows: DataFrame) -> DataFrame:
    """Per symbol what can be merged with the same of other windows.

    A total volume beyond the bigint range is NULL in a window and left out, as the summary does.
    """
    return windows.groupBy("symbol").agg(
        F.max("window_start").alias("latest_window_start"),
        F.sum(F.col("total_volume").cast("decimal(28,0)")).cast("decimal(38,0)").alias("volume_sum"),
        F.sum("trade_count").alias("trade_count"),
        F.sum("avg_price").alias("avg_sum"),
        F.count("avg_price").alias("window_count"),
    )


def merged_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy("symbol").agg(
        F.max("latest_window_start").alias("latest_window_start"),
        *[F.sum(name).alias(name) for name in ("volume_sum", "trade_count", "avg_sum", "window_count")],
    ).withColumn("volume_sum", F.col("volume_sum").cast("decimal(38,0)"))


def summary_of(totals: DataFrame) -> DataFrame:
    """The summary's columns."""
    return totals.select(
        "symbol",
        "latest_window_start",
        F.expr("try_cast(volume_sum AS bigint)").alias("total_volume"),
        "trade_count",
        (F.col("avg_sum") / F.col("window_count")).alias("avg_price"),
    )


def _folder(target: str, query_id: str, batch_id: int) -> str:
    return f"{target.rstrip('/')}/query_id={query_id}/batch_id={batch_id:012d}"


def _complete(spark: SparkSession, folder: str) -> list[str]:
    """Batches whose totals were written to the end."""
    files = spark._jvm.org.apache.hadoop.fs
    system = files.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    return [name for name in children(spark, folder) if system.exists(files.Path(f"{folder}/{name}/_SUCCESS"))]


def merge_batch(windows: DataFrame, batch_id: int, target: str, query_id: str) -> None:
    """Merge a batch of new windows, each of which comes in one batch only, into the totals of the batch before."""
    spark = windows.sparkSession
    totals = summary_totals(windows)
    if batch_id > 0:
        before = spark.read.schema(TOTALS_SCHEMA).parquet(_folder(target, query_id, batch_id - 1))
        totals = merged_totals(totals.unionByName(before))
    totals.coalesce(1).write.mode("overwrite").parquet(_folder(target, query_id, batch_id))
    if batch_id >= KEPT_BATCHES:
        remove_folder(spark, _folder(target, query_id, batch_id - KEPT_BATCHES))


def start_summary(
    windows: DataFrame, target: str, checkpoint: str, query_name: str = SUMMARY_QUERY, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the summary of a stream of closed windows under ``target``, by query and batch."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, target, checkpoint_identity(batch.sparkSession, checkpoint))

    return stream_writer(windows, checkpoint, query_name, trigger).foreachBatch(merge).start()


def read_summary(spark: SparkSession, target: str, query_id: str) -> DataFrame:
    """The summary after a query's newest batch: one small file, whatever the table's size."""
    folder = f"{target.rstrip('/')}/query_id={query_id}"
    done = _complete(spark, folder)
    if not done:
        return summary_of(spark.createDataFrame([], TOTALS_SCHEMA))
    return summary_of(spark.read.schema(TOTALS_SCHEMA).parquet(f"{folder}/{done[-1]}"))
