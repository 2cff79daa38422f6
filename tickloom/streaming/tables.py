"""The stored tables: creation, write layout, stream sinks and idempotent appends."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.config import WRITERS_PER_PARTITION
from tickloom.schema import Layout
from tickloom.sources.tables import is_path


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def table_ddl(table: str, layout: Layout, provider: str = "parquet") -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a table of this layout.

    Iceberg partitions by a transform of the time, so a plain time predicate
    prunes. Formats without transforms partition by the date column instead;
    ``time_range`` puts the bounds on both.
    """
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in layout.schema)
    ddl = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {provider}"
    if provider == "iceberg":
        return (
            f"{ddl} PARTITIONED BY (days({layout.time_column}), symbol)"
            " TBLPROPERTIES ('format-version' = '2', 'write.distribution-mode' = 'hash')"
        )
    return f"{ddl} PARTITIONED BY ({', '.join(layout.partition_by)})"


def ensure_table(spark: SparkSession, table: str, layout: Layout, provider: str = "parquet") -> None:
    spark.sql(table_ddl(table, layout, provider))


def distribute(df: DataFrame, layout: Layout, writers_per_partition: int = WRITERS_PER_PARTITION) -> DataFrame:
    """Bring the rows of one table partition together before they are written.

    In batch, rebalancing lets adaptive execution split the partition of a hot
    symbol by size and merge small ones. Streams run without adaptive
    execution, micro-batches handed to a callback included; there the rows of a
    partition are spread over a fixed number of writers by event time.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if adaptive and not df.isStreaming:
        return df.hint("rebalance", *layout.partition_by)
    writer = F.pmod(F.xxhash64(layout.time_column), F.lit(writers_per_partition))
    return df.repartition(*[F.col(name) for name in layout.partition_by], writer)


def arrange(df: DataFrame, layout: Layout, writers_per_partition: int = WRITERS_PER_PARTITION) -> DataFrame:
    """Rows as they lie in the files of a batch write: partition by partition, in time order.

    The order makes the min/max statistics of Parquet row groups narrow, so a
    query for a symbol and a time span skips most of them.
    """
    rows = distribute(df.select(*layout.columns), layout, writers_per_partition)
    return rows.sortWithinPartitions(*layout.order_by)


def write_table(
    df: DataFrame,
    path: str,
    layout: Layout,
    mode: str = "errorifexists",
    writers_per_partition: int = WRITERS_PER_PARTITION,
) -> None:
    arrange(df, layout, writers_per_partition).write.mode(mode).partitionBy(*layout.partition_by).parquet(path)


def compact(table: DataFrame, path: str, layout: Layout, first_date: str, last_date: str) -> None:
    """Rewrite closed dates of a streamed table in few files, in time order, under a path.

    A stream writes small files that are not sorted. Only the dates from
    ``first_date`` to ``last_date`` are read, and only these dates' partitions of
    the target are replaced, so a job that failed or ran before can run again.
    """
    closed = table.where(F.col("trade_date").between(F.to_date(F.lit(first_date)), F.to_date(F.lit(last_date))))
    rows = arrange(closed, layout)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*layout.partition_by).parquet(path)


def append_batch(
    batch: DataFrame,
    batch_id: int,
    target: str,
    layout: Layout,
    query_id: str,
    writers_per_partition: int = WRITERS_PER_PARTITION,
) -> None:
    """Append one micro-batch so that applying it again changes nothing.

    ``query_id`` names who appends: batch numbers start anew with every
    checkpoint, so they are unique only together with it. Under a path every
    batch of a query owns the folder ``query_id=<id>/batch_id=<n>`` and replaces
    it; a batch without rows leaves no folder. In a catalog table the rows are added whose key is not there yet; keys are
    unique after deduplication and never NULL in strict cleaning. Catalogs other
    than the session's own shuffle and sort by the table's write properties.
    """
    if is_path(target):
        folder = f"{target.rstrip('/')}/query_id={query_id}/batch_id={batch_id}"
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                write_table(batch, folder, layout, "overwrite", writers_per_partition)
        finally:
            batch.unpersist()
        return
    spark = batch.sparkSession
    table = spark.table(target)

    def insert(rows: DataFrame) -> None:
        if in_session_catalog(spark, target):
            arrange(rows, layout, writers_per_partition).select(*table.columns).write.insertInto(target)
        else:
            rows.select(*table.columns).writeTo(target).append()

    append_unseen(batch, layout, lambda low, high: table, insert)


def in_session_catalog(spark: SparkSession, table: str) -> bool:
    parts = table.split(".")
    return (parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()) == "spark_catalog"


def append_unseen(
    batch: DataFrame,
    layout: Layout,
    stored_rows: Callable[[object, object], DataFrame],
    insert: Callable[[DataFrame], None],
) -> None:
    """Insert the rows of ``batch`` whose key is not among the stored rows.

    One pass over the batch finds whether it is empty, which time span it covers
    and which dates; of the stored table only that span of these dates is read, so a single
    trade of a far date opens that date and not all between. The batch is kept
    for the second pass, so its upstream stages, state updates included, run once.
    """
    time = F.col(layout.time_column)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        span = batch.agg(
            F.count("*").alias("rows"),
            F.min(time).cast("string").alias("low"),
            F.max(time).cast("string").alias("high"),
            F.collect_set("trade_date").alias("dates"),
        ).first()
        if span["rows"] == 0:
            return
        low, high = F.lit(span["low"]).cast("timestamp"), F.lit(span["high"]).cast("timestamp")
        stored = stored_rows(span["low"], span["high"])
        stored = stored.where(time.between(low, high) & F.col("trade_date").isin(span["dates"]))
        insert(batch.join(stored.select(*layout.keys), list(layout.keys), "left_anti"))
    finally:
        batch.unpersist()


def checkpoint_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave to a query when it made the checkpoint; it survives restarts."""
    metadata = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(metadata)["id"]


def stream_writer(df: DataFrame, checkpoint: str, query_name: str, trigger: dict | None = None) -> DataStreamWriter:
    """Append mode, own checkpoint, own name: what every sink of the flow shares."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).queryName(query_name)
    return writer.trigger(**trigger) if trigger else writer


def start_table_stream(
    df: DataFrame,
    target: str,
    layout: Layout,
    checkpoint: str,
    query_name: str,
    trigger: dict | None = None,
    writers_per_partition: int = WRITERS_PER_PARTITION,
) -> StreamingQuery:
    """Append a stream to a table, each row once.

    A path gets Spark's own Parquet sink, whose commit log makes a replayed
    batch a no-op. A catalog table gets idempotent micro-batch appends.
    """
    df = df.select(*layout.columns)
    if is_path(target):
        files = stream_writer(distribute(df, layout, writers_per_partition), checkpoint, query_name, trigger)
        return files.format("parquet").partitionBy(*layout.partition_by).start(target)
    return start_batch_stream(df, target, layout, checkpoint, query_name, trigger, writers_per_partition)


def start_batch_stream(
    df: DataFrame,
    target: str,
    layout: Layout,
    checkpoint: str,
    query_name: str,
    trigger: dict | None = None,
    writers_per_partition: int = WRITERS_PER_PARTITION,
) -> StreamingQuery:
    """Append a stream by idempotent micro-batches, to a path or a catalog table."""

    def append(batch: DataFrame, batch_id: int) -> None:
        query_id = checkpoint_identity(batch.sparkSession, checkpoint)
        append_batch(batch, batch_id, target, layout, query_id, writers_per_partition)

    return stream_writer(df, checkpoint, query_name, trigger).foreachBatch(append).start()
