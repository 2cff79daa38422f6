"""One pass over a feed keeps the raw table, its windows and the late trades.

The query has no state of its own: what a micro-batch has to know of earlier ones
is in small *marks*, one per batch, and in the tail of the raw table. A batch writes
a *part* of every table, named after it, and its mark last. A batch that is run
again after a failure, wherever that was, sees the mark before it and replaces its
own parts, so nothing is lost or doubled in any of the tables.

* ``raw``: trades that were neither late nor there yet.
* ``partials``: mergeable metrics per symbol and window of the rows in ``raw``.
* ``late``: trades at or behind the watermark, kept until ``apply_late`` adds them.
* ``files``: what each file of ``raw`` holds (``streaming.file_index``).
* ``marks``: watermark, and which parts still hold rows ahead of it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import ONE_PASS_QUERY, WINDOW_WIDTH, TradeFlow
from tickloom.operators import clean_trades, deduplicate
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT
from tickloom.session import children
from tickloom.streaming.file_index import write_indexed
from tickloom.streaming.tables import arrange, checkpoint_identity, stream_writer

PARTIAL_SCHEMA = (
    "symbol string, window_start timestamp, window_end timestamp, price_sum double, min_price double, max_price double, "
    "volume_sum decimal(38,0), trade_count bigint, trade_date date"
)
MARK_SCHEMA = "query_id string, watermark bigint, tail array<struct<part: string, newest: bigint>>"


@dataclass(frozen=True)
class OnePassTables:
    """The tables under one root. The root belongs to one query and its checkpoint."""

    root: str

    def folder(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def raw(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(RAW_LAYOUT.schema).parquet(self.folder("raw")).select(*RAW_LAYOUT.columns)

    def late(self, spark: SparkSession) -> DataFrame:
        """All trades that came late, the applied ones included, with the ``part`` that brought them."""
        return _part_table(spark, self.folder("late"), f"{_ddl(RAW_LAYOUT.schema)}, part string")

    def windows(self, spark: SparkSession) -> DataFrame:
        """The aggregate table: all partials of a window merged."""
        return merged_windows(_part_table(spark, self.folder("partials"), PARTIAL_SCHEMA))


def _ddl(schema) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)


def _part_table(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A table of parts; one without any part yet is empty."""
    if not children(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def part_name(batch_id: int, late: bool = False) -> str:
    """Names that sort like the batches."""
    return f"{'late' if late else 'batch'}-{batch_id:012d}"


def window_partials(trades: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """Per symbol and window what can be merged with the same of other trades.

    Volumes are summed as decimals, so a total beyond the bigint range comes out as such after any merge.
    """
    windows = trades.groupBy("symbol", F.window("trade_timestamp", width).alias("window")).agg(
        F.sum("price").alias("price_sum"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum(F.col("volume").cast("decimal(28,0)")).cast("decimal(38,0)").alias("volume_sum"),
        F.count("*").alias("trade_count"),
    )
    metrics = ("price_sum", "min_price", "max_price", "volume_sum", "trade_count")
    return windows.selectExpr(
        "symbol", "window.start AS window_start", "window.end AS window_end", *metrics, "to_date(window.start) AS trade_date"
    )


def merged_windows(partials: DataFrame) -> DataFrame:
    """The rows of the aggregate table from all partials of their windows."""
    merged = partials.groupBy("symbol", "window_start", "window_end", "trade_date").agg(
        F.sum("price_sum").alias("price_sum"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.sum("volume_sum").alias("volume_sum"),
        F.sum("trade_count").alias("trade_count"),
    )
    return merged.withColumns(
        {"avg_price": F.col("price_sum") / F.col("trade_count"), "total_volume": F.expr("try_cast(volume_sum AS bigint)")}
    ).select(*AGGREGATED_LAYOUT.columns)


def _replace(df: DataFrame, path: str) -> None:
    """One writer per date: a micro-batch has few of them, and one row per symbol and window."""
    df.repartition("trade_date").write.mode("overwrite").partitionBy("trade_date").parquet(path)


def _keys(spark: SparkSession, tables: OnePassTables, parts: list[str]) -> DataFrame:
    paths = [f"{tables.folder('raw')}/part={part}" for part in parts]
    stored = spark.read.schema(RAW_LAYOUT.schema)
    rows = stored.parquet(*paths) if paths else spark.createDataFrame([], RAW_LAYOUT.schema)
    return rows.select(*RAW_LAYOUT.keys)


def _read_mark(spark: SparkSession, tables: OnePassTables, query_id: str, batch_id: int) -> tuple[int | None, list]:
    """Watermark and tail before a batch."""
    if batch_id == 0:
        others = [name for name in children(spark, tables.folder("marks")) if name != query_id]
        if others:
            raise ValueError(f"{tables.root} belongs to the query {others[0]}; a new checkpoint needs a new root")
        return None, []
    path = f"{tables.folder('marks')}/{query_id}/{part_name(batch_id - 1)}"
    mark = spark.read.schema(MARK_SCHEMA).json(path).first()
    return mark["watermark"], [(row["part"], row["newest"]) for row in mark["tail"]]


def _write_part(trades: DataFrame, tables: OnePassTables, part: str, flow: TradeFlow, done: Callable[[str], None]) -> None:
    """A part of the raw table and, from what was stored of it, the part of the windows."""
    spark = trades.sparkSession
    folder = f"{tables.folder('raw')}/part={part}"
    rows = arrange(trades, RAW_LAYOUT, flow.writers_per_partition)
    write_indexed(rows, folder, f"{tables.folder('files')}/part={part}", RAW_LAYOUT)
    done("raw")
    stored = spark.read.schema(RAW_LAYOUT.schema).parquet(folder)
    _replace(window_partials(stored, flow.window_width), f"{tables.folder('partials')}/part={part}")
    done("partials")


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    query_id: str,
    tables: OnePassTables,
    flow: TradeFlow,
    done: Callable[[str], None] = lambda sink: None,
) -> None:
    """Bring one micro-batch of decoded trades into all tables.

    The batch is cleaned once and kept for all sinks. A trade at or behind the
    watermark (the newest event time of earlier batches less the delay) is late. The others can
    only be copies of rows ahead of the watermark, so they are compared with the
    parts that still have such rows: what is read of the raw table follows from
    the delay and not from the table's size.
    """
    spark = batch.sparkSession
    watermark, tail = _read_mark(spark, tables, query_id, batch_id)
    part = part_name(batch_id)
    trades = clean_trades(batch, max_ahead=flow.max_ahead)
    trades = deduplicate(trades).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        delayed = f"unix_micros(max(trade_timestamp) - interval {flow.watermark_delay})"
        ends = trades.agg(F.expr("unix_micros(max(trade_timestamp))").alias("newest"), F.expr(delayed).alias("mark")).first()
        on_time = trades
        if watermark is not None:
            ahead = F.col("trade_timestamp") > F.timestamp_micros(F.lit(watermark))
            # Two trades of one key have one time, so both are on the same side.
            _replace(trades.where(~ahead), f"{tables.folder('late')}/part={part}")
            done("late")
            stored = _keys(spark, tables, [name for name, _ in tail])
            on_time = trades.where(ahead).join(stored.where(ahead), list(RAW_LAYOUT.keys), "left_anti")
        _write_part(on_time, tables, part, flow, done)
        if ends["newest"] is not None:
            watermark = max(ends["mark"], watermark) if watermark is not None else ends["mark"]
            tail = [*tail, (part, ends["newest"])]
        mark = {
            "query_id": query_id,
            "watermark": watermark,
            "tail": [{"part": name, "newest": newest} for name, newest in tail if newest > watermark],
        }
        marks = f"{tables.folder('marks')}/{query_id}/{part}"
        spark.createDataFrame([(json.dumps(mark),)], "value string").coalesce(1).write.mode("overwrite").text(marks)
        done("marks")
    finally:
        trades.unpersist()


def start_one_pass(
    wire: DataFrame, tables: OnePassTables, flow: TradeFlow, done: Callable[[str, int], None] = lambda sink, batch_id: None
) -> StreamingQuery:
    """One query from a stream of decoded trades to all tables; ``done`` is told each sink's last batch.

    The source is read once, other than by one query per table. Rows without event time have no place here.
    """
    if flow.keep_null_event_time:
        raise ValueError("rows without event time cannot be told late or in time")
    checkpoint = flow.checkpoint("one_pass")

    def apply(batch: DataFrame, batch_id: int) -> None:
        query_id = checkpoint_identity(batch.sparkSession, checkpoint)
        apply_batch(batch, batch_id, query_id, tables, flow, lambda sink: done(sink, batch_id))

    return stream_writer(wire, checkpoint, ONE_PASS_QUERY, flow.trigger).foreachBatch(apply).start()


def apply_late(spark: SparkSession, tables: OnePassTables, flow: TradeFlow) -> list[date]:
    """Add the late trades that are not applied yet to the raw table and the windows; their dates.

    They become a part of their own, named after the last batch that brought any.
    Copies of stored trades are left out; the comparison reads the keys of the affected dates only. A
    job that failed is run again and replaces that part. The stream may go on
    meanwhile: it looks at rows ahead of the watermark, this at those behind it.
    """
    late = tables.late(spark)
    # Parts are named in the order of batches; the names are listed, no file is opened.
    brought = [name.removeprefix("part=") for name in children(spark, tables.folder("late"))]
    # The mark of the applied parts is written last, like that of a batch.
    applied = max(children(spark, tables.folder("late_marks")), default="")
    fresh = sorted(part for part in brought if part > applied)
    if not fresh:
        return []
    part = fresh[-1].replace("batch", "late")
    rows = deduplicate(late.where(F.col("part").isin(fresh)).drop("part")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dates = sorted(row[0] for row in rows.select("trade_date").distinct().collect())
        if dates:
            raw = spark.read.schema(f"{_ddl(RAW_LAYOUT.schema)}, part string").parquet(tables.folder("raw"))
            stored = raw.where(F.col("trade_date").isin(dates) & (F.col("part") != part)).select(*RAW_LAYOUT.keys)
            _write_part(rows.join(stored, list(RAW_LAYOUT.keys), "left_anti"), tables, part, flow, lambda sink: None)
    finally:
        rows.unpersist()
    spark.range(1).coalesce(1).write.mode("overwrite").json(f"{tables.folder('late_marks')}/{fresh[-1]}")
    return dates


def publish_windows(spark: SparkSession, tables: OnePassTables, path: str, dates: list[date] | None = None) -> None:
    """Write the windows as the aggregate table under ``path``; of given dates only these are recomputed and replaced."""
    windows = tables.windows(spark)
    if dates is not None:
        windows = windows.where(F.col("trade_date").isin(dates))
    rows = arrange(windows, AGGREGATED_LAYOUT)
    by = AGGREGATED_LAYOUT.partition_by
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
