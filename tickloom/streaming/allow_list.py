"""A list of subscribed symbols that may change while a stream runs.

The list is a table of versions; a new version is complete or not there. Every
micro-batch takes the newest one and notes which, so that a batch that is run again
after a failure lets through what it let through before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions import split_list
from tickloom.operators import allow_listed
from tickloom.schema import Layout
from tickloom.session import children
from tickloom.streaming.tables import append_batch, checkpoint_identity, stream_writer

LIST_SCHEMA = "symbol string"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The complete versions of a list, in order."""
    names = children(spark, f"{path}/versions")
    return [name for name in names if "_SUCCESS" in _all_children(spark, f"{path}/versions/{name}")]


def _all_children(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return [entry.getPath().getName() for entry in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]


def publish_list(symbols: DataFrame, path: str) -> str:
    """Write the symbols as the list's next version."""
    names = children(symbols.sparkSession, f"{path}/versions")
    version = f"{int(names[-1]) + 1 if names else 0:012d}"
    symbols.select("symbol").distinct().write.parquet(f"{path}/versions/{version}")
    return version


def symbols_of(texts: DataFrame, column: str = "symbols") -> DataFrame:
    """``' AAPL, MSFT,'`` in a column as rows ``symbol``."""
    return texts.select(F.explode(split_list(F.col(column))).alias("symbol")).distinct()


def read_list(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.schema(LIST_SCHEMA).parquet(f"{path}/versions/{version}")


def _version_of_batch(spark: SparkSession, path: str, query_id: str, batch_id: int) -> str | None:
    """The version that the batch noted when it ran first, else the newest; noted for another run."""
    folder = f"{path}/used/{query_id}"
    name = f"{batch_id:012d}"
    for noted in children(spark, folder):
        if noted.split("-")[0] == name:
            return noted.split("-")[1] or None
    newest = (versions(spark, path) or [""])[-1]
    files = spark._jvm.org.apache.hadoop.fs
    note = files.Path(f"{folder}/{name}-{newest}")
    note.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(note)
    return newest or None


def start_allowed(
    trades: DataFrame,
    list_path: str,
    target: str,
    layout: Layout,
    checkpoint: str,
    query_name: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the trades of listed symbols, by idempotent micro-batches; without a list nothing is let through."""

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = checkpoint_identity(spark, checkpoint)
        version = _version_of_batch(spark, list_path, query_id, batch_id)
        listed = read_list(spark, list_path, version) if version else spark.createDataFrame([], LIST_SCHEMA)
        append_batch(allow_listed(batch, listed), batch_id, target, layout, query_id)

    return stream_writer(trades, checkpoint, query_name, trigger).foreachBatch(append).start()
