"""Serving copies of the tables in a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import JdbcTarget
from tickloom.schema import Layout
from tickloom.streaming.tables import append_unseen, stream_writer


# How the serving tables spell the types.
SERVING_TYPES = {
    "string": "TEXT",
    "double": "DOUBLE PRECISION",
    "bigint": "BIGINT",
    "timestamp": "TIMESTAMPTZ",
    "date": "DATE",
}
# A total beyond the bigint range is NULL, in the stream and here.
OPTIONAL = {"source", "total_volume"}


def serving_ddl(table: str, layout: Layout) -> str:
    """``CREATE TABLE`` for the database, for whoever administers it; ``source`` and ``total_volume`` may be NULL.

    Without it Spark creates the table on the first append, all columns nullable.
    """
    columns = [
        f"{field.name} {SERVING_TYPES[field.dataType.simpleString()]}{'' if field.name in OPTIONAL else ' NOT NULL'}"
        for field in layout.schema
    ]
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def connection_options(target: JdbcTarget, table: str) -> dict[str, str]:
    return {
        "url": target.url,
        "dbtable": table,
        "driver": target.driver,
        "user": target.user,
        "password": target.password,
    }


def write_options(target: JdbcTarget, table: str) -> dict[str, str]:
    return {
        **connection_options(target, table),
        "numPartitions": str(target.connections),
        "batchsize": str(target.batch_size),
    }


def read_options(target: JdbcTarget, table: str, layout: Layout, low: str, high: str) -> dict[str, str]:
    """Read a time span over several connections, each taking a slice of it."""
    options = {**connection_options(target, table), "fetchsize": str(target.batch_size)}
    if low != high:
        options |= {
            "partitionColumn": layout.time_column,
            "lowerBound": low,
            "upperBound": high,
            "numPartitions": str(target.connections),
        }
    return options


def append_jdbc_batch(batch: DataFrame, target: JdbcTarget, table: str, layout: Layout) -> None:
    """Append the rows of a micro-batch that the serving table does not hold yet."""
    spark = batch.sparkSession

    def stored_rows(low: str, high: str) -> DataFrame:
        return spark.read.format("jdbc").options(**read_options(target, table, layout, low, high)).load()

    def insert(rows: DataFrame) -> None:
        options = write_options(target, table)
        rows.select(*layout.columns).write.format("jdbc").options(**options).mode("append").save()

    append_unseen(batch, layout, stored_rows, insert)


def start_jdbc_stream(
    df: DataFrame,
    target: JdbcTarget,
    table: str,
    layout: Layout,
    checkpoint: str,
    query_name: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    def append(batch: DataFrame, batch_id: int) -> None:
        append_jdbc_batch(batch, target, table, layout)

    return stream_writer(df.select(*layout.columns), checkpoint, query_name, trigger).foreachBatch(append).start()
