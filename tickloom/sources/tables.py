"""Reading the stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schema import Layout


def read_table(spark: SparkSession, target: str, layout: Layout) -> DataFrame:
    """A stored table, by catalog name (``catalog.namespace.table``) or by path.

    The schema is given rather than inferred: an empty table still reads, and
    partition values such as the symbol ``"123"`` keep their type.
    """
    if is_path(target):
        return spark.read.schema(layout.schema).parquet(target).select(*layout.columns)
    return spark.table(target).select(*layout.columns)


def is_path(target: str) -> bool:
    return "/" in target


def time_range(
    df: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    time_column: str = "trade_timestamp",
    date_column: str = "trade_date",
) -> DataFrame:
    """Rows with ``start <= time < end``.

    The bounds are put on the date as well, because tables are partitioned by
    it: a predicate on the time alone reads every partition.
    """
    if start is not None:
        df = df.where((F.col(time_column) >= _moment(start)) & (F.col(date_column) >= F.to_date(_moment(start))))
    if end is not None:
        df = df.where((F.col(time_column) < _moment(end)) & (F.col(date_column) <= F.to_date(_moment(end))))
    return df


def _moment(value: str | datetime) -> Column:
    text = value.isoformat() if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp")
