"""Rows and plans for the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schema import WIRE_SCHEMA


def wire_rows(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Wire trades: symbol, price, volume, trade time, arrival time[, source]."""
    full = [(*row, "feed") if len(row) == 5 else row for row in rows]
    return spark.createDataFrame(full, WIRE_SCHEMA)


def trade(symbol="AAPL", price="189.42", volume="10", at="10:00:00", arrived="10:00:01", source="feed"):
    day = "2026-05-05T"
    return symbol, price, volume, f"{day}{at}+00:00", f"{day}{arrived}+00:00", source


def messages(spark: SparkSession, *texts: str | None) -> DataFrame:
    return spark.createDataFrame([(text,) for text in texts], "value string")


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tuples(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=str)
