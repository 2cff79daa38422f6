"""What the state of a stopped query holds, read with Spark's state data sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schema import AGGREGATED_LAYOUT

# The names that Spark gives to its stateful operators.
AGGREGATE, DEDUPLICATE = "stateStoreSave", "dedupe"


def stateful_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``operatorId, operatorName, ...``: the stateful operators of a query, and the batches their state covers."""
    return spark.read.format("state-metadata").load(checkpoint)


def operator_id(spark: SparkSession, checkpoint: str, name: str) -> int:
    """The id of the query's operator of this name; of several, of the one that comes last in the plan."""
    ids = [row[0] for row in stateful_operators(spark, checkpoint).where(F.col("operatorName") == name).select("operatorId").collect()]
    if not ids:
        raise ValueError(f"no operator {name!r} with state under {checkpoint}")
    return min(ids)


def read_state(spark: SparkSession, checkpoint: str, operator: str) -> DataFrame:
    """``partition_id, key, value`` of an operator's state after the last finished batch."""
    return spark.read.format("statestore").option("operatorId", operator_id(spark, checkpoint, operator)).load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a stopped aggregate query still holds, as rows of the aggregate table.

    The value of the state is the row of partial results: sum and number of prices,
    least and greatest price, the total volume (NULL beyond the bigint range) and whether it has none yet, number of trades.
    """
    state = read_state(spark, checkpoint, AGGREGATE)
    parts = state.schema["value"].dataType.fields
    names = ["price_sum", "price_count", "min_price", "max_price", "total_volume", "no_volume", "trade_count"]
    if len(parts) != len(names):
        raise ValueError(f"the state under {checkpoint} is not that of the window metrics: {[part.name for part in parts]}")
    # Spark's own names may repeat; a cast gives the fields names by their place.
    renamed = ", ".join(f"{name}: {part.dataType.simpleString()}" for name, part in zip(names, parts, strict=True))
    symbol, window = [field.name for field in state.schema["key"].dataType.fields]
    return state.select(
        F.col("key").getField(symbol).alias("symbol"),
        F.col("key").getField(window).alias("window"),
        F.col("value").cast(f"struct<{renamed}>").alias("value"),
    ).selectExpr(
        "symbol",
        "window.start AS window_start",
        "window.end AS window_end",
        "value.price_sum / value.price_count AS avg_price",
        "value.min_price",
        "value.max_price",
        "value.total_volume",
        "value.trade_count",
        "to_date(window.start) AS trade_date",
    ).select(*AGGREGATED_LAYOUT.columns)


def account(trades: DataFrame, windows: DataFrame, open_: DataFrame) -> DataFrame:
    """Per symbol: trades in the raw table, in the stored windows and in the open ones, and what none of these explains."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("symbol").agg(F.sum("trade_count").alias(name))

    raw = trades.groupBy("symbol").agg(F.count("*").alias("raw_count"))
    names = ["raw_count", "stored_count", "open_count"]
    both = raw.join(counted(windows, names[1]), "symbol", "full_outer").join(counted(open_, names[2]), "symbol", "full_outer")
    return both.na.fill(0, names).withColumn("difference", F.expr("raw_count - stored_count - open_count"))
