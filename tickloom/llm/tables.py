"""The tables the operators run on, read by Spark alone, and the folder for written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.session import prepare_session, scratch_dir

# Rows that travel to a Python task at once. Texts are kilobytes, so Spark's default would hold many megabytes.
ROWS_PER_BATCH = "1000"
# Nor more bytes than this, unless one row has them: rows that stand for a task's whole findings have many.
BYTES_PER_BATCH = str(4 << 20)


def prepare(spark: SparkSession) -> SparkSession:
    """The session options of the flow, and smaller batches for rows that carry texts or packed findings."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
    return prepare_session(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and no executor is needed to read it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def quoted(name: str) -> str:
    """A column's name as ``F.col`` takes it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
