"""Connector options. The Kafka and database drivers are not installed here, so nothing is sent."""

import subprocess
import sys
import time
from pathlib import Path

import duckdb
import pytest
from helpers import trade, wire_rows

from tickloom import session as session_module
from tickloom.config import JdbcTarget, KafkaSink, KafkaSource, TradeFlow
from tickloom.operators import clean_and_deduplicate
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT
from tickloom.session import scratch_dir
from tickloom.sources import kafka_source_options, read_wire_stream
from tickloom.streaming import kafka_sink_options
from tickloom.streaming.jdbc import append_jdbc_batch, read_options, serving_ddl, write_options


def test_kafka_source_options():
    assert kafka_source_options(KafkaSource("b:9092")) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "stock_trades",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5000",
    }
    other = kafka_source_options(
        KafkaSource("b", "t", "earliest", True, max_offsets_per_trigger=None, min_partitions=400)
    )
    assert "maxOffsetsPerTrigger" not in other
    assert (other["failOnDataLoss"], other["minPartitions"], other["startingOffsets"]) == ("true", "400", "earliest")


def test_kafka_sink_options():
    assert kafka_sink_options(KafkaSink("b:9092")) == {
        "kafka.bootstrap.servers": "b:9092",
        "topic": "stock_trades",
        "kafka.client.id": "stock-trade-producer",
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.retries": "10",
        "kafka.linger.ms": "100",
        "kafka.compression.type": "snappy",
    }


def test_missing_connector_is_named(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_wire_stream(spark, KafkaSource("b:9092"))


def test_jdbc_options():
    target = JdbcTarget.postgres("db", 5432, "analytics", "me", "secret", connections=3)
    assert target.url == "jdbc:postgresql://db:5432/analytics"
    assert "secret" not in repr(target)
    assert write_options(target, "raw_trades") == {
        "url": target.url, "dbtable": "raw_trades", "driver": "org.postgresql.Driver",
        "user": "me", "password": "secret", "numPartitions": "3", "batchsize": "10000",
    }
    read = read_options(target, "raw_trades", RAW_LAYOUT, "2026-05-05 10:00:00", "2026-05-05 11:00:00")
    assert (read["partitionColumn"], read["numPartitions"]) == ("trade_timestamp", "3")
    assert "partitionColumn" not in read_options(target, "raw_trades", RAW_LAYOUT, "x", "x")


@pytest.mark.parametrize(("table", "layout"), [("raw_trades", RAW_LAYOUT), ("aggregated_trades_1m", AGGREGATED_LAYOUT)])
def test_serving_tables(table, layout):
    con = duckdb.connect()
    for _ in range(2):
        con.execute(serving_ddl(table, layout))
    columns = con.execute(f"DESCRIBE {table}").fetchall()
    assert [column[0] for column in columns] == layout.columns
    assert {column[0] for column in columns if column[2] == "YES"} == {"source", "total_volume"} & set(layout.columns)


def test_empty_jdbc_batch_opens_no_connection(spark):
    target = JdbcTarget.postgres("nowhere", 1, "none", "me", "secret")
    append_jdbc_batch(clean_and_deduplicate(wire_rows(spark, trade(price="0"))), target, "raw_trades", RAW_LAYOUT)


def test_checkpoints_are_per_table():
    flow = TradeFlow("/shared/checkpoints/")
    assert flow.checkpoint("a") == "/shared/checkpoints/a"
    assert (flow.watermark_delay, flow.window_width) == ("2 minutes", "1 minute")


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(shared) and one != two


class FakeSession:
    """Just enough of a session to ask for a scratch folder."""

    def __init__(self, master, folder=None):
        self.applicationId = master
        self.sparkContext = self.conf = self
        self.folder = folder

    def get(self, key, default=None):
        return "hdfs://lake/warehouse" if key == "spark.sql.warehouse.dir" else default

    def getCheckpointDir(self):
        return self.folder


def test_scratch_without_a_shared_folder(monkeypatch):
    made = []
    monkeypatch.setattr(session_module, "make_until_exit", lambda spark, folder: made.append(folder))
    assert scratch_dir(FakeSession("spark://host:7077", "hdfs://shared/"), "x").startswith("hdfs://shared/tickloom-spark://host:7077/x-")
    for master in ("local[2]", "spark://host:7077"):
        for _ in range(2):
            assert scratch_dir(FakeSession(master), "x").startswith(f"hdfs://lake/warehouse/_scratch/tickloom-{master}/x-")
    assert len(made) == 3


def test_scratch_goes_with_the_driver(tmp_path):
    """In a driver of its own: the folder is there while it runs and gone after it."""
    code = (
        "from pyspark.sql import SparkSession; from tickloom.session import scratch_dir; import os\n"
        f"spark = SparkSession.builder.master('local[1]').config('spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
        "path = scratch_dir(spark, 'x'); spark.range(3).write.parquet(path)\n"
        "assert os.path.isdir(path) and spark.read.parquet(path).count() == 3"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=Path(__file__).resolve().parents[1])
    # Spark's process ends a little after Python's.
    until = time.monotonic() + 30
    while list(tmp_path.glob("tickloom-*")) and time.monotonic() < until:
        time.sleep(0.2)
    assert not list(tmp_path.glob("tickloom-*"))
