import random
import uuid
from pathlib import Path

import pytest
from helpers import plan_of, trade, tuples, wire_rows

from tickloom.operators import clean_and_deduplicate
from tickloom.plans import bootstrap, window_metrics
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT
from tickloom.sources import read_table, time_range
from tickloom.streaming import append_batch, compact, distribute, table_ddl, write_table
from tickloom.streaming.tables import arrange, in_session_catalog


def some_trades(spark, count=300, seed=1):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice(["AAPL", "MSFT", "123", "a/b=c"]), str(rng.randrange(1, 90)), str(rng.randrange(9)),
            f"2026-05-{rng.randrange(1, 6):02d}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00+00:00",
            "2026-05-06T00:00:00+00:00",
        )
        for _ in range(count)
    ]
    return clean_and_deduplicate(wire_rows(spark, *rows))


def test_iceberg_ddl():
    assert table_ddl("lake.stock.raw_stream_data", RAW_LAYOUT, "iceberg") == (
        "CREATE TABLE IF NOT EXISTS lake.stock.raw_stream_data (symbol string, price double, volume bigint, "
        "trade_timestamp timestamp, ingestion_timestamp timestamp, source string, trade_date date) USING iceberg "
        "PARTITIONED BY (days(trade_timestamp), symbol) "
        "TBLPROPERTIES ('format-version' = '2', 'write.distribution-mode' = 'hash')"
    )
    assert "PARTITIONED BY (days(window_start), symbol)" in table_ddl("t", AGGREGATED_LAYOUT, "iceberg")


def test_bootstrap_is_repeatable(spark):
    namespace = f"ns_{uuid.uuid4().hex}"
    for _ in range(2):
        raw, aggregated = bootstrap(spark, namespace, provider="parquet")
    assert (raw, aggregated) == (f"{namespace}.raw_stream_data", f"{namespace}.aggregated_data")
    assert sorted(spark.table(raw).columns) == sorted(RAW_LAYOUT.columns)
    assert read_table(spark, aggregated, AGGREGATED_LAYOUT).count() == 0


def test_written_tables_read_back_with_their_types(spark, tmp_path):
    trades = some_trades(spark)
    write_table(trades, f"{tmp_path}/raw", RAW_LAYOUT)
    back = read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT)
    assert back.schema == RAW_LAYOUT.schema
    assert tuples(back) == tuples(trades)


def test_time_range_prunes_partitions_and_row_groups(spark, tmp_path):
    trades = some_trades(spark)
    write_table(trades, f"{tmp_path}/raw", RAW_LAYOUT)
    stored = read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT)
    found = time_range(stored, "2026-05-02T06:00:00", "2026-05-04T00:00:00").where("symbol = '123'")
    plan = plan_of(found)
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "trade_date" in partition_filters and "symbol" in partition_filters
    assert "GreaterThanOrEqual(trade_timestamp" in plan
    expected = trades.where(
        "trade_timestamp >= '2026-05-02T06:00:00' and trade_timestamp < '2026-05-04' and symbol = '123'"
    )
    assert tuples(found) == tuples(expected)
    assert expected.count() > 0


def test_time_range_bounds(spark):
    import datetime as dt

    trades = some_trades(spark)
    noon = dt.datetime(2026, 5, 3, 12, tzinfo=dt.timezone.utc)
    before, after = time_range(trades, end=noon), time_range(trades, start=noon)
    assert before.count() + after.count() == trades.count()
    assert time_range(trades).count() == trades.count()
    windows = window_metrics(wire_rows(spark, trade()))
    assert time_range(windows, "2026-05-05", "2026-05-06", "window_start").count() == 1


def test_batch_writes_are_rebalanced_and_sorted_once(spark):
    plan = plan_of(arrange(some_trades(spark), RAW_LAYOUT))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert "trade_date" in plan.split("REBALANCE_PARTITIONS_BY_COL")[0].splitlines()[-1]


def test_hot_partition_is_split_when_written(spark, tmp_path):
    """A symbol that holds most rows of a day is written by more than one task."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "20000")
    try:
        hot = spark.range(0, 40_000, numPartitions=16).selectExpr(
            "'HOT' symbol", "rand(1) price", "id volume", "timestamp_seconds(1777975200 + id % 3600) trade_timestamp",
            "timestamp_seconds(1777980000) ingestion_timestamp", "'x' source", "date'2026-05-05' trade_date",
        )
        write_table(hot, f"{tmp_path}/raw", RAW_LAYOUT)
    finally:
        spark.conf.unset(key)
    assert len(list(Path(f"{tmp_path}/raw").rglob("*.parquet"))) > 1
    assert read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).count() == 40_000


@pytest.mark.parametrize("kind", ["path", "table"])
def test_appending_a_batch_again_changes_nothing(spark, tmp_path, kind):
    if kind == "path":
        target = f"{tmp_path}/raw"
    else:
        target, _ = bootstrap(spark, f"ns_{uuid.uuid4().hex}", provider="parquet")
    first, second = some_trades(spark, seed=1), some_trades(spark, seed=2)
    second = second.join(first.select("symbol", "trade_timestamp"), ["symbol", "trade_timestamp"], "left_anti")
    second = second.select(*RAW_LAYOUT.columns)
    for batch_id, batch in ((0, first), (1, second), (1, second), (0, first), (2, first.limit(0))):
        append_batch(batch, batch_id, target, RAW_LAYOUT, "q")
    assert tuples(read_table(spark, target, RAW_LAYOUT)) == tuples(first.unionByName(second))


def test_two_queries_with_the_same_batch_number_keep_their_rows(spark, tmp_path):
    first, second = some_trades(spark, seed=1), some_trades(spark, seed=2)
    append_batch(first, 0, f"{tmp_path}/raw", RAW_LAYOUT, "a")
    append_batch(second, 0, f"{tmp_path}/raw", RAW_LAYOUT, "b")
    append_batch(first.limit(0), 1, f"{tmp_path}/raw", RAW_LAYOUT, "a")
    assert tuples(read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT)) == tuples(first.unionByName(second))
    assert not list(Path(f"{tmp_path}/raw").rglob("batch_id=1"))


def test_compaction_replaces_only_its_dates_and_sorts(spark, tmp_path):
    trades = some_trades(spark)
    write_table(trades, f"{tmp_path}/closed", RAW_LAYOUT)
    for _ in range(2):
        compact(trades, f"{tmp_path}/closed", RAW_LAYOUT, "2026-05-02", "2026-05-03")
    assert tuples(read_table(spark, f"{tmp_path}/closed", RAW_LAYOUT)) == tuples(trades)
    folders = {path.parent for path in Path(f"{tmp_path}/closed").rglob("*.parquet") if "trade_date=2026-05-02" in str(path)}
    for folder in folders:
        (file,) = folder.glob("*.parquet")
        times = [r[0] for r in spark.read.parquet(str(file)).select("trade_timestamp").collect()]
        assert times == sorted(times)


def test_catalog_of_a_table_name(spark):
    assert in_session_catalog(spark, "ns.t") and in_session_catalog(spark, "spark_catalog.ns.t")
    assert not in_session_catalog(spark, "lake.ns.t")


def test_replayed_part_of_a_table_batch_is_completed(spark):
    target, _ = bootstrap(spark, f"ns_{uuid.uuid4().hex}", provider="parquet")
    batch = some_trades(spark)
    append_batch(batch.where("symbol = 'MSFT'"), 0, target, RAW_LAYOUT, "q")
    append_batch(batch, 0, target, RAW_LAYOUT, "q")
    assert tuples(read_table(spark, target, RAW_LAYOUT)) == tuples(batch)


def test_streams_spread_a_partition_over_writers(spark, small):
    from tickloom.plans.queries import wire_stream

    stream = clean_and_deduplicate(wire_stream(spark, small))
    spread = distribute(stream, RAW_LAYOUT, writers_per_partition=6)
    plan = spread._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression" in plan and "xxhash64(trade_timestamp" in plan
