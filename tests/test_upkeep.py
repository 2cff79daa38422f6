"""Earliest copies in streams, incremental summary, hash trees, state and file index."""

import datetime as dt
import random

import pytest
from helpers import plan_of, trade, tuples, wire_rows
from pyspark.sql import functions as F

from tickloom.config import AGGREGATED_TABLE, TradeFlow
from tickloom.operators import (
    aggregate_windows,
    clean_and_deduplicate,
    differing_rows,
    latest_trades,
    leaves,
    symbol_summary,
    tree_differences,
    unequal_nodes,
)
from tickloom.operators.hash_tree import nodes
from tickloom.plans import start_aggregated, start_raw, upkeep_queries
from tickloom.schema import AGGREGATED_LAYOUT, AGGREGATED_SCHEMA, RAW_LAYOUT
from tickloom.session import children
from tickloom.sources import read_table, read_wire_files
from tickloom.streaming import account, files_for, latest_indexed, open_windows, read_index, read_summary, stateful_operators, write_indexed
from tickloom.streaming.file_index import newest_files, read_files
from tickloom.streaming.summary import merge_batch

COLUMNS = ["symbol", "price", "volume", "trade_timestamp", "source"]


def feed(spark, tmp_path, *rows):
    wire_rows(spark, *rows).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("append").text(f"{tmp_path}/feed")
    return read_wire_files(spark, f"{tmp_path}/feed", 1)


# --- earliest copies ------------------------------------------------------------------


@pytest.mark.parametrize("earliest, price", [(True, 1.0), (False, 3.0)])
def test_which_copy_a_stream_keeps(spark, tmp_path, earliest, price):
    flow = TradeFlow(f"{tmp_path}/checkpoints", trigger={"availableNow": True}, earliest_copy=earliest)
    copies = [trade(price=p, arrived=at) for p, at in (("3", "10:00:09"), ("1", "10:00:01"), ("2", "10:00:05"))]
    for row in (*copies, trade("MSFT", at="10:04:00")):
        stream = feed(spark, tmp_path, row)
    start_raw(stream, f"{tmp_path}/raw", flow).awaitTermination()
    rows = read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).where("symbol = 'AAPL'").collect()
    assert [r.price for r in rows] == [price]
    # The next trade is passed on at once, or held until the watermark reaches it.
    assert read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).count() == (1 if earliest else 2)


def test_earliest_copies_feed_the_windows(spark, tmp_path):
    flow = TradeFlow(f"{tmp_path}/checkpoints", trigger={"availableNow": True}, earliest_copy=True)
    rows = [trade(price="3", arrived="10:00:09"), trade(price="1"), trade(price="5", at="10:00:20"), trade(at="10:09:00")]
    for row in rows:
        stream = feed(spark, tmp_path, row)
    start_aggregated(stream, f"{tmp_path}/aggregated", flow).awaitTermination()
    windows = read_table(spark, f"{tmp_path}/aggregated", AGGREGATED_LAYOUT).collect()
    assert [(w.avg_price, w.trade_count) for w in windows] == [(3.0, 2)]


# --- summary --------------------------------------------------------------------------


def windows_of(spark, *rows):
    return aggregate_windows(clean_and_deduplicate(wire_rows(spark, *rows)))


def test_summary_by_batches(spark, tmp_path):
    batches = [
        windows_of(spark, trade(price="10"), trade(price="14", at="10:01:00"), trade("MSFT", price="3")),
        windows_of(spark, trade(price="30", at="10:02:00", volume="7")),
        windows_of(spark).limit(0),
        windows_of(spark, trade("IBM", price="1", at="10:03:00"), trade(price="2", at="10:04:00")),
        windows_of(spark, trade("MSFT", price="9", at="10:05:00")),
    ]
    whole = batches[0]
    for number, batch in enumerate(batches):
        for _ in range(1 + number % 2):
            merge_batch(batch, number, str(tmp_path), "q")
        whole = whole.unionByName(batch) if number else whole
        assert tuples(read_summary(spark, str(tmp_path), "q")) == tuples(symbol_summary(whole))
    assert len(children(spark, f"{tmp_path}/query_id=q")) == 3
    assert read_summary(spark, str(tmp_path), "none").count() == 0


def test_summary_of_totals_beyond_bigint(spark, tmp_path):
    def window(minute, volume):
        start = dt.datetime(2026, 5, 5, 10, minute)
        return ("A", start, start + dt.timedelta(minutes=1), 1.0, 1.0, 1.0, volume, 1, start.date())

    first = spark.createDataFrame([window(0, 2**63 - 1), window(1, None)], AGGREGATED_SCHEMA)
    second = spark.createDataFrame([window(2, 5)], AGGREGATED_SCHEMA)
    merge_batch(first, 0, str(tmp_path), "q")
    assert read_summary(spark, str(tmp_path), "q").first().total_volume == 2**63 - 1
    merge_batch(second, 1, str(tmp_path), "q")
    assert read_summary(spark, str(tmp_path), "q").first().total_volume is None
    assert symbol_summary(first.unionByName(second)).first().total_volume is None


# --- tree of hashes -------------------------------------------------------------------


def table(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [trade(rng.choice(["A", "B"]), str(i + 1), str(i), f"{rng.randrange(8, 12):02d}:{rng.randrange(60):02d}:{i % 60:02d}.{i:06d}") for i in range(n)]
    return clean_and_deduplicate(wire_rows(spark, *rows))


def test_equal_tables_have_equal_trees(spark):
    rows = table(spark).cache()
    one, other = leaves(rows, COLUMNS), leaves(rows.orderBy("price").repartition(7), COLUMNS)
    assert tree_differences(one, other).count() == 0
    # Parents are sums of their children, taken directly or level by level.
    direct = rows.withColumn("trade_timestamp", F.date_trunc("day", "trade_timestamp"))
    assert nodes(one, "day").agg(F.sum("row_count")).first()[0] == direct.count()


def test_planted_changes_are_found_where_counts_are_equal(spark):
    rows = table(spark).cache()
    changed = rows.withColumn("price", F.expr("if(volume = 17, price + 1e-9, price)")).withColumn(
        "source", F.expr("if(volume = 30, null, source)")
    )
    # One trade goes and one comes in the same minute, so its count stays.
    gone = changed.where("volume <> 44").unionByName(
        changed.where("volume = 44").withColumn("trade_timestamp", F.expr("trade_timestamp + interval 1 microsecond"))
    )
    one, other = leaves(rows, COLUMNS).cache(), leaves(gone, COLUMNS).cache()
    assert one.join(other, ["day", "hour", "minute", "row_count"], "full_outer").where(one.hash_a.isNull() | other.hash_a.isNull()).count() == 0
    found = tree_differences(one, other)
    minute = F.date_trunc("minute", "trade_timestamp")
    assert {r.minute for r in found.collect()} == {r[0] for r in rows.where("volume in (17, 30, 44)").select(minute).collect()}
    got = differing_rows(rows, gone, found, RAW_LAYOUT.keys, COLUMNS).groupBy("change").count().collect()
    assert {r.change: r["count"] for r in got} == {"changed": 2, "removed": 1, "added": 1}


def test_repeated_rows_and_missing_nodes(spark):
    rows = table(spark, 50).cache()
    first = rows.where("volume = 3")
    doubled = rows.unionByName(first).unionByName(first)
    found = tree_differences(leaves(rows, COLUMNS), leaves(doubled, COLUMNS)).collect()
    assert len(found) == 1 and found[0].other_row_count - found[0].row_count == 2
    hours = unequal_nodes(leaves(rows, COLUMNS), leaves(rows.where("hour(trade_timestamp) <> 9"), COLUMNS), "hour").collect()
    assert [(r.hour.hour, r.other_row_count) for r in hours] == [(9, 0)]
    without_time = rows.withColumn("trade_timestamp", F.lit(None).cast("timestamp"))
    assert tree_differences(leaves(without_time, COLUMNS), leaves(without_time, COLUMNS)).count() == 0
    assert tree_differences(leaves(rows.limit(0), COLUMNS), leaves(rows.limit(0), COLUMNS)).count() == 0


def test_leaves_are_combined_before_the_shuffle(spark):
    plan = plan_of(leaves(table(spark, 10), COLUMNS))
    assert "partial_sum" in plan and "PythonUDF" not in plan


# --- state ----------------------------------------------------------------------------


def test_open_windows_explain_the_rest(spark, tmp_path):
    flow = TradeFlow(f"{tmp_path}/checkpoints", trigger={"availableNow": True})
    rows = [trade(price="10", volume="4"), trade(price="20", at="10:00:59"), trade("B", at="10:09:00"), trade(price="7", at="10:10:30", volume="9223372036854775807"), trade(price="9", at="10:10:31", volume="1")]
    stream = feed(spark, tmp_path, *rows)
    start_aggregated(stream, f"{tmp_path}/aggregated", flow).awaitTermination()
    checkpoint = flow.checkpoint(AGGREGATED_TABLE)
    names = {r.operatorName for r in stateful_operators(spark, checkpoint).collect()}
    assert {"stateStoreSave", "dedupe"} <= names
    batch = aggregate_windows(clean_and_deduplicate(wire_rows(spark, *rows)))
    stored = read_table(spark, f"{tmp_path}/aggregated", AGGREGATED_LAYOUT)
    held = open_windows(spark, checkpoint)
    assert held.columns == AGGREGATED_LAYOUT.columns and held.count() == 2 and stored.count() == 1
    assert tuples(held.unionByName(stored)) == tuples(batch)
    left = account(clean_and_deduplicate(wire_rows(spark, *rows)), stored, held)
    assert sorted(tuple(r) for r in left.collect()) == [("AAPL", 4, 2, 2, 0), ("B", 1, 0, 1, 0)]


def test_state_of_another_kind_is_refused(spark, tmp_path):
    flow = TradeFlow(f"{tmp_path}/checkpoints", trigger={"availableNow": True})
    start_raw(feed(spark, tmp_path, trade()), f"{tmp_path}/raw", flow).awaitTermination()
    with pytest.raises(ValueError, match="no operator"):
        open_windows(spark, flow.checkpoint("raw_stream_data"))


# --- file index -----------------------------------------------------------------------


def indexed(spark, tmp_path, days=6, per_day=30):
    day = F.expr(f"timestamp'2026-05-01 10:00:00' + make_dt_interval(cast(id % {days} AS int), 0, cast(id AS int) % 50, id / 1000)")
    rows = spark.range(days * per_day).select(
        F.expr("concat('S', id % 3)").alias("symbol"), F.col("id").cast("double").alias("price"), F.lit(1).cast("bigint").alias("volume"),
        day.alias("trade_timestamp"), day.alias("ingestion_timestamp"), F.lit("x").alias("source"),
    ).withColumn("trade_date", F.to_date("trade_timestamp"))
    write_indexed(rows.repartition(2), f"{tmp_path}/raw", f"{tmp_path}/files", RAW_LAYOUT)
    return rows


@pytest.mark.parametrize("count", [1, 20, 45, 1000])
def test_newest_rows_by_the_index(spark, tmp_path, count):
    rows = indexed(spark, tmp_path)
    got = latest_indexed(spark, f"{tmp_path}/raw", f"{tmp_path}/files", count, RAW_LAYOUT)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in latest_trades(rows, count).collect()]


def test_a_damaged_old_file_is_not_opened(spark, tmp_path):
    rows = indexed(spark, tmp_path)
    for file in (tmp_path / "raw").glob("trade_date=2026-05-01/*/*.parquet"):
        file.write_bytes(b"no parquet")
    for crc in (tmp_path / "raw").glob("trade_date=2026-05-01/*/.*.crc"):
        crc.unlink()
    got = latest_indexed(spark, f"{tmp_path}/raw", f"{tmp_path}/files", 20, RAW_LAYOUT)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in latest_trades(rows, 20).collect()]


def test_files_of_a_symbol_and_a_span(spark, tmp_path):
    rows = indexed(spark, tmp_path)
    index = read_index(spark, f"{tmp_path}/files")
    files = files_for(index, "S1", "2026-05-02T10:00:00", "2026-05-02T10:20:00")
    assert files and all("trade_date=2026-05-02/symbol=S1" in file for file in files)
    span = "symbol = 'S1' and trade_timestamp >= '2026-05-02 10:00:00' and trade_timestamp < '2026-05-02 10:20:00'"
    assert tuples(read_files(spark, f"{tmp_path}/raw", files, RAW_LAYOUT).where(span)) == tuples(rows.where(span))
    assert files_for(index, "S1", "2027-01-01", "2027-01-02") == []
    assert newest_files(index.limit(0), 5) == []


def test_a_wave_is_dealt_to_files_as_events(spark, small, monkeypatch):
    """Messages are several times as large as their events, and are not exchanged; a wave has as many files as cores if it is large."""
    sent, send = [], upkeep_queries._send
    monkeypatch.setattr(upkeep_queries, "_send", lambda messages, path: sent.append((plan_of(messages), messages.rdd.getNumPartitions())) or send(messages, path))
    monkeypatch.setattr(upkeep_queries, "FILE_MESSAGES", 1)
    assert upkeep_queries.stream_dedup_earliest(spark, small).count() > 0
    waves = sent[:-1]
    assert len(waves) == 10 and {files for _, files in waves} == {spark.sparkContext.defaultParallelism}
    assert all(plan.count("Exchange") == 1 and "RoundRobin" not in plan for plan, _ in waves)
