import datetime as dt
import json
import uuid

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from tickloom.config import TradeFlow
from tickloom.operators import clean_and_deduplicate
from tickloom.plans import await_any, bootstrap, run_trade_flow, start_aggregated, start_raw, window_metrics
from tickloom.plans.event_feed import read_events, wire_messages
from tickloom.plans.queries import wire, wire_stream
from tickloom.schema import AGGREGATED_LAYOUT, RAW_LAYOUT
from tickloom.sources import decode_wire, read_table, read_wire_files
from tickloom.streaming import (
    ProgressLog,
    late_rows_dropped,
    progress_report,
    query_totals,
    start_batch_stream,
    start_table_stream,
)

ONCE = {"availableNow": True}
BASE = dt.datetime(2026, 5, 5, 10, tzinfo=dt.timezone.utc)


def flow(tmp_path, **more):
    return TradeFlow(f"{tmp_path}/checkpoints", trigger=ONCE, **more)


def send(spark, tmp_path, *trades):
    """One file of wire messages: (symbol, seconds after BASE, price)."""
    lines = []
    for symbol, second, price in trades:
        at = (BASE + dt.timedelta(seconds=second)).isoformat()
        lines.append(json.dumps({"symbol": symbol, "price": str(price), "volume": 1, "trade_timestamp": at,
                                 "ingestion_timestamp": at, "source": "x"}))
    folder = tmp_path / "feed"
    folder.mkdir(exist_ok=True)
    (folder / f"{uuid.uuid4().hex}.json").write_text("\n".join(lines))
    return read_wire_files(spark, str(folder))


def stored(df):
    return tuples(df.drop("ingestion_timestamp"))


def test_both_streams_agree_with_batch(spark, small, tmp_path):
    stream = wire_stream(spark, small)
    queries = run_trade_flow(stream, f"{tmp_path}/raw", f"{tmp_path}/aggregated", flow(tmp_path))
    assert [q.name for q in queries] == ["raw_stream_data_writer", "aggregated_data_writer"]
    for query in queries:
        query.awaitTermination()
    trades = clean_and_deduplicate(wire(spark, small))
    assert stored(read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT)) == stored(trades)
    newest = trades.agg(F.max("trade_timestamp")).first()[0]
    closed = window_metrics(wire(spark, small)).where(F.col("window_end") <= F.lit(newest - dt.timedelta(minutes=2)))
    aggregated = read_table(spark, f"{tmp_path}/aggregated", AGGREGATED_LAYOUT)
    assert tuples(aggregated) == tuples(closed)
    assert aggregated.count() > 0


def test_one_ended_query_stops_the_others(spark, tmp_path):
    wire_df = send(spark, tmp_path, ("A", 0, 1))
    endless = start_raw(wire_df, f"{tmp_path}/raw", TradeFlow(f"{tmp_path}/checkpoints"))
    once = start_aggregated(wire_df, f"{tmp_path}/aggregated", flow(tmp_path))
    await_any(spark, [endless, once], timeout=120)
    assert not endless.isActive and not once.isActive


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    def run():
        start_raw(read_wire_files(spark, f"{tmp_path}/feed"), f"{tmp_path}/raw", flow(tmp_path)).awaitTermination()
        start_aggregated(
            read_wire_files(spark, f"{tmp_path}/feed"), f"{tmp_path}/aggregated", flow(tmp_path)
        ).awaitTermination()
        return (
            read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).count(),
            {r.window_start.minute: (r.trade_count, r.total_volume)
             for r in read_table(spark, f"{tmp_path}/aggregated", AGGREGATED_LAYOUT).collect()},
        )

    send(spark, tmp_path, ("A", 10, 1), ("A", 20, 2))
    assert run() == (2, {})
    # A copy of an old trade, a new one in the open window, and one that closes it.
    send(spark, tmp_path, ("A", 20, 2), ("A", 30, 3), ("A", 600, 4))
    assert run() == (4, {0: (3, 3)})
    assert run() == (4, {0: (3, 3)})


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    log = ProgressLog(spark, f"{tmp_path}/progress", every=2)

    def run(limit=None):
        feed = read_wire_files(spark, f"{tmp_path}/feed", limit)
        query = start_raw(feed, f"{tmp_path}/raw", flow(tmp_path))
        query.awaitTermination()
        log.wait_for(query)
        return late_rows_dropped(progress_report(spark, f"{tmp_path}/progress")).first()[0]

    spark.streams.addListener(log)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        send(spark, tmp_path, ("A", 0, 1), ("A", 600, 2))
        assert run() == 0
        # The watermark stands at 480 s: equal is late, above is not.
        send(spark, tmp_path, ("B", 100, 1), ("B", 480, 1), ("B", 481, 1), ("A", 600, 2))
        assert run() == 2
        kept = read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).groupBy("symbol").count()
        assert tuples(kept) == [("A", 2), ("B", 1)]
        # More batches than a query remembers, each with one late row.
        for second in range(6):
            send(spark, tmp_path, ("C", second, 1))
        assert run(limit=1) == 8
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(log)
    report = progress_report(spark, f"{tmp_path}/progress")
    assert {r.operator for r in report.collect()} == {"dedupe"}
    assert report.agg(F.max("input_rows")).first()[0] == 4
    assert query_totals(report).collect()[0].input_rows == 12


@pytest.mark.parametrize("fanout", [1, 5])
def test_copies_within_and_across_batches(spark, tmp_path, fanout):
    for _ in range(2):
        send(spark, tmp_path, *[("HOT", 5, 1)] * 400, *[("A", s, 1) for s in range(200)])
        query = start_raw(
            read_wire_files(spark, f"{tmp_path}/feed"), f"{tmp_path}/raw", flow(tmp_path, copy_fanout=fanout)
        )
        query.awaitTermination()
    counts = read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).groupBy("symbol").count()
    assert tuples(counts) == [("A", 200), ("HOT", 1)]


def test_catalog_table_stream_and_replay_with_a_lost_checkpoint(spark, small, tmp_path):
    raw, aggregated = bootstrap(spark, f"ns_{uuid.uuid4().hex}", provider="parquet")
    for attempt in range(2):
        # A new checkpoint reads everything again; the table must not grow.
        again = TradeFlow(f"{tmp_path}/checkpoints{attempt}", trigger=ONCE)
        for query in run_trade_flow(wire_stream(spark, small), raw, aggregated, again):
            query.awaitTermination()
        trades = clean_and_deduplicate(wire(spark, small))
        assert stored(read_table(spark, raw, RAW_LAYOUT)) == stored(trades)
        assert read_table(spark, aggregated, AGGREGATED_LAYOUT).count() > 0
    assert read_table(spark, aggregated, AGGREGATED_LAYOUT).dropDuplicates(["symbol", "window_start"]).count() == (
        read_table(spark, aggregated, AGGREGATED_LAYOUT).count()
    )


def test_batch_stream_to_a_path(spark, small, tmp_path):
    rows = clean_and_deduplicate(wire_stream(spark, small))
    start_batch_stream(rows, f"{tmp_path}/raw", RAW_LAYOUT, f"{tmp_path}/cp", "q", ONCE).awaitTermination()
    expected = clean_and_deduplicate(wire(spark, small))
    assert stored(read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT)) == stored(expected)


@pytest.mark.parametrize("start", ["files", "batches"])
def test_a_hot_partition_has_several_writers_and_no_more(spark, tmp_path, start):
    stream = clean_and_deduplicate(send(spark, tmp_path, *[("HOT", second, 1) for second in range(500)], ("COLD", 1, 1)))
    starter = start_table_stream if start == "files" else start_batch_stream
    query = starter(stream, f"{tmp_path}/raw", RAW_LAYOUT, f"{tmp_path}/cp", "q", ONCE, writers_per_partition=3)
    query.awaitTermination()
    files = [str(path) for path in (tmp_path / "raw").rglob("*.parquet")]
    assert 1 < sum("symbol=HOT" in name for name in files) <= 3
    assert sum("symbol=COLD" in name for name in files) == 1
    assert read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).count() == 501


def test_literal_mode_streams_rows_without_event_time(spark, small, tmp_path):
    literal = flow(tmp_path, keep_null_event_time=True)
    for query in run_trade_flow(wire_stream(spark, small), f"{tmp_path}/raw", f"{tmp_path}/aggregated", literal):
        query.awaitTermination()
    expected = clean_and_deduplicate(wire(spark, small), keep_null_event_time=True)
    assert expected.where("trade_timestamp IS NULL").count() > 0
    # Which of the rows without a time stays is open, so only their number per symbol is compared.
    raw = read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT)
    assert stored(raw.where("trade_timestamp IS NOT NULL")) == stored(expected.where("trade_timestamp IS NOT NULL"))
    assert tuples(raw.where("trade_timestamp IS NULL").groupBy("symbol").count()) == tuples(
        expected.where("trade_timestamp IS NULL").groupBy("symbol").count()
    )
    assert read_table(spark, f"{tmp_path}/aggregated", AGGREGATED_LAYOUT).where("window_start IS NULL").count() == 0


def test_state_is_kept_in_rocksdb(spark, tmp_path):
    query = start_raw(send(spark, tmp_path, ("A", 0, 1)), f"{tmp_path}/raw", flow(tmp_path))
    query.awaitTermination()
    operators = [op for p in query.recentProgress for op in json.loads(p.json)["stateOperators"]]
    assert operators and all(any("rocksdb" in metric for metric in op["customMetrics"]) for op in operators)


def test_bad_messages_do_not_stop_a_stream(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    texts = wire_messages(read_events(spark, "/root/testdata/sf0.001")).limit(1).select(F.col("value").cast("string"))
    good = texts.first()[0]
    (folder / "a.json").write_text("\n".join(["garbage", "", "{}", '{"price":"1e999","volume":"9e99"}', good, "[1,2]"]))
    query = start_raw(read_wire_files(spark, str(folder)), f"{tmp_path}/raw", flow(tmp_path))
    query.awaitTermination()
    assert query.exception() is None


def test_rate_limit_gives_one_batch_per_file(spark, tmp_path):
    for second in (0, 1, 2):
        send(spark, tmp_path, ("A", second, 1))
    limited = read_wire_files(spark, f"{tmp_path}/feed", max_files_per_trigger=1)
    query = start_raw(limited, f"{tmp_path}/raw", flow(tmp_path))
    query.awaitTermination()
    assert sum(1 for p in query.recentProgress if p.numInputRows == 1) == 3
    assert read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).count() == 3


def test_decode_is_the_same_for_bytes_and_text(spark, small):
    sent = wire_messages(read_events(spark, small))
    assert tuples(decode_wire(sent)) == tuples(decode_wire(sent.select(F.col("value").cast("string"))))
