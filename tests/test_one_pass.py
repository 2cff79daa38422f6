"""The tables of the one-pass flow: late trades, failures between sinks, marks, and what is published."""

import datetime as dt
import json

import pytest
from helpers import trade, tuples, wire_rows
from pyspark.sql import functions as F

from tickloom.config import TradeFlow
from tickloom.operators import aggregate_windows, clean_and_deduplicate
from tickloom.schema import AGGREGATED_LAYOUT
from tickloom.session import children
from tickloom.sources import read_table, read_wire_files
from tickloom.streaming import OnePassTables, apply_late, publish_windows, start_one_pass
from tickloom.streaming.one_pass import apply_batch, merged_windows, part_name, window_partials


@pytest.fixture
def flow(tmp_path):
    return TradeFlow(f"{tmp_path}/checkpoints")


@pytest.fixture
def tables(tmp_path):
    return OnePassTables(f"{tmp_path}/tables")


def rounded(df):
    return tuples(df.withColumn("avg_price", F.round("avg_price", 9)))


def apply(spark, tables, flow, batch_id, *rows, **more):
    apply_batch(wire_rows(spark, *rows), batch_id, more.pop("query_id", "q"), tables, flow, **more)


FIRST = [trade(price="10"), trade(price="12", at="10:00:30"), trade("MSFT", price="5", at="10:05:00")]
# One copy, one late trade, one in time although older than the newest, and a new one.
SECOND = [
    trade(price="99", at="10:05:00", symbol="MSFT"),
    trade(price="20", at="10:02:00"),
    trade(price="21", at="10:03:30"),
    trade(price="22", at="10:09:00"),
    trade(price="-1", at="10:09:01"),
]


def test_late_trades_go_to_the_side_table(spark, tables, flow):
    apply(spark, tables, flow, 0, *FIRST)
    apply(spark, tables, flow, 1, *SECOND)
    assert sorted(r.price for r in tables.raw(spark).collect()) == [5, 10, 12, 21, 22]
    assert [(r.price, r.part) for r in tables.late(spark).collect()] == [(20, part_name(1))]
    mark = json.loads(spark.read.text(f"{tables.folder('marks')}/q/{part_name(1)}").first()[0])
    assert mark["watermark"] == int(dt.datetime(2026, 5, 5, 10, 7, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    # The first part has no row ahead of the watermark any more, so the next batch does not open it.
    assert [x["part"] for x in mark["tail"]] == [part_name(1)]


def test_late_trades_are_applied_once_and_their_dates_replaced(spark, tables, flow, tmp_path):
    apply(spark, tables, flow, 0, *FIRST)
    apply(spark, tables, flow, 1, *SECOND)
    path = f"{tmp_path}/published"
    publish_windows(spark, tables, path)
    before = rounded(read_table(spark, path, AGGREGATED_LAYOUT))
    assert apply_late(spark, tables, flow) == [dt.date(2026, 5, 5)]
    assert apply_late(spark, tables, flow) == []
    publish_windows(spark, tables, path, [dt.date(2026, 5, 5)])
    publish_windows(spark, tables, path, [])
    batch = aggregate_windows(clean_and_deduplicate(wire_rows(spark, *FIRST, *SECOND)))
    expected = rounded(batch)
    assert rounded(read_table(spark, path, AGGREGATED_LAYOUT)) == expected != before
    # A late copy of a stored trade changes nothing; another late trade of the same minute does.
    apply(spark, tables, flow, 2, trade(price="1", at="10:02:00"), trade(price="3", at="10:00:40"))
    apply_late(spark, tables, flow)
    batch = aggregate_windows(clean_and_deduplicate(wire_rows(spark, *FIRST, *SECOND, trade(price="3", at="10:00:40"))))
    assert rounded(tables.windows(spark)) == rounded(batch)


@pytest.mark.parametrize("sink", ["late", "raw", "partials", "marks"])
def test_a_failure_behind_any_sink_loses_and_doubles_nothing(spark, tables, flow, sink):
    apply(spark, tables, flow, 0, *FIRST)

    def fail(done):
        if done == sink:
            raise RuntimeError(sink)

    with pytest.raises(RuntimeError, match=sink):
        apply(spark, tables, flow, 1, *SECOND, done=fail)
    apply(spark, tables, flow, 1, *SECOND)
    assert sorted(r.price for r in tables.raw(spark).collect()) == [5, 10, 12, 21, 22]
    assert tables.windows(spark).agg(F.sum("trade_count")).first()[0] == 5
    assert tables.late(spark).count() == 1
    index = spark.read.parquet(tables.folder("files"))
    assert index.agg(F.sum("row_count")).first()[0] == 5


def test_an_interrupted_late_job_runs_again(spark, tables, flow, monkeypatch):
    from tickloom.streaming import one_pass

    apply(spark, tables, flow, 0, *FIRST)
    apply(spark, tables, flow, 1, *SECOND)
    write = one_pass._write_part
    monkeypatch.setattr(one_pass, "_write_part", lambda *args: (write(*args), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        apply_late(spark, tables, flow)
    monkeypatch.undo()
    assert apply_late(spark, tables, flow) == [dt.date(2026, 5, 5)]
    assert tables.windows(spark).agg(F.sum("trade_count")).first()[0] == 6


def test_empty_batches_and_tables(spark, tables, flow):
    apply(spark, tables, flow, 0)
    assert tables.raw(spark).count() == tables.windows(spark).count() == tables.late(spark).count() == 0
    assert apply_late(spark, tables, flow) == []
    apply(spark, tables, flow, 1, *FIRST)
    apply(spark, tables, flow, 2)
    apply(spark, tables, flow, 3, trade(price="20", at="09:00:00"))
    assert tables.raw(spark).count() == 3 and tables.late(spark).count() == 1


def test_a_root_belongs_to_one_query(spark, tables, flow):
    apply(spark, tables, flow, 0, *FIRST)
    with pytest.raises(ValueError, match="needs a new root"):
        apply(spark, tables, flow, 0, *FIRST, query_id="other")
    assert children(spark, tables.folder("marks")) == ["q"]


def test_rows_without_time_are_refused(spark, tables, tmp_path):
    with pytest.raises(ValueError, match="late or in time"):
        start_one_pass(spark.range(1), tables, TradeFlow(str(tmp_path), keep_null_event_time=True))


def test_merged_partials_equal_the_aggregate(spark):
    rows = [trade(price=str(p), volume=str(v), at=f"10:0{p % 3}:0{v % 10}") for p, v in [(1, 2), (2, 3), (3, 4), (4, 5), (7, 9)]]
    huge = [trade(volume="9223372036854775807", at="11:00:00"), trade(volume="9223372036854775807", at="11:00:01")]
    trades = clean_and_deduplicate(wire_rows(spark, *rows, *huge))
    halves = [window_partials(trades.where(f"second(trade_timestamp) % 2 = {i}")) for i in (0, 1)]
    assert rounded(merged_windows(halves[0].unionByName(halves[1]))) == rounded(aggregate_windows(trades))


def test_the_source_is_read_once(spark, tables, tmp_path):
    flow = TradeFlow(f"{tmp_path}/checkpoints", trigger={"availableNow": True})
    for rows in (FIRST, SECOND):
        wire_rows(spark, *rows).select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(f"{tmp_path}/feed")
        told = []
        query = start_one_pass(read_wire_files(spark, f"{tmp_path}/feed"), tables, flow, lambda sink, batch_id: told.append((sink, batch_id)))
        query.awaitTermination()
        # Spark counts what the batch's jobs read; a second pass would count again.
        assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [len(rows)]
    assert told == [("late", 1), ("raw", 1), ("partials", 1), ("marks", 1)]
    assert sorted(r.price for r in tables.raw(spark).collect()) == [5, 10, 12, 21, 22]
