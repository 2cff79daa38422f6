"""Outcomes counted on the way, far-future times, changing lists, exact prices, silence, ranged tables."""

import json

import pytest
from helpers import messages, plan_of, trade, tuples, wire_rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickloom.config import TradeFlow
from tickloom.operators import active_spans, classify, clean_and_deduplicate, observe_outcomes, observed_counts, reject_counts, rejected_input
from tickloom.plans import ingest, start_raw
from tickloom.schema import RAW_LAYOUT
from tickloom.sources import explode_messages, read_table, read_wire_files
from tickloom.streaming import append_batch, publish_list, read_span, start_allowed, start_silences, symbols_of, trade_messages, write_ranged
from tickloom.streaming.allow_list import _version_of_batch, read_list, versions
from tickloom.streaming.file_index import files_for, read_index
from tickloom.streaming.progress import outcome_rows
from tickloom.streaming.tables import append_unseen

ONCE = {"availableNow": True}


def feed(spark, tmp_path, *rows):
    wire_rows(spark, *rows).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("append").text(f"{tmp_path}/feed")
    return read_wire_files(spark, f"{tmp_path}/feed", 1)


# --- outcomes -------------------------------------------------------------------------


def test_outcomes_are_counted_by_the_write(spark, tmp_path):
    rows = [trade(), trade(price="0"), trade(price="x"), trade(symbol=""), trade(volume="-1"), trade(at="nope"), trade()]
    df = wire_rows(spark, *rows).repartition(3)
    observation = Observation("o")
    counted = observe_outcomes(classify(df, keep_input=True), observation)
    assert plan_of(rejected_input(counted)).count("CollectMetrics") == 1
    rejected_input(counted).write.parquet(f"{tmp_path}/rejects")
    assert tuples(observed_counts(spark, observation.get)) == tuples(reject_counts(classify(df)))
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 5


def test_outcomes_of_a_progress_report():
    report = {"id": "q", "runId": "r", "batchId": 3, "observedMetrics": {"outcomes": {"accepted": 2, "price": 0}, "other": {"x": 1}}}
    assert outcome_rows(report) == [("q", "r", 3, "accepted", 2), ("q", "r", 3, "price", 0)]
    assert outcome_rows({"id": "q", "runId": "r", "batchId": 3}) == []


# --- far-future times -----------------------------------------------------------------


def far(row):
    return (*row[:3], "9999-01-01T00:00:00+00:00", *row[4:])


def test_future_is_a_reason(spark):
    rows = [trade(), far(trade()), trade(at="11:00:01"), trade(at="11:00:02"), far(trade(price="0"))]
    reasons = {r.reject_reason: r["n"] for r in classify(wire_rows(spark, *rows), max_ahead="1 hour").groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {None: 2, "future": 2, "price": 1}
    assert classify(wire_rows(spark, *rows)).where("reject_reason = 'future'").count() == 0
    kept = classify(wire_rows(spark, trade(at="nope"), far(trade())), keep_null_event_time=True, max_ahead="1 hour").collect()
    assert sorted(str(r.reject_reason) for r in kept) == ["None", "future"]


# Spark drops late rows by the watermark before last, so without the rule one more batch gets through.
@pytest.mark.parametrize("max_ahead, rows", [("1 hour", 4), (None, 3)])
def test_a_far_time_does_not_poison_the_watermark(spark, tmp_path, max_ahead, rows):
    flow = TradeFlow(f"{tmp_path}/checkpoints", trigger=ONCE, max_ahead=max_ahead)
    for row in (trade(), far(trade(price="2")), trade(at="10:00:05"), trade(at="10:00:06"), trade(at="10:00:07")):
        stream = feed(spark, tmp_path, row)
    start_raw(stream, f"{tmp_path}/raw", flow).awaitTermination()
    assert read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).count() == rows


def test_one_far_row_opens_its_date_only(spark):
    rows = clean_and_deduplicate(wire_rows(spark, trade(), far(trade(price="2"))))
    asked = []

    def stored(low, high):
        table = spark.createDataFrame([], RAW_LAYOUT.schema)
        asked.append(table)
        return table

    inserted = []
    append_unseen(rows, RAW_LAYOUT, stored, lambda df: inserted.append((df.count(), plan_of(df))))
    count, plan = inserted[0]
    assert count == 2 and len(asked) == 1


# --- lists ----------------------------------------------------------------------------


def test_versions_of_a_list(spark, tmp_path):
    path = str(tmp_path)
    assert versions(spark, path) == []
    texts = spark.createDataFrame([(" A, B,",), ("B",), (None,), (",",)], "symbols string")
    assert publish_list(symbols_of(texts), path) == "000000000000"
    assert publish_list(spark.createDataFrame([], "symbol string"), path) == "000000000001"
    assert tuples(read_list(spark, path, versions(spark, path)[0])) == [("A",), ("B",)]
    (tmp_path / "versions" / "000000000002").mkdir()  # not complete
    assert versions(spark, path)[-1] == "000000000001"


def test_a_batch_that_runs_again_takes_its_own_version(spark, tmp_path):
    path = str(tmp_path)
    one = spark.createDataFrame([("A",)], "symbol string")
    assert _version_of_batch(spark, path, "q", 0) is None
    first = publish_list(one, path)
    assert _version_of_batch(spark, path, "q", 0) is None and _version_of_batch(spark, path, "q", 1) == first
    second = publish_list(one, path)
    assert _version_of_batch(spark, path, "q", 1) == first and _version_of_batch(spark, path, "q", 2) == second


def test_a_list_that_changes_between_batches(spark, tmp_path):
    path, target = f"{tmp_path}/list", f"{tmp_path}/raw"

    def run(*rows):
        stream = clean_and_deduplicate(feed(spark, tmp_path, *rows))
        start_allowed(stream, path, target, RAW_LAYOUT, f"{tmp_path}/checkpoint", "allowed", ONCE).awaitTermination()

    run(trade("A"), trade("B"))
    publish_list(spark.createDataFrame([("A",)], "symbol string"), path)
    run(trade("A", at="10:00:01"), trade("B", at="10:00:01"))
    publish_list(spark.createDataFrame([("A",), ("B",)], "symbol string"), path)
    run(trade("A", at="10:00:02"), trade("B", at="10:00:02"))
    rows = read_table(spark, target, RAW_LAYOUT).collect()
    assert sorted((r.symbol, r.trade_timestamp.second) for r in rows) == [("A", 1), ("A", 2), ("B", 2)]


# --- exact prices ---------------------------------------------------------------------

LONG = "12345678901234567890.123456789012345678"


def raw_message(price, **more):
    fields = {"s": '"A"', "p": price, "v": "2", "t": "1715000000000"} | more
    return '{"type":"trade","data":[{' + ",".join(f'"{k}":{v}' for k, v in fields.items()) + "}]}"


def test_digits_survive(spark):
    texts = [raw_message(p) for p in (LONG, "0.000000012", "10.50", f'"{LONG}"', "7")]
    exact = [r.price for r in explode_messages(messages(spark, *texts), "x", exact=True).collect()]
    assert exact[0] == exact[3] == LONG and exact[1] == "0.000000012" and exact[4] == "7" and float(exact[2]) == 10.5
    assert explode_messages(messages(spark, texts[0]), "x").first().price != LONG
    good, _, _ = ingest(messages(spark, *texts), "x", exact=True)
    assert json.loads(bytes(trade_messages(good).first().value))["price"] == LONG


def test_exact_reading_skips_what_the_other_skips(spark):
    texts = [raw_message("1", s="null"), raw_message("null"), raw_message("1", v="1.9"), raw_message("1", t="1715000000000.5"), '{"type":"ping"}', "not json", "", None, '{"type":"trade"}',
             '{"type":"trade","data":[null,{}]}', '{"type":"trade","data":7}', '[1]', '{"type":"news","data":[{"s":"A","p":1,"v":1,"t":1}]}']
    both = [explode_messages(messages(spark, *texts), "x", exact=exact).drop("ingestion_timestamp") for exact in (False, True)]
    assert [tuple(r)[2:] for r in both[0].orderBy("volume").collect()] == [tuple(r)[2:] for r in both[1].orderBy("volume").collect()]
    assert both[1].count() == 2


# --- silence --------------------------------------------------------------------------


def test_spans_end_where_a_symbol_is_silent(spark):
    rows = [trade(at=f"10:{m:02d}:00") for m in (0, 5, 9, 40)] + [trade("B", at="10:02:00")]
    spans = active_spans(clean_and_deduplicate(wire_rows(spark, *rows)), "10 minutes")
    found = sorted((r.symbol, r.first_trade.minute, r.last_trade.minute, r.trade_count) for r in spans.collect())
    assert found == [("AAPL", 0, 9, 3), ("AAPL", 40, 40, 1), ("B", 2, 2, 1)]


def test_a_stream_tells_a_silence_once(spark, tmp_path):
    flow = TradeFlow(f"{tmp_path}/checkpoints", trigger=ONCE)
    for minutes in ((0, 3), (5, 30), (31, 32), (59,)):
        stream = feed(spark, tmp_path, *[trade(at=f"10:{m:02d}:00") for m in minutes])
        start_silences(stream, f"{tmp_path}/spans", flow, "10 minutes").awaitTermination()
    spans = spark.read.parquet(f"{tmp_path}/spans").collect()
    assert sorted((r.first_trade.minute, r.last_trade.minute, r.trade_count) for r in spans) == [(0, 5, 3), (30, 32, 3)]


# --- ranged tables --------------------------------------------------------------------


def files_opened(df):
    """What the scans of the executed plan say."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        if "Scan parquet" in node.nodeName():
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_look_up_opens_the_expected_files(spark, tmp_path):
    time = F.expr("timestamp'2026-05-01 00:00:00' + make_dt_interval(0, 0, 0, id * 5)")
    rows = spark.range(20_000).select(
        F.expr("if(id % 3 = 0, concat('S', id % 50), 'HOT')").alias("symbol"), F.col("id").cast("double").alias("price"),
        F.lit(1).cast("bigint").alias("volume"), time.alias("trade_timestamp"), time.alias("ingestion_timestamp"), F.lit("x").alias("source"),
    ).withColumn("trade_date", F.to_date("trade_timestamp"))
    table, index = f"{tmp_path}/raw", f"{tmp_path}/files"
    write_ranged(rows, table, index, RAW_LAYOUT, 12)
    whole = spark.read.schema(RAW_LAYOUT.schema).parquet(table)
    assert tuples(whole.select(*RAW_LAYOUT.columns)) == tuples(rows)
    # The hot symbol takes several files, rare ones share one.
    assert whole.where("symbol = 'HOT'").select(F.input_file_name()).distinct().count() > 2
    for symbol, start, end in (("HOT", "2026-05-01T05:00:00", "2026-05-01T06:00:00"), ("S9", "2026-05-01T00:00:00", "2026-05-01T12:00:00")):
        expected = rows.where(f"symbol = '{symbol}' and trade_timestamp >= '{start}' and trade_timestamp < '{end}'")
        got = read_span(spark, table, index, symbol, start, end, RAW_LAYOUT)
        assert expected.count() and tuples(got) == tuples(expected)
        holding = whole.where(f"symbol = '{symbol}' and trade_timestamp >= '{start}' and trade_timestamp < '{end}'")
        # A frame that has run keeps its scan, so the files are counted on a fresh one.
        opened = files_opened(read_span(spark, table, index, symbol, start, end, RAW_LAYOUT))
        assert opened == len(files_for(read_index(spark, index), symbol, start, end)) <= 2
        assert holding.select(F.input_file_name()).distinct().count() == opened
    assert read_span(spark, table, index, "none", "2026-05-01", "2026-05-02", RAW_LAYOUT).count() == 0


def test_batches_of_a_far_date_are_appended(spark, tmp_path):
    rows = clean_and_deduplicate(wire_rows(spark, trade(), far(trade(price="2"))))
    append_batch(rows, 0, f"{tmp_path}/raw", RAW_LAYOUT, "q")
    assert read_table(spark, f"{tmp_path}/raw", RAW_LAYOUT).count() == 2
