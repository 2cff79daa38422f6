"""The documented end-to-end cases: message, validation, settings, clean and aggregate."""

from decimal import Decimal

from helpers import messages, trade, wire_rows
from pyspark.sql import functions as F

from tickloom.config import KafkaSource, parse_symbol_list
from tickloom.functions import to_exact_decimal
from tickloom.operators import accepted, aggregate_windows, classify, clean_and_deduplicate
from tickloom.sources import explode_messages


def test_vendor_message_gives_one_trade(spark):
    text = '{"type":"trade","data":[{"s":"AAPL","p":189.42,"v":10,"t":1715000000000}]}'
    rows = explode_messages(messages(spark, text), "feed").collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.symbol, row.price, row.volume, row.source) == ("AAPL", "189.42", 10, "feed")
    assert row.trade_timestamp.timestamp() == 1715000000
    exact = spark.createDataFrame(rows).select(to_exact_decimal(F.col("price"))).first()[0]
    assert exact == Decimal("189.42")


def test_valid_trade_is_accepted_unchanged(spark):
    row = accepted(classify(wire_rows(spark, trade(volume="100")))).first()
    assert (row.symbol, row.price, row.volume, row.source) == ("AAPL", 189.42, 100, "feed")


def test_price_zero_is_rejected(spark):
    assert accepted(classify(wire_rows(spark, trade(price="0")))).count() == 0


def test_symbol_list_and_default_topic():
    assert parse_symbol_list("AAPL,MSFT") == ["AAPL", "MSFT"]
    assert parse_symbol_list(" AAPL , ,MSFT,") == ["AAPL", "MSFT"]
    assert KafkaSource("broker:9092").topic == "stock_trades"


def test_copy_and_negative_price_leave_one_row_and_one_window(spark):
    df = wire_rows(spark, trade(), trade(), trade(price="-1", at="10:00:02", arrived="10:00:03"))
    clean = clean_and_deduplicate(df, "2 minutes")
    assert clean.count() == 1
    windows = aggregate_windows(clean).collect()
    assert len(windows) == 1
    assert windows[0].trade_count == 1
