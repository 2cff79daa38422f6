import datetime as dt
import json

from helpers import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.functions import (
    epoch_millis_to_time,
    evaluate_once,
    iso_utc,
    message_key,
    message_value,
    split_list,
    to_event_time,
    to_price,
    to_volume,
)

few = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def apply(spark, function, *values, kind="string"):
    df = spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, x {kind}")
    return [row[0] for row in df.orderBy("i").select(function(F.col("x"))).collect()]


def test_price(spark):
    assert apply(spark, to_price, "1.5", " 2 ", "abc", "", None, "1e3") == [1.5, 2.0, None, None, None, 1000.0]


def test_volume_cuts_fractions_and_survives_any_text(spark):
    values = ("10", "10.5", "-10.7", "abc", "", None, "1e3", "9223372036854775807", "9223372036854775808", "1e40")
    assert apply(spark, to_volume, *values) == [10, 10, -10, None, None, None, 1000, 2**63 - 1, None, None]


def test_event_time_with_and_without_fraction(spark):
    def seconds(text):
        return F.unix_micros(to_event_time(text))

    base = 1777975200_000000
    assert apply(
        spark, seconds, "2026-05-05T10:00:00+00:00", "2026-05-05T10:00:00.250000+00:00", "2026-05-05T12:00:00+02:00",
        "nope", "", None, "2026-13-05T10:00:00+00:00",
    ) == [base, base + 250000, base, None, None, None, None]


def test_epoch_millis(spark):
    def micros(text):
        return F.unix_micros(epoch_millis_to_time(text))

    assert apply(spark, micros, "1715000000000", "1715000000000.5", "-1", "x", None, "9" * 30) == [
        1715000000000000, 1715000000000500, -1000, None, None, None,
    ]


def test_iso_text_leaves_out_a_zero_fraction(spark):
    texts = ["2026-05-05T10:00:00+00:00", "2026-05-05T10:00:00.000001+00:00", "1969-12-31T23:59:59.900000+00:00"]
    assert apply(spark, lambda text: iso_utc(to_event_time(text)), *texts) == texts


@few
@given(st.lists(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2200, 1, 1)), min_size=1, max_size=30))
def test_iso_text_is_what_isoformat_writes_and_reads_back(spark, times):
    texts = [time.replace(tzinfo=dt.timezone.utc).isoformat() for time in times]
    assert apply(spark, lambda text: iso_utc(to_event_time(text)), *texts) == texts


@few
@given(st.lists(st.text(max_size=12), min_size=1, max_size=30))
def test_no_text_raises(spark, texts):
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    x = F.col("x")
    assert df.select(to_price(x), to_volume(x), epoch_millis_to_time(x)).count() == len(texts)
    df.select(to_price(x), to_volume(x), epoch_millis_to_time(x)).collect()
    df.select(F.unix_micros(to_event_time(x))).collect()


def test_split_list(spark):
    assert apply(spark, split_list, " a, b,,", "") == [["a", "b"], []]


def test_message_is_json_with_visible_nulls(spark):
    df = spark.range(1).select(
        message_key(F.lit("é")).alias("key"), message_value(a=F.lit(1), b=F.lit(None).cast("string")).alias("value")
    )
    row = df.first()
    assert bytes(row.key) == "é".encode()
    assert json.loads(bytes(row.value)) == {"a": 1, "b": None}


def test_filters_do_not_repeat_an_expression_evaluated_once(spark):
    df = spark.createDataFrame([('{"a":"1"}',), ("x",), (None,)], "value string")
    parsed = evaluate_once(df, F.from_json("value", "a string").alias("p")).where("p.a = '1' and p.a <> 'x'")
    assert plan_of(parsed).count("from_json") == 1
    assert parsed.count() == 1
