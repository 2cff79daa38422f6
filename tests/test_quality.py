import pytest
from helpers import trade, tuples, wire_rows

from tickloom.operators import accepted, accepted_input, allow_symbols, classify, clean_trades, reject_counts, rejected

CASES = [
    (trade(), None),
    (trade(symbol=None), "symbol"),
    (trade(symbol=""), "symbol"),
    (trade(symbol="", price="-1", volume="-1"), "symbol"),
    (trade(price="0"), "price"),
    (trade(price="-1", volume="-1"), "price"),
    (trade(price="abc"), "price"),
    (trade(price=None), "price"),
    (trade(price="NaN"), "price"),
    (trade(price="Infinity"), "price"),
    (trade(volume="-1"), "volume"),
    (trade(volume="x"), "volume"),
    (trade(volume=None), "volume"),
    (trade(volume="0"), None),
    (trade(source=None), None),
    ((*trade()[:3], "nope", *trade()[4:]), "time"),
    ((*trade()[:3], None, *trade()[4:]), "time"),
    ((*trade()[:4], "nope", "feed"), "time"),
    ((*trade()[:4], None, "feed"), "time"),
    ((None,) * 6, "symbol"),
]


@pytest.mark.parametrize(("row", "reason"), CASES)
def test_first_failing_rule(spark, row, reason):
    assert [r.reject_reason for r in classify(wire_rows(spark, row)).collect()] == [reason]


def test_split_is_complete_and_counted(spark):
    df = wire_rows(spark, *[row for row, _ in CASES])
    classified = classify(df)
    assert accepted(classified).count() + rejected(classified).count() == len(CASES)
    expected = {}
    for _, reason in CASES:
        expected[reason or "accepted"] = expected.get(reason or "accepted", 0) + 1
    assert {r.outcome: r.trade_count for r in reject_counts(classified).collect()} == expected


def test_literal_mode_keeps_unreadable_times_but_not_missing_ones(spark):
    unreadable, missing = (*trade()[:3], "nope", *trade()[4:]), (*trade()[:3], None, *trade()[4:])
    df = wire_rows(spark, unreadable, missing)
    assert clean_trades(df).count() == 0
    kept = clean_trades(df, keep_null_event_time=True).collect()
    assert len(kept) == 1
    assert kept[0].trade_timestamp is None and kept[0].trade_date is None


def test_originals_survive_classification(spark):
    df = wire_rows(spark, trade(price="abc"), trade(price="189.4200"))
    classified = classify(df, keep_input=True)
    assert rejected(classified).select("original.price").collect()[0][0] == "abc"
    assert accepted_input(classified).collect()[0].price == "189.4200"
    assert accepted(classified).columns == df.columns


def test_classify_takes_typed_trades(spark):
    typed = clean_trades(wire_rows(spark, trade())).drop("trade_date")
    assert tuples(accepted(classify(typed))) == tuples(typed)


def test_allow_symbols(spark):
    df = wire_rows(spark, trade(), trade(symbol="MSFT"), trade(symbol="AMZN"))
    assert sorted(r.symbol for r in allow_symbols(df, ["AAPL", "MSFT"]).collect()) == ["AAPL", "MSFT"]


def test_other_session_zone_is_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            classify(wire_rows(spark, trade()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
