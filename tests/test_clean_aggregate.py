import datetime as dt
import random
from collections import defaultdict

from helpers import plan_of, trade, tuples, wire_rows
from pyspark.sql import functions as F

from tickloom.operators import (
    activity_heatmap,
    aggregate_windows,
    clean_and_deduplicate,
    clean_trades,
    deduplicate,
    symbol_summary,
    total_trades,
    volume_by_symbol,
)
from tickloom.plans.trade_flow import window_metrics


def test_first_arrival_survives_then_lowest_value(spark):
    df = wire_rows(
        spark,
        trade(price="3", arrived="10:00:09"),
        trade(price="2", arrived="10:00:05", volume="8"),
        trade(price="2", arrived="10:00:05", volume="7"),
        trade(price="9", arrived="10:00:07"),
    )
    rows = clean_and_deduplicate(df).collect()
    assert [(r.price, r.volume, r.ingestion_timestamp.second) for r in rows] == [(2.0, 7, 5)]


def test_hot_key_matches_brute_force(spark):
    """One key holds more than a third of the rows; every row counts, one per key stays."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        second = 0 if i % 5 < 2 else rng.randrange(1, 600)
        rows.append(
            trade(
                symbol=rng.choice(["A", "B"]) if second else "HOT",
                price=str(rng.randrange(1, 50)),
                volume=str(rng.randrange(0, 9)),
                at=f"10:{second // 60:02d}:{second % 60:02d}",
                arrived=f"11:{rng.randrange(60):02d}:00",
            )
        )
    best = {}
    for symbol, price, volume, at, arrived, source in rows:
        candidate = (arrived, float(price), int(volume))
        best[symbol, at] = min(best.get((symbol, at), candidate), candidate)
    # 40 partitions, so that copies of the hot key start in many tasks.
    kept = clean_and_deduplicate(wire_rows(spark, *rows).repartition(40))
    actual = {(r.symbol, r.trade_timestamp): (r.price, r.volume) for r in kept.collect()}
    assert len(actual) == len(best)
    local = dt.datetime.fromisoformat
    expected = {
        (symbol, local(at).astimezone().replace(tzinfo=None)): value[1:] for (symbol, at), value in best.items()
    }
    assert actual == expected


def test_copies_are_combined_before_the_shuffle(spark):
    plan = plan_of(clean_and_deduplicate(wire_rows(spark, trade(), trade())))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")


def test_literal_mode_keeps_one_null_time_per_symbol(spark):
    bad = [(*trade(symbol=s)[:3], "nope", *trade()[4:]) for s in ("A", "A", "B")]
    assert clean_and_deduplicate(wire_rows(spark, *bad), keep_null_event_time=True).count() == 2


def test_other_keys(spark):
    df = clean_trades(wire_rows(spark, trade(), trade(at="10:00:05"), trade(symbol="B")))
    kept = deduplicate(df, keys=["symbol"])
    assert kept.columns == df.columns
    assert sorted(r.symbol for r in kept.collect()) == ["AAPL", "B"]


def test_windows_are_half_open_and_aligned(spark):
    df = wire_rows(
        spark,
        trade(price="1", volume="1", at="10:00:00"),
        trade(price="3", volume="2", at="10:00:59.999999"),
        trade(price="5", volume="4", at="10:01:00"),
    )
    rows = window_metrics(df).orderBy("window_start").select(
        F.date_format("window_start", "HH:mm"),
        F.date_format("window_end", "HH:mm"),
        "avg_price", "min_price", "max_price", "total_volume", "trade_count", F.col("trade_date").cast("string"),
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("10:00", "10:01", 2.0, 1.0, 3.0, 3, 2, "2026-05-05"),
        ("10:01", "10:02", 5.0, 5.0, 5.0, 4, 1, "2026-05-05"),
    ]


def test_times_before_the_epoch_fall_into_their_own_window(spark):
    early = ("A", "1", "1", "1969-12-31T23:59:30+00:00", "1970-01-01T00:00:00+00:00")
    row = window_metrics(wire_rows(spark, early)).select(F.unix_seconds("window_start"), F.col("trade_date").cast("string")).first()
    assert tuple(row) == (-60, "1969-12-31")


def test_volume_overflow_does_not_stop_the_query(spark):
    big = str(2**63 - 1)
    df = wire_rows(spark, trade(volume=big), trade(volume=big, at="10:00:10"), trade(symbol="B"))
    totals = {r.symbol: r.total_volume for r in window_metrics(df).collect()}
    assert totals == {"AAPL": None, "B": 10}


def test_window_metrics_equal_aggregate_of_the_raw_rows(spark):
    rng = random.Random(3)
    rows = [
        trade(symbol=rng.choice("ABC"), price=str(rng.randrange(1, 9)), volume=str(rng.randrange(5)),
              at=f"10:{rng.randrange(5):02d}:{rng.randrange(60):02d}", arrived=f"11:00:{rng.randrange(60):02d}")
        for _ in range(800)
    ]
    df = wire_rows(spark, *rows)
    assert tuples(window_metrics(df)) == tuples(aggregate_windows(clean_and_deduplicate(df)))
    groups = defaultdict(list)
    for r in clean_and_deduplicate(df).collect():
        groups[r.symbol, r.trade_timestamp.replace(second=0, microsecond=0)].append(r)
    metrics = {(r.symbol, r.window_start): r for r in window_metrics(df).collect()}
    assert metrics.keys() == groups.keys()
    for key, members in groups.items():
        prices = [m.price for m in members]
        m = metrics[key]
        assert abs(m.avg_price - sum(prices) / len(prices)) < 1e-9
        assert (m.min_price, m.max_price, m.trade_count) == (min(prices), max(prices), len(prices))
        assert m.total_volume == sum(member.volume for member in members)


def test_summary_is_the_plain_mean_of_window_averages(spark):
    df = wire_rows(
        spark,
        trade(price="1", volume="1", at="10:00:00"),
        trade(price="1", volume="1", at="10:00:01"),
        trade(price="4", volume="5", at="10:03:00"),
    )
    windows = window_metrics(df)
    row = symbol_summary(windows).first()
    assert (row.symbol, row.total_volume, row.trade_count, row.avg_price) == ("AAPL", 7, 3, 2.5)
    assert row.latest_window_start.minute == 3
    assert tuples(volume_by_symbol(windows)) == [("AAPL", 7)]
    assert total_trades(windows).first()[0] == 3
    assert total_trades(windows.limit(0)).first()[0] == 0


def test_heatmap_buckets(spark):
    df = clean_trades(wire_rows(spark, trade(at="10:59:59"), trade(at="11:00:00"), trade(at="11:30:00")))
    assert sorted(r.trade_count for r in activity_heatmap(df).collect()) == [1, 2]
    assert activity_heatmap(df, "1 day").first().trade_count == 3
