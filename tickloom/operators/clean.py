"""Cleaning and deduplication, the same on tables and on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import WATERMARK_DELAY
from tickloom.operators.quality import accepted, classify

TRADE_KEYS = ("symbol", "trade_timestamp")
# Which of several copies of a trade stays: the first to arrive, then by value.
SURVIVOR_ORDER = ("ingestion_timestamp", "price", "volume", "source")


def clean_trades(df: DataFrame, keep_null_event_time: bool = False, max_ahead: str | None = None) -> DataFrame:
    """Accepted trades, typed, with ``trade_date`` from the event time."""
    trades = accepted(classify(df, keep_null_event_time, max_ahead=max_ahead))
    return with_trade_date(trades)


def with_trade_date(df: DataFrame, time_column: str = "trade_timestamp") -> DataFrame:
    return df.withColumn("trade_date", F.to_date(time_column))


def deduplicate(
    df: DataFrame,
    watermark_delay: str = WATERMARK_DELAY,
    keys: Sequence[str] = TRADE_KEYS,
    event_time: str = "trade_timestamp",
    survivor_order: Sequence[str] = SURVIVOR_ORDER,
    copy_fanout: int = 1,
    earliest: bool = False,
) -> DataFrame:
    """One row per key.

    A stream keeps the copy it sees first and passes it on at once. The event time
    is part of the key, so the watermark removes keys from the state, and it drops
    rows that come later than ``watermark_delay``. Where one key may have very many
    copies in a micro-batch, ``copy_fanout`` > 1 removes copies in that many groups
    per key first, at the price of a second shuffle and state.

    A table keeps the smallest copy by ``survivor_order``. As an aggregate this
    combines copies before the shuffle: a key that holds a large share of all
    rows leaves each map task as a single row.

    With ``earliest`` a stream keeps the copy that a table keeps, whatever the order
    of arrival: the smallest copy so far stays in the state, and the row is passed
    on when the watermark reaches its event time, after which no copy can come. It
    is the same aggregate, so copies are combined before the shuffle, and there is
    no use for ``copy_fanout``.
    """
    if df.isStreaming and earliest:
        df = df.withWatermark(event_time, watermark_delay)
    elif df.isStreaming:
        marked = df.withWatermark(event_time, watermark_delay)
        if copy_fanout > 1:
            # Any spread is right, because the second step is exact.
            group = (F.rand(seed=0) * copy_fanout).cast("int")
            marked = marked.withColumn("copy_group", group).dropDuplicates([*keys, "copy_group"]).drop("copy_group")
        return marked.dropDuplicates(list(keys))
    first = [name for name in survivor_order if name in df.columns and name not in keys]
    rest = [name for name in df.columns if name not in first and name not in keys]
    survivor = F.min(F.struct(*first, *rest)).alias("survivor")
    columns = [name if name in keys else f"survivor.{name}" for name in df.columns]
    return df.groupBy(*keys).agg(survivor).select(*columns)


def clean_and_deduplicate(
    df: DataFrame,
    watermark_delay: str = WATERMARK_DELAY,
    keep_null_event_time: bool = False,
    columns: Sequence[str] | None = None,
    copy_fanout: int = 1,
    earliest: bool = False,
    max_ahead: str | None = None,
) -> DataFrame:
    """Decoded trades to the rows of the raw table.

    With ``columns`` only those, besides the keys and the arrival time, go
    through the shuffle; the copy that stays carries the same values either way.
    """
    trades = accepted(classify(df, keep_null_event_time, max_ahead=max_ahead))
    if columns is not None:
        needed = {*TRADE_KEYS, *SURVIVOR_ORDER[:3], *columns}
        trades = trades.select(*[name for name in trades.columns if name in needed])
    # The date is added last: it follows from the key and need not be shuffled.
    return with_trade_date(deduplicate(trades, watermark_delay, copy_fanout=copy_fanout, earliest=earliest))
