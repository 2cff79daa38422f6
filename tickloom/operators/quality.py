"""Quality rules: which trades are accepted, and why the others are not."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tickloom.functions import evaluate_once, to_event_time, to_price, to_volume
from tickloom.session import require_utc


def type_trades(
    df: DataFrame, keep: tuple[str, ...] = (), trade_time: Callable[[Column], Column] = to_event_time
) -> DataFrame:
    """Text columns to typed ones; a column that is typed already stays as it is.

    ``trade_time`` reads the text of a trade's time.

    ``has_times`` tells whether both times were present before they were parsed.
    """
    require_utc(df.sparkSession)
    return evaluate_once(
        df,
        F.col("symbol").cast("string").alias("symbol"),
        to_price(F.col("price")).alias("price"),
        to_volume(F.col("volume")).alias("volume"),
        _time(df, "trade_timestamp", trade_time),
        _time(df, "ingestion_timestamp", to_event_time),
        F.col("source"),
        (F.col("trade_timestamp").isNotNull() & F.col("ingestion_timestamp").isNotNull()).alias("has_times"),
        keep=keep,
    )


def _time(df: DataFrame, name: str, read: Callable[[Column], Column]) -> Column:
    typed = isinstance(df.schema[name].dataType, TimestampType)
    return (F.col(name) if typed else read(F.col(name))).alias(name)


# What an accepted trade satisfies, in the order in which the rules are applied.
# NaN counts as above every number in Spark, so the price needs an upper bound
# as well: it keeps NaN and infinity out of averages and maxima.
RULES = {
    "symbol": "symbol <> ''",
    "price": "price > 0 AND price < double('infinity')",
    "volume": "volume >= 0",
    "time": "trade_timestamp IS NOT NULL AND ingestion_timestamp IS NOT NULL",
}
LITERAL_RULES = RULES | {"time": "has_times"}


def reject_reason(rules: dict[str, str]) -> Column:
    """The name of the first rule a typed trade does not satisfy, or NULL."""
    cases = [f"WHEN NOT coalesce({rule}, false) THEN '{name}'" for name, rule in rules.items()]
    return F.expr(f"CASE {' '.join(cases)} END")


def classify(
    df: DataFrame,
    keep_null_event_time: bool = False,
    keep_input: bool = False,
    trade_time: Callable[[Column], Column] = to_event_time,
    max_ahead: str | None = None,
) -> DataFrame:
    """Typed trades plus ``reject_reason``: ``symbol``, ``price``, ``volume``, ``time`` or NULL.

    Rows decoded with their message have a further reason, ``json``, for text
    that is none; it comes before the others.

    ``keep_input`` adds the untouched input row as the struct ``original``, the
    message's text included, for dead letters that can be repaired and sent again.

    ``keep_null_event_time`` accepts times that are present but unreadable.

    With ``max_ahead`` (an interval such as ``1 hour``) a trade whose event time lies
    further than that ahead of its arrival is rejected as ``future``: in a stream it
    would move the watermark past the trades that come after it.
    """
    rules = LITERAL_RULES if keep_null_event_time else RULES
    if max_ahead is not None:
        unknown = "trade_timestamp IS NULL OR ingestion_timestamp IS NULL OR " if keep_null_event_time else ""
        rules = rules | {"future": f"{unknown}trade_timestamp <= ingestion_timestamp + INTERVAL {max_ahead}"}
    keep: tuple[str, ...] = ()
    if "malformed" in df.columns:
        keep = ("malformed",)
        rules = {"json": "NOT malformed"} | rules
    if keep_input:
        original = F.struct(*[name for name in df.columns if name != "malformed"])
        df = df.select("*", original.alias("original"))
        keep = (*keep, "original")
    typed = type_trades(df, keep, trade_time)
    return typed.withColumn("reject_reason", reject_reason(rules)).drop("has_times", "malformed")


def accepted(classified: DataFrame) -> DataFrame:
    spare = [name for name in ("reject_reason", "original") if name in classified.columns]
    return classified.where(F.col("reject_reason").isNull()).drop(*spare)


def accepted_input(classified: DataFrame) -> DataFrame:
    """The accepted rows as they came in (of ``classify(..., keep_input=True)``)."""
    return classified.where(F.col("reject_reason").isNull()).select("original.*")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull())


def rejected_input(classified: DataFrame) -> DataFrame:
    """The rejected rows as they came in, with the reason (of ``classify(..., keep_input=True)``)."""
    return rejected(classified).select("original.*", "reject_reason")


def allow_symbols(df: DataFrame, symbols: list[str]) -> DataFrame:
    """Only the trades of subscribed symbols."""
    return df.where(F.col("symbol").isin(list(symbols)))


# Every reason that a trade may be rejected for.
REASONS = ("json", *RULES, "future")


def observe_outcomes(classified: DataFrame, observation: str | Observation) -> DataFrame:
    """The same rows; their outcomes are counted while something else is done with them.

    Whatever is written from the result brings the counts along: those of a table
    are in the ``Observation`` after the write, those of a stream in its progress
    under the name. Nothing is read a second time.
    """
    reason = F.col("reject_reason")
    counts = [F.count_if(reason == name).alias(name) for name in REASONS]
    return classified.observe(observation, F.count_if(reason.isNull()).alias("accepted"), *counts)


def observed_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """What ``observe_outcomes`` counted as rows like those of ``reject_counts``: one per outcome that occurred."""
    rows = [(outcome, count) for outcome, count in counts.items() if count]
    return spark.createDataFrame(rows, "outcome string, trade_count bigint")


def allow_listed(df: DataFrame, listed: DataFrame) -> DataFrame:
    """Only the trades whose symbol is in a table of symbols, of any size; its repeated rows do not matter."""
    return df.join(listed.select("symbol"), "symbol", "left_semi").select(*df.columns)


def reject_counts(classified: DataFrame) -> DataFrame:
    """Number of trades per outcome; accepted ones under ``accepted``."""
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return classified.groupBy(outcome).agg(F.count("*").alias("trade_count"))
