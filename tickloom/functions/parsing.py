"""Text to typed values. A value that cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_price(text: Column) -> Column:
    return text.try_cast("double")


def to_exact_decimal(text: Column) -> Column:
    """The number as written, for callers that must not go through a double."""
    return text.try_cast("decimal(38,18)")


def to_volume(text: Column) -> Column:
    """A whole number; a fraction is cut towards zero (``'10.5'`` -> 10)."""
    return text.try_cast("decimal(38,9)").try_cast("bigint")


# A date, a time and an offset; the fraction of a second may be left out.
ISO_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.]\d{1,9})?(Z|[+-]\d{2}:\d{2})$"


def to_event_time(text: Column) -> Column:
    """An ISO-8601 time with offset, with or without a fraction of a second; all other text is NULL.

    Without the pattern ``10:00:00`` would be a time of the day on which it is
    read, and a year of five digits would move the watermark past every trade.
    """
    return F.when(text.rlike(ISO_TIME), F.try_to_timestamp(text))


def epoch_millis_to_time(text: Column) -> Column:
    """Epoch milliseconds, whole or fractional, as a timestamp."""
    return F.timestamp_micros((text.try_cast("decimal(20,3)") * 1000).try_cast("bigint"))


def split_list(text: Column) -> Column:
    """``' a, b,'`` -> ``['a', 'b']``, for lists that are stored in a column."""
    return F.filter(F.transform(F.split(text, ","), lambda part: F.trim(part)), lambda part: part != "")


def evaluate_once(df: DataFrame, *columns: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select ``columns`` so that filters on them do not repeat their expressions.

    A filter above a plain ``select`` is pushed below it and takes a copy of
    every expression it refers to along; for JSON or timestamp parsing that
    costs more than the rows it saves. Filters do not pass a generator, so
    ``inline`` over a one-element array keeps the expressions in one place.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))
