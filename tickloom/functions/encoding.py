"""Typed values to the text and bytes that go on the topic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc(time: Column) -> Column:
    """ISO-8601 with offset; the fraction is left out when it is zero."""
    whole = time == F.date_trunc("second", time)
    return F.when(whole, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def plain_number(number: Column) -> Column:
    """The shortest text of a double, never with an exponent where 18 places before and after the point do."""
    text = number.cast("string")
    digits = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), "0+$", "")
    return F.when(text.contains("E"), F.coalesce(F.regexp_replace(digits, "[.]$", ".0"), text)).otherwise(text)


def message_key(symbol: Column) -> Column:
    """UTF-8 bytes of the symbol: all trades of one symbol share a topic partition."""
    return symbol.cast("binary")


def message_value(**fields: Column) -> Column:
    """UTF-8 bytes of a JSON object with these fields; NULL stays visible as ``null``."""
    record = F.struct(*[value.alias(name) for name, value in fields.items()])
    return F.to_json(record, {"ignoreNullFields": "false"}).cast("binary")
