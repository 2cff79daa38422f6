from tickloom.functions.encoding import iso_utc, message_key, message_value, plain_number
from tickloom.functions.parsing import (
    epoch_millis_to_time,
    evaluate_once,
    split_list,
    to_event_time,
    to_exact_decimal,
    to_price,
    to_volume,
)

__all__ = [
    "epoch_millis_to_time",
    "evaluate_once",
    "iso_utc",
    "message_key",
    "message_value",
    "plain_number",
    "split_list",
    "to_event_time",
    "to_exact_decimal",
    "to_price",
    "to_volume",
]
