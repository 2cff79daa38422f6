from tickloom.sources.tables import read_table, time_range
from tickloom.sources.vendor import explode_items, explode_messages, malformed_messages
from tickloom.sources.wire import decode_wire, kafka_source_options, read_wire_files, read_wire_stream

__all__ = [
    "decode_wire",
    "explode_items",
    "explode_messages",
    "kafka_source_options",
    "malformed_messages",
    "read_table",
    "read_wire_files",
    "read_wire_stream",
    "time_range",
]
