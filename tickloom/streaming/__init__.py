from tickloom.streaming.allow_list import publish_list, start_allowed, symbols_of
from tickloom.streaming.file_index import files_for, latest_indexed, read_index, read_span, write_indexed, write_ranged
from tickloom.streaming.jdbc import append_jdbc_batch, start_jdbc_stream
from tickloom.streaming.one_pass import OnePassTables, apply_late, publish_windows, start_one_pass
from tickloom.streaming.progress import OutcomeLog, ProgressLog, late_rows_dropped, outcome_report, progress_report, query_totals
from tickloom.streaming.silence import start_silences
from tickloom.streaming.state import account, open_windows, read_state, stateful_operators
from tickloom.streaming.summary import read_summary, start_summary
from tickloom.streaming.tables import (
    append_batch,
    arrange,
    compact,
    distribute,
    ensure_namespace,
    ensure_table,
    start_batch_stream,
    start_table_stream,
    table_ddl,
    write_table,
)
from tickloom.streaming.topic import (
    kafka_sink_options,
    publish,
    reject_messages,
    start_publishing,
    trade_messages,
)

__all__ = [
    "OnePassTables",
    "OutcomeLog",
    "ProgressLog",
    "account",
    "append_batch",
    "append_jdbc_batch",
    "apply_late",
    "arrange",
    "compact",
    "distribute",
    "ensure_namespace",
    "ensure_table",
    "files_for",
    "kafka_sink_options",
    "late_rows_dropped",
    "latest_indexed",
    "open_windows",
    "outcome_report",
    "progress_report",
    "publish",
    "publish_list",
    "publish_windows",
    "query_totals",
    "read_index",
    "read_span",
    "read_state",
    "read_summary",
    "reject_messages",
    "start_allowed",
    "start_batch_stream",
    "start_jdbc_stream",
    "start_one_pass",
    "start_publishing",
    "start_silences",
    "start_summary",
    "start_table_stream",
    "stateful_operators",
    "symbols_of",
    "table_ddl",
    "trade_messages",
    "write_indexed",
    "write_ranged",
    "write_table",
]
