from tickloom.operators.aggregate import (
    activity_heatmap,
    aggregate_windows,
    symbol_summary,
    total_trades,
    volume_by_symbol,
)
from tickloom.operators.checks import active_spans, freshness_report, reconcile
from tickloom.operators.clean import clean_and_deduplicate, clean_trades, deduplicate
from tickloom.operators.hash_tree import differing_rows, leaves, tree_differences, unequal_nodes
from tickloom.operators.quality import (
    accepted,
    accepted_input,
    allow_listed,
    allow_symbols,
    classify,
    observe_outcomes,
    observed_counts,
    reject_counts,
    rejected,
    rejected_input,
)
from tickloom.operators.serving import (
    avg_price_series,
    latest,
    latest_stored,
    latest_trades,
    latest_windows,
    price_range_series,
    price_series,
    register_views,
    row_count,
)

__all__ = [
    "accepted",
    "accepted_input",
    "active_spans",
    "activity_heatmap",
    "aggregate_windows",
    "allow_listed",
    "allow_symbols",
    "avg_price_series",
    "classify",
    "clean_and_deduplicate",
    "clean_trades",
    "deduplicate",
    "differing_rows",
    "freshness_report",
    "latest",
    "latest_stored",
    "latest_trades",
    "latest_windows",
    "leaves",
    "observe_outcomes",
    "observed_counts",
    "price_range_series",
    "price_series",
    "reconcile",
    "register_views",
    "reject_counts",
    "rejected",
    "rejected_input",
    "row_count",
    "symbol_summary",
    "total_trades",
    "tree_differences",
    "unequal_nodes",
    "volume_by_symbol",
]
