from tickloom.plans.trade_flow import (
    await_all,
    await_any,
    bootstrap,
    ingest,
    run_ingest,
    run_serving_flow,
    run_trade_flow,
    start_aggregated,
    start_raw,
    start_rejects,
    window_metrics,
)

__all__ = [
    "await_all",
    "await_any",
    "bootstrap",
    "ingest",
    "run_ingest",
    "run_serving_flow",
    "run_trade_flow",
    "start_aggregated",
    "start_raw",
    "start_rejects",
    "window_metrics",
]
