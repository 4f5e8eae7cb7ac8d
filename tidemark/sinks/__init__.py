"""Run records as long tables and JSON."""

from tidemark.sinks.records import (
    read_config,
    record,
    run_metrics,
    run_parameters,
    write_config,
    write_history,
    write_ledger,
    write_report,
)

__all__ = [
    "read_config",
    "record",
    "run_metrics",
    "run_parameters",
    "write_config",
    "write_history",
    "write_ledger",
    "write_report",
]
