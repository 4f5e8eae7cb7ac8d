"""Reading client-day tables and mapping their columns to the canonical names."""

from tidemark.sources.columns import EVENTS_EXCLUDED, event_columns, find_column, project_canonical
from tidemark.sources.load import load, require_rows, source_kind

__all__ = [
    "EVENTS_EXCLUDED",
    "event_columns",
    "find_column",
    "load",
    "project_canonical",
    "require_rows",
    "source_kind",
]
