from .buckets import number_sessions, with_session_numbers, write_buckets
from .flat_events import load_flat_events
from .json_tree import load_conversations, load_events, load_generation_status
from .lake import Catalog, Lake, ReadFilters, TableSpec, default_catalog, read_parquet, write_parquet
from .sinks import write_reports
from .snapshots import SnapshotStore, WriteConflict

__all__ = [
    "Catalog", "Lake", "ReadFilters", "SnapshotStore", "TableSpec", "WriteConflict", "default_catalog",
    "load_conversations", "load_events", "load_flat_events", "load_generation_status", "read_parquet",
    "number_sessions", "with_session_numbers", "write_buckets", "write_parquet", "write_reports",
]
