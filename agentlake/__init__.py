"""Analytics over event logs of AI agents, on Spark DataFrames."""

from .operators import (
    BatchOperator,
    BuildSessions,
    BuildTurnsAndErrors,
    Operator,
    assign_turn_index,
    build_model_spans,
    build_sessions,
    build_tool_calls,
    build_turns,
)
from .plans import evaluate_logs, run_report
from .sources import (
    Catalog,
    Lake,
    ReadFilters,
    TableSpec,
    default_catalog,
    load_conversations,
    load_events,
    load_flat_events,
    load_generation_status,
    write_reports,
)

__all__ = [
    "BatchOperator", "BuildSessions", "BuildTurnsAndErrors", "Catalog", "Lake", "Operator", "ReadFilters",
    "TableSpec", "assign_turn_index", "build_model_spans", "build_sessions", "build_tool_calls", "build_turns",
    "default_catalog", "evaluate_logs", "load_conversations", "load_events", "load_flat_events",
    "load_generation_status", "run_report", "write_reports",
]
