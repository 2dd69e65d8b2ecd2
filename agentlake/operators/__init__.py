from .apply import (
    BatchOperator,
    BuildSessions,
    BuildTurnsAndErrors,
    Operator,
    apply,
    batch_sql,
    map_pandas,
)
from .groups import GroupBatchOperator
from .pairs import build_model_spans, build_tool_calls
from .sessions import build_sessions, compact_sessions, first_errors, session_metadata
from .turn_index import assign_turn_index, carry_turn_index
from .turns import build_turns, compact_turns, errors_in_turns

__all__ = [
    "BatchOperator", "BuildSessions", "BuildTurnsAndErrors", "GroupBatchOperator", "Operator", "apply",
    "assign_turn_index", "batch_sql", "build_model_spans", "build_sessions", "build_tool_calls",
    "build_turns", "carry_turn_index", "compact_sessions", "compact_turns", "errors_in_turns",
    "first_errors", "map_pandas", "session_metadata",
]
