"""Request/response pairs: model spans (D3) and tool calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import typed_null


def _pair(events: DataFrame, opening: str, closing: str, carried: list[str], answered: list[str]) -> DataFrame:
    """Inner join of opening and closing events on ``request_id``.

    Every combination of equal ids is kept. Rows without an id never pair up
    and do not reach the shuffle. A much repeated id is split by Spark's adaptive skew join.
    """
    left = events.where(F.col("event_type") == opening).select(
        "dt", "app_id", "session_id", "turn_index", "agent_id", "request_id",
        F.col("ts").alias("start_ts"), *carried,
    )
    right = events.where(F.col("event_type") == closing).select(
        F.col("request_id").alias("_closing_id"), F.col("ts").alias("end_ts"), *answered
    )
    return left.join(right, F.col("request_id") == F.col("_closing_id"))


def build_model_spans(events: DataFrame) -> DataFrame:
    spans = _pair(
        events, "llm_request", "llm_response",
        ["model", "provider", "input_tokens", "cache_tokens"],
        ["ttft_ms", "latency_ms", "output_tokens"],
    )
    # A null latency must stay null, so `greatest` is no option.
    latency = F.when(F.col("latency_ms") < 1, F.lit(1.0)).otherwise(F.col("latency_ms").cast("double"))
    return spans.select(
        "dt", "app_id", "session_id", "turn_index",
        F.col("request_id").alias("span_id"),
        typed_null("string").alias("parent_span_id"),
        "agent_id", "model", "provider", "start_ts", "end_ts", "ttft_ms", "latency_ms",
        "input_tokens", "output_tokens", "cache_tokens",
        (F.col("output_tokens") * F.lit(1000.0) / latency).alias("otps"),
        typed_null("bigint").alias("tool_intents_count"),
        F.lit(False).alias("malformed_tool_call"),
    )


def build_tool_calls(events: DataFrame) -> DataFrame:
    calls = _pair(
        events, "tool_call", "tool_result",
        ["tool_name"], ["tool_latency_ms", "exit_code", "error_type"],
    )
    clean = F.coalesce(F.col("exit_code"), F.lit(0)) == 0
    return calls.select(
        "dt", "app_id", "session_id", "turn_index",
        F.col("request_id").alias("tool_call_id"),
        typed_null("string").alias("parent_span_id"),
        "agent_id", "tool_name", "start_ts", "end_ts", "tool_latency_ms",
        F.when(clean, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        "exit_code", "error_type",
        typed_null("boolean").alias("patch_applied"),
        typed_null("string").alias("patch_reject_reason"),
        typed_null("double").alias("read_accuracy_score"),
        typed_null("string").alias("artifacts"),
    )
