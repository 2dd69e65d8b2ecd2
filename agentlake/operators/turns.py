"""Turns and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import count_where, duration_ms, sum_or_zero, timestamp_of
from ..schemas import typed_null

TURN_KEYS = ["dt", "app_id", "session_id", "turn_index"]


def _count_of(event_type: str):
    return count_where(F.col("event_type") == event_type)


def _status():
    return F.when(F.col("error_count") > 0, F.lit("fail")).otherwise(F.lit("success"))


def build_turns(events: DataFrame) -> DataFrame:
    """One row per turn and day; events without a turn are left out."""
    per_turn = (
        events.withColumn("ts", timestamp_of(events))
        .where(F.col("turn_index").isNotNull())
        .groupBy(*TURN_KEYS)
        .agg(
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
            _count_of("llm_request").alias("model_spans_count"),
            _count_of("tool_call").alias("tool_calls_count"),
            _count_of("condense").alias("condense_count"),
            _count_of("todo_update").alias("todo_update_count"),
            _count_of("error").alias("error_count"),
            sum_or_zero("input_tokens").alias("input_tokens"),
            sum_or_zero("output_tokens").alias("output_tokens"),
            sum_or_zero("cache_tokens").alias("cache_tokens"),
            F.avg("ttft_ms").alias("avg_ttft_ms"),
        )
    )
    return per_turn.select(
        *TURN_KEYS, "start_ts", "end_ts",
        duration_ms(F.col("start_ts"), F.col("end_ts")).alias("duration_ms"),
        typed_null("bigint").alias("user_msg_event_id"),
        typed_null("string").alias("query_level"),
        typed_null("string").alias("mmu"),
        _status().alias("status"),
        typed_null("string").alias("finish_event_type"),
        F.col("model_spans_count").alias("react_iters"),
        "model_spans_count", "tool_calls_count", "condense_count", "todo_update_count", "error_count",
        "input_tokens", "output_tokens", "cache_tokens", "avg_ttft_ms",
        typed_null("double").alias("avg_otps"),
    )


def compact_turns(numbered: DataFrame) -> DataFrame:
    """Turns with model iterations and errors, from ``carry_turn_index`` events."""
    return (
        numbered.where(F.col("turn_index").isNotNull())
        .groupBy(*TURN_KEYS)
        .agg(_count_of("llm_request").alias("react_iters"), _count_of("error").alias("error_count"))
        .withColumn("status", _status())
    )


def errors_in_turns(numbered: DataFrame) -> DataFrame:
    """Error events that belong to a turn, from ``carry_turn_index`` events."""
    return numbered.where((F.col("event_type") == "error") & F.col("turn_index").isNotNull()).select(
        *TURN_KEYS, "error_type", "error_code"
    )
