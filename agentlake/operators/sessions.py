"""Sessions (D6, D6a, D6b, D9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_where, duration_ms, sum_or_zero, timestamp_of
from ..schemas import column_or_null, typed_null

SESSION_KEYS = ["dt", "app_id", "session_id"]


def _first_per_session(rows: DataFrame, *order) -> DataFrame:
    """First row of each session, nulls last in every order column.

    Spark keeps only the first row per session and task ahead of the shuffle
    (window group limit), so a huge session costs no more than any other.
    """
    window = Window.partitionBy("session_id").orderBy(*[c.asc_nulls_last() for c in order])
    return rows.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def first_errors(events: DataFrame) -> DataFrame:
    errors = events.where(F.col("event_type") == "error").select(
        "session_id", "turn_index", "error_type", timestamp_of(events).alias("ts"), "event_id"
    )
    first = _first_per_session(
        errors, F.col("turn_index"), F.col("ts"), F.col("event_id"), F.col("error_type")
    )
    return first.select(
        "session_id",
        F.col("turn_index").alias("first_error_turn"),
        F.col("error_type").alias("first_error_type"),
    )


def session_metadata(events: DataFrame) -> DataFrame:
    described = events.select(
        "session_id",
        *[column_or_null(events, c) for c in ("user_id", "agent_impl", "agent_version")],
        timestamp_of(events).alias("ts"),
        "event_id",
    )
    first = _first_per_session(
        described, F.col("ts"), F.col("event_id"),
        F.col("user_id"), F.col("agent_impl"), F.col("agent_version"),
    )
    return first.select("session_id", "user_id", "agent_impl", "agent_version")


def _same_session(left: str, right: str, nameless: bool) -> Column:
    return F.col(left).eqNullSafe(F.col(right)) if nameless else F.col(left) == F.col(right)


def build_sessions(turns: DataFrame, events: DataFrame, nameless: bool = True) -> DataFrame:
    """One row per session and day, with the session's first error and metadata.

    Without ``nameless``, rows without a session are left out; the joins then are by plain equality, which tables that
    are stored by session (``write_buckets``) do without a shuffle.
    """
    if not nameless:
        turns, events = (df.where(F.col("session_id").isNotNull()) for df in (turns, events))
    totals = turns.groupBy(*SESSION_KEYS).agg(
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.count("turn_index").alias("turns_count"),
        sum_or_zero("model_spans_count").alias("model_spans_count"),
        sum_or_zero("tool_calls_count").alias("tool_calls_count"),
        sum_or_zero("input_tokens").alias("total_input_tokens"),
        sum_or_zero("output_tokens").alias("total_output_tokens"),
        sum_or_zero("cache_tokens").alias("total_cache_tokens"),
    )
    # Both lookups have one row per session; joined first, they leave a single
    # join whose left side the adaptive skew join may split.
    errors = first_errors(events).withColumnRenamed("session_id", "_error_session")
    lookup = (
        session_metadata(events)
        .withColumnRenamed("session_id", "_session")
        .join(errors, _same_session("_session", "_error_session", nameless), "left")
    )
    joined = totals.join(lookup, _same_session("session_id", "_session", nameless), "left")
    return joined.select(
        *SESSION_KEYS, "user_id", "agent_impl", "agent_version", "start_ts", "end_ts",
        duration_ms(F.col("start_ts"), F.col("end_ts")).alias("duration_ms"),
        F.lit("success").alias("status"),
        typed_null("string").alias("success_reason"),
        "turns_count", "model_spans_count", "tool_calls_count",
        "total_input_tokens", "total_output_tokens", "total_cache_tokens",
        typed_null("double").alias("total_cost_usd"),
        "first_error_turn", "first_error_type",
    )


def compact_sessions(turns: DataFrame) -> DataFrame:
    """Turns and failed turns per session, from ``compact_turns``."""
    return turns.groupBy(*SESSION_KEYS).agg(
        F.count("*").alias("turns_count"),
        count_where(F.col("status") == "fail").alias("error_turns"),
    )
