"""Success, rounds, tools, cost and delegation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import payload_value, round2


def success_summary(generation_status: DataFrame) -> DataFrame:
    # There are few statuses: the total is the sum of their counts.
    counts = generation_status.groupBy("app_status").agg(F.count("*").alias("app_count"))
    total = counts.agg(F.sum("app_count")).scalar()
    return (
        counts.withColumn("pct", round2(F.col("app_count").cast("double") * 100.0 / total))
        .orderBy(F.desc("app_count"), F.asc_nulls_last("app_status"))
    )


def react_analysis(generation_status: DataFrame) -> DataFrame:
    """Rounds per app next to the extremes and mean over all apps.

    The overall values are one aggregate read as scalars: a window over all
    rows would put them into a single task.
    """
    rounds = F.col("react_rounds")

    def overall(aggregate):
        return generation_status.agg(aggregate).scalar()

    per_round = round2(F.try_divide("duration_s", "react_rounds"))
    return generation_status.select(
        "app_id", "app_status", "react_rounds", "duration_s",
        F.when(rounds > 0, per_round).alias("seconds_per_round"),
        overall(F.min("react_rounds")).alias("min_rounds"),
        overall(F.avg("react_rounds")).alias("avg_rounds"),
        overall(F.max("react_rounds")).alias("max_rounds"),
    ).orderBy(F.desc_nulls_last("react_rounds"), F.asc_nulls_last("app_id"))


def tool_usage(events: DataFrame) -> DataFrame:
    """Calls and sessions of each tool. Of events with a ``session_number`` (see ``with_session_numbers``) sessions are counted
    by bitmaps: tasks send a few kilobytes for each tool and 32,768 sessions instead of a row for each tool and session."""
    calls = events.where(F.col("tool_name").isNotNull())
    if "session_number" in events.columns:
        number = F.col("session_number")
        maps = calls.groupBy("tool_name", F.bitmap_bucket_number(number).alias("bucket")).agg(
            F.count("*").alias("calls"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(number))).alias("sessions"))
        counted = maps.groupBy("tool_name").agg(
            F.sum("calls").alias("call_count"), F.sum(F.when(F.col("bucket").isNotNull(), F.col("sessions")).otherwise(0)).alias("sessions_used"))
    else:
        counted = calls.groupBy("tool_name").agg(F.count("*").alias("call_count"), F.count_distinct("session_id").alias("sessions_used"))
    return counted.orderBy(F.desc("call_count"), F.asc("tool_name"))


def cost_efficiency(conversations: DataFrame, generation_status: DataFrame) -> DataFrame:
    apps = generation_status.select(F.col("app_id").alias("_app"), "react_rounds", "duration_s")
    cost, rounds = F.col("accumulated_cost"), F.col("react_rounds")
    return (
        conversations.join(apps, F.col("app_id") == F.col("_app"), "left")
        .select(
            "app_id", "session_id", "accumulated_cost", "total_tokens", "react_rounds", "duration_s",
            F.when(rounds > 0, round2(F.try_divide(cost, rounds))).alias("cost_per_round"),
            F.when(cost > 0, round2(F.try_divide("total_tokens", cost))).alias("tokens_per_cost_unit"),
        )
        .orderBy(
            F.desc_nulls_last("accumulated_cost"),
            F.asc_nulls_last("app_id"),
            F.asc_nulls_last("session_id"),
        )
    )


def agent_delegation(events: DataFrame) -> DataFrame:
    """``payload`` may be text or VARIANT (see ``parsed_payload``)."""
    agent = payload_value(events, "$.content.args.agent")
    return (
        events.where(F.col("event_type") == "delegate")
        .select("app_id", "session_id", agent.alias("delegated_agent"))
        .where(F.col("delegated_agent").isNotNull())
        .groupBy("app_id", "session_id", "delegated_agent")
        .agg(F.count("*").alias("delegation_count"))
        .orderBy(
            F.desc("delegation_count"),
            *[F.asc_nulls_last(c) for c in ("app_id", "session_id", "delegated_agent")],
        )
    )
