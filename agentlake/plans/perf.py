"""Durations, event kinds and throughput per app."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import round2


def duration_summary(generation_status: DataFrame) -> DataFrame:
    # Zero rounds give null rather than an error or infinity.
    per_round = round2(F.try_divide("duration_s", "react_rounds"))
    return generation_status.select(
        "app_id", "app_status", "app_type", "duration_s", "react_rounds",
        F.when(F.col("duration_s") > 0, per_round).alias("seconds_per_round"),
    ).orderBy(F.desc_nulls_last("duration_s"), F.asc_nulls_last("app_id"))


def action_distribution(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("event_type").isNotNull())
        .groupBy("app_id", "event_type")
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.asc_nulls_last("app_id"), F.desc("event_count"), F.asc("event_type"))
    )


def throughput(events: DataFrame, generation_status: DataFrame) -> DataFrame:
    """Tokens per second of each session, by the duration of its app.

    Apps without such sessions appear once, without tokens. One app may own a
    large share of the sessions; in an outer join that side could not be split,
    so sessions and apps meet in an inner join and the other apps are added.
    """
    counted = events.where(F.col("output_tokens").isNotNull())
    sessions = counted.groupBy(F.col("app_id").alias("_app"), "session_id").agg(
        F.max("output_tokens").alias("completion_tokens"),
        F.max("input_tokens").alias("prompt_tokens"),
    )
    apps = generation_status.select("app_id", "duration_s")
    active = sessions.select(F.col("_app").alias("_active")).distinct()
    matched = sessions.join(apps, F.col("_app") == F.col("app_id"))
    silent = apps.join(active, F.col("app_id") == F.col("_active"), "left_anti")

    columns = ["app_id", "duration_s", "completion_tokens", "prompt_tokens"]
    rows = matched.select(*columns).unionByName(silent, allowMissingColumns=True)

    def per_second(tokens):
        return F.when(F.col("duration_s") > 0, round2(tokens / F.col("duration_s")))

    total = sum(F.coalesce(F.col(c), F.lit(0)) for c in ("completion_tokens", "prompt_tokens"))
    return rows.select(
        *columns,
        per_second(F.col("completion_tokens")).alias("output_tokens_per_sec"),
        per_second(total).alias("total_tokens_per_sec"),
    ).orderBy(
        F.asc_nulls_last("app_id"),
        F.desc_nulls_last("completion_tokens"),
        F.desc_nulls_last("prompt_tokens"),
    )
