"""Comparison of session treatments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def condense_impact(
    turns: DataFrame, session_treatments: DataFrame, app_id: str, dt_from: str, dt_to: str
) -> DataFrame:
    """Averages per variant over the turns of one app and an inclusive range of days."""
    chosen = turns.where((F.col("app_id") == app_id) & F.col("dt").between(dt_from, dt_to)).select(
        "session_id", "react_iters", "duration_ms", "input_tokens"
    )
    return (
        chosen.join(session_treatments.select("session_id", "variant"), "session_id")
        .groupBy("variant")
        .agg(
            F.avg("react_iters").alias("avg_react_iters"),
            F.avg("duration_ms").alias("avg_turn_ms"),
            F.avg("input_tokens").alias("avg_in_tokens"),
        )
        .orderBy(F.asc_nulls_last("avg_react_iters"), F.asc_nulls_last("variant"))
    )


def condense_rows(turns: DataFrame, session_treatments: DataFrame, app_id: str) -> DataFrame:
    """The joined turns and treatments of one app, over all days and not aggregated."""
    own = F.col("app_id") == app_id
    return turns.where(own).join(session_treatments.where(own).drop("app_id"), "session_id")
