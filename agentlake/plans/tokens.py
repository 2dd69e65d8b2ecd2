"""Token use of conversations (A1-A3).

All reports are ordered as their readers expect. Each order ends in columns
that tell the rows of one leading value apart: Spark sorts by ranges of the
whole key, so one value that holds much of the data is still spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles

MEASURES = {
    "total_tokens": "total_tokens",
    "prompt_tokens": "prompt_tokens",
    "completion_tokens": "completion_tokens",
    "accumulated_cost": "cost",
}


def token_summary(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        "app_id", "session_id", "llm_model",
        "total_tokens", "prompt_tokens", "completion_tokens", "accumulated_cost",
    ).orderBy(F.asc_nulls_last("app_id"), F.asc_nulls_last("session_id"))


def token_distribution(conversations: DataFrame) -> DataFrame:
    """One row of minima, exact quartiles, means and maxima."""
    wanted = {c: [0.25, 0.5, 0.75] if c == "total_tokens" else [0.5] for c in MEASURES}
    key = F.concat_ws("@", "metric", F.col("q").cast("string"))
    # At most six entries, read as a scalar subquery next to the plain aggregates.
    quantiles = exact_quantiles(conversations, wanted).agg(
        F.map_from_entries(F.collect_list(F.struct(key, "value"))).alias("by_key")
    )

    plain = []
    for column, name in MEASURES.items():
        plain += [
            F.min(column).alias(f"min_{name}"),
            F.avg(column).alias(f"mean_{name}"),
            F.max(column).alias(f"max_{name}"),
        ]
    with_quantiles = conversations.agg(*plain).withColumn("_q", quantiles.scalar())

    def quantile(column: str, q: float, label: str):
        return F.col("_q")[f"{column}@{q}"].alias(f"{label}_{MEASURES[column]}")

    columns = []
    for column, name in MEASURES.items():
        quartiles = column == "total_tokens"
        columns += [
            F.col(f"min_{name}"),
            *([quantile(column, 0.25, "q1")] if quartiles else []),
            quantile(column, 0.5, "median"),
            F.col(f"mean_{name}"),
            *([quantile(column, 0.75, "q3")] if quartiles else []),
            F.col(f"max_{name}"),
        ]
    return with_quantiles.select(*columns)


def model_breakdown(conversations: DataFrame) -> DataFrame:
    return (
        conversations.groupBy("llm_model")
        .agg(
            F.count("*").alias("conversation_count"),
            F.sum("total_tokens").alias("total_tokens"),
            F.sum("prompt_tokens").alias("total_prompt_tokens"),
            F.sum("completion_tokens").alias("total_completion_tokens"),
            F.sum("accumulated_cost").alias("total_cost"),
            F.avg("total_tokens").alias("avg_tokens_per_conv"),
            F.avg("accumulated_cost").alias("avg_cost_per_conv"),
        )
        .orderBy(F.desc_nulls_last("total_tokens"), F.asc_nulls_last("llm_model"))
    )
