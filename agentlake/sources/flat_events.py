"""Flat event logs: JSON lines with one event per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import event_date
from ..schemas import EVENT_SCHEMA, conform

# Fields of the flat log format.
FLAT_FIELDS = """
    timestamp STRING, conversation_id STRING, event_type STRING, request_id STRING,
    model STRING, provider STRING, input_tokens BIGINT, output_tokens BIGINT, cache_tokens BIGINT,
    ttft_ms DOUBLE, latency_ms DOUBLE, tool_name STRING, tool_latency_ms DOUBLE, exit_code INT
"""


def load_flat_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Event table of flat JSON-lines files; what a line lacks becomes null.

    The format has no event ids: ``event_id`` is a number that ascends with the lines of a file, so that events of one
    second keep their order.
    """
    lines = spark.read.schema(FLAT_FIELDS).option("mode", "FAILFAST").json(path)
    rows = lines.withColumnsRenamed({"timestamp": "ts", "conversation_id": "session_id"})
    rows = rows.withColumn("event_id", F.monotonically_increasing_id())
    return conform(rows.withColumn("dt", event_date(F.col("ts"))), EVENT_SCHEMA)
