"""Declared schemas of the event table and of the loaded metadata tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType()}


def _schema(columns: str) -> T.StructType:
    """Flat schema of ``name TYPE`` pairs; unlike DDL parsing it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Names and order of the columns.
EVENT_SCHEMA = _schema(
    """
    dt STRING, app_id STRING, session_id STRING, event_id BIGINT, ts STRING,
    event_type STRING, source STRING, turn_index BIGINT, agent_id STRING,
    request_id STRING, model STRING, provider STRING,
    input_tokens BIGINT, output_tokens BIGINT, cache_tokens BIGINT,
    ttft_ms DOUBLE, latency_ms DOUBLE,
    tool_name STRING, tool_latency_ms DOUBLE, exit_code INT,
    error_type STRING, error_code STRING,
    accumulated_cost DOUBLE, payload STRING
    """
)
GENERATION_STATUS_SCHEMA = _schema(
    "app_id STRING, app_status STRING, app_type STRING, "
    "duration_s DOUBLE, react_rounds BIGINT, first_query STRING"
)
CONVERSATIONS_SCHEMA = _schema(
    "app_id STRING, session_id STRING, llm_model STRING, total_tokens BIGINT, "
    "prompt_tokens BIGINT, completion_tokens BIGINT, accumulated_cost DOUBLE, created_at STRING"
)


def conform(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """Columns of ``schema`` in its order and types, then ``more`` ones; absent ones become nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ],
        *more,
    )


def column_or_null(df: DataFrame, name: str, type_name: str = "string") -> Column:
    """Column ``name``, or a typed null when ``df`` does not carry it."""
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(type_name).alias(name)


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)
