"""Column expressions shared by loaders, derivations and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Actions that count as a tool call, and actions and observations
# whose event type is their own name.
TOOL_ACTIONS = ("run", "read", "write", "edit", "call_tool_mcp", "mcp")
NAMED_ACTIONS = ("delegate", "message", "think", "finish", "agent_state_changed")


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def round2(value: Column) -> Column:
    """Two decimals by scaling the binary value (1.005 -> 1.0), as SQL engines
    working on doubles do; ``F.round(x, 2)`` rounds the decimal text instead."""
    return F.round(value * F.lit(100.0), 0) / F.lit(100.0)


def known_event_type(verb: Column) -> Column:
    return F.when(verb.isin(*TOOL_ACTIONS), F.lit("tool_call")).when(verb.isin(*NAMED_ACTIONS), verb)


def event_type(action: Column, observation: Column) -> Column:
    """A known action wins, then a known observation, then the raw observation,
    the raw action and finally ``unknown``; blanks count as missing."""
    action, observation = blank_to_null(action), blank_to_null(observation)
    return F.coalesce(
        known_event_type(action), known_event_type(observation), observation, action, F.lit("unknown")
    )


def event_date(ts: Column) -> Column:
    return F.coalesce(F.substring(blank_to_null(ts), 1, 10), F.lit("1970-01-01"))


def timestamp_of(df: DataFrame, name: str = "ts") -> Column:
    """``name`` as a timestamp; ISO text is parsed, unreadable text becomes null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("timestamp")
    return F.col(name)


def micros_of(df: DataFrame, name: str = "ts") -> Column:
    """Microseconds since a fixed origin, for timestamps with or without zone."""
    ts = timestamp_of(df, name)
    zoneless = isinstance(df.schema[name].dataType, T.TimestampNTZType)
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz" if zoneless else "timestamp")
    return F.timestamp_diff("MICROSECOND", origin, ts)


def duration_ms(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1000.0)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_or_zero(value: Column | str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


def parsed_payload(events: DataFrame) -> DataFrame:
    """Events with ``payload`` as VARIANT, parsed once: reports then go to a path in it without reading text again. Texts
    that are no JSON, or name a field twice, become null."""
    return events.withColumn("payload", F.try_parse_json("payload"))


def payload_value(events: DataFrame, path: str) -> Column:
    """The value at a path of ``payload`` as text, be it text or VARIANT; null where there is none."""
    if isinstance(events.schema["payload"].dataType, T.VariantType):
        return F.try_variant_get("payload", path, "string")
    return F.get_json_object("payload", path)
