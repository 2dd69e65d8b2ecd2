"""One query per operator, over the tables of ``fixtures``.

Each takes (spark, sf_dir), reads its source tables whole and returns a lazy
DataFrame. Queries about files write their table first, then read it back.
"""

from __future__ import annotations

import functools
import unicodedata
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import event_type, parsed_payload
from .operators import (
    BatchOperator,
    BuildSessions,
    BuildTurnsAndErrors,
    GroupBatchOperator,
    apply,
    assign_turn_index,
    batch_sql,
    build_model_spans,
    build_sessions,
    build_tool_calls,
    build_turns,
    carry_turn_index,
    compact_sessions,
    compact_turns,
    errors_in_turns,
    first_errors,
    map_pandas,
    session_metadata,
)
from .operators.slices import Slicing
from .plans import evaluation, perf, run_report, tokens, treatments
from .scratch import scratch_path, stored
from .sources import (
    Catalog,
    Lake,
    ReadFilters,
    SnapshotStore,
    TableSpec,
    load_events,
    load_flat_events,
    with_session_numbers,
    write_buckets,
    write_reports,
)
from .sources.json_tree import (
    APP_ID_FIELD,
    CONVERSATION_FIELDS,
    STATUS_FIELDS,
    array_elements,
    array_records,
    attach_model,
    conversation_models,
    flatten_conversations,
    flatten_events,
    flatten_generation_status,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAYS = ("2024-01-05", "2024-01-25")


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


# --- derivations ---------------------------------------------------------------------------


@query
def turn_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_turn_index(fx.raw_events(spark, sf_dir)).select(
        "dt", "app_id", "session_id", "event_id", "ts", "event_type", "turn_index"
    )


@query
def turn_index_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carry_turn_index(fx.raw_events(spark, sf_dir)).select(
        "dt", "app_id", "session_id", "event_id", "ts", "event_type", "turn_index"
    )


def _crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in three sessions, which are cut at a thousand events."""
    return fx.raw_events(spark, sf_dir).withColumn("session_id", F.concat(F.lit("hot-"), (F.col("event_id") % 3).cast("string")))


CUT = Slicing(crowded_rows=1000)


@query
def turn_index_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_turn_index(_crowded(spark, sf_dir), CUT).select(
        "dt", "app_id", "session_id", "event_id", "ts", "event_type", "turn_index"
    )


@query
def turn_index_explicit_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carry_turn_index(_crowded(spark, sf_dir), CUT).select(
        "dt", "app_id", "session_id", "event_id", "ts", "event_type", "turn_index"
    )


@query
def model_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_model_spans(fx.raw_events(spark, sf_dir))


@query
def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_tool_calls(fx.raw_events(spark, sf_dir))


@query
def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_turns(assign_turn_index(fx.raw_events(spark, sf_dir)))


@query
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = assign_turn_index(fx.raw_events(spark, sf_dir))
    return build_sessions(build_turns(events), events)


@query
def first_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_errors(assign_turn_index(fx.raw_events(spark, sf_dir)))


@query
def session_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_metadata(fx.raw_events(spark, sf_dir))


@query
def turns_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_turns(carry_turn_index(fx.raw_events(spark, sf_dir)))


@query
def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors_in_turns(carry_turn_index(fx.raw_events(spark, sf_dir)))


@query
def sessions_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_sessions(turns_compact(spark, sf_dir))


# --- reports -------------------------------------------------------------------------------


@query
def token_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_summary(fx.conversation_meta(spark, sf_dir))


@query
def token_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_distribution(fx.conversation_meta(spark, sf_dir))


@query
def model_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.model_breakdown(fx.conversation_meta(spark, sf_dir))


@query
def duration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perf.duration_summary(fx.generation_status(spark, sf_dir))


@query
def action_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perf.action_distribution(fx.raw_events(spark, sf_dir))


@query
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perf.throughput(fx.raw_events(spark, sf_dir), fx.generation_status(spark, sf_dir))


@query
def success_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.success_summary(fx.generation_status(spark, sf_dir))


@query
def react_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.react_analysis(fx.generation_status(spark, sf_dir))


@query
def tool_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.tool_usage(fx.raw_events(spark, sf_dir))


@query
def cost_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.cost_efficiency(
        fx.conversation_meta(spark, sf_dir), fx.generation_status(spark, sf_dir)
    )


@query
def agent_delegation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.agent_delegation(fx.raw_events(spark, sf_dir))


@query
def agent_delegation_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From stored events whose payload is VARIANT."""
    events = fx.raw_events(spark, sf_dir).select("app_id", "session_id", "event_type", "payload")
    return evaluation.agent_delegation(stored(parsed_payload(events)))


@query
def tool_usage_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From stored events with numbers of their sessions, counted by bitmaps."""
    events = fx.raw_events(spark, sf_dir).select("session_id", "tool_name")
    return evaluation.tool_usage(stored(with_session_numbers(events)))


@query
def sessions_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From events and turns that are stored in buckets by session."""
    name = f"agentlake_{uuid.uuid4().hex}"
    events = write_buckets(assign_turn_index(fx.raw_events(spark, sf_dir)), f"{name}_events", 8)
    turns = write_buckets(build_turns(events), f"{name}_turns", 8)
    return build_sessions(turns, events, nameless=False)


def _one_app(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Turns and treatments with all sessions in one app, the one to report on."""
    events = fx.raw_events(spark, sf_dir).withColumn("app_id", F.lit("app-all"))
    return build_turns(assign_turn_index(events)), fx.session_treatments(events)


@query
def condense_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treatments.condense_impact(*_one_app(spark, sf_dir), "app-all", *DAYS)


@query
def condense_join_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treatments.condense_rows(*_one_app(spark, sf_dir), "app-all")


# --- loaders -------------------------------------------------------------------------------


def _pick(values: list[str | None], number: Column) -> Column:
    """The value at ``number`` modulo the list's length."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), (number % len(values)).cast("int"))


VERBS = [
    "run", "read", "write", "edit", "call_tool_mcp", "mcp", "delegate", "message", "think", "finish",
    "agent_state_changed", "browse", "", None,
]


def _verbs(k: Column, event_id: Column) -> tuple[Column, Column]:
    """Action and observation: every known verb, unknown ones, blanks and nulls."""
    return _pick(VERBS, k), _pick([None, "", "run_output", *VERBS], event_id)


def _source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )


def _event_elements(spark: SparkSession, sf_dir: str, dirs: tuple[Column, Column] | None = None) -> DataFrame:
    """Nested events as JSON text, with all kinds of missing parts, and their directories."""
    k, event_id, user = F.col("k"), F.col("event_id"), F.col("user_id").cast("string")
    action, observation = _verbs(k, event_id)
    usage = F.struct(
        (k * 10).alias("prompt_tokens"),
        k.alias("completion_tokens"),
        F.when(k % 2 == 0, k + 1).alias("cache_read_tokens"),
    )
    metrics = F.struct((k / 4.0).alias("accumulated_cost"), usage.alias("accumulated_token_usage"))
    content = F.struct(
        F.when(k % 10 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("timestamp"),
        _pick(["user", "agent", "", None], k).alias("source"),
        action.alias("action"),
        observation.alias("observation"),
        F.when(k % 4 != 0, metrics).alias("llm_metrics"),
    )
    ext = F.struct(
        _pick([None, "", "own-app"], k).alias(APP_ID_FIELD),
        _pick(["ext-source", None], k).alias("source"),
        F.concat(F.lit("agent"), (k % 3).cast("string")).alias("agent_name"),
    )
    event = F.struct(
        F.when(event_id % 9 != 0, event_id).alias("event_id"),
        F.when(k % 5 != 0, F.concat(F.lit("s-"), user)).otherwise(F.lit("")).alias("session_id"),
        F.when(event_id % 7 != 0, ext).alias("ext"),
        F.when(event_id % 11 != 0, content).alias("content"),
    )
    app_dir, conv_dir = dirs or (
        F.concat(F.lit("app-"), user), F.concat(F.lit("conv-"), user, F.lit("-"), (event_id % 3).cast("string"))
    )
    return _source_events(spark, sf_dir).select(
        app_dir.alias("app_dir"), conv_dir.alias("conv_dir"), F.to_json(event).alias("element"), event_id.alias("place")
    )


def _conversation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metadata records per session of ``_event_elements``; some miss its id."""
    user, part = F.col("user_id").cast("string"), F.col("part").cast("string")
    prefix = F.when(F.col("user_id") % 7 == 0, "moved-").otherwise("conv-")
    conv_dir = F.concat(prefix, user, F.lit("-"), part)

    def record(position: int) -> Column:
        fields = F.struct(
            F.when(part != "1", conv_dir).otherwise(F.lit("")).alias("conversation_id"),
            F.when(part == "1", conv_dir).alias("id"),
            F.concat(F.lit("model-"), part, F.lit(f"-{position}")).alias("llm_model"),
        )
        return F.to_json(fields)

    return (
        fx.table(spark, sf_dir, "events")
        .select("user_id", (F.col("event_id") % 3).alias("part"))
        .distinct()
        .select(
            F.concat(F.lit("app-"), user).alias("app_dir"),
            F.lit("").alias("conv_dir"),
            F.concat(F.lit("["), record(0), F.lit(", "), record(1), F.lit("]")).alias("text"),
        )
    )


@query
def event_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    action, observation = _verbs(F.col("k"), F.col("event_id"))
    return _source_events(spark, sf_dir).select(
        "event_id", event_type(action, observation).alias("event_type")
    )


def _comparable(events: DataFrame) -> DataFrame:
    """Event rows; of the payload text its event id is compared."""
    payload_id = F.get_json_object("payload", "$.event_id").cast("bigint")
    return events.withColumn("payload_event_id", payload_id).drop(
        "app_dir", "conv_dir", "payload", "turn_index"
    )


@query
def flatten_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(flatten_events(_event_elements(spark, sf_dir))).drop("model")


@query
def attach_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = conversation_models(array_records(_conversation_files(spark, sf_dir), CONVERSATION_FIELDS))
    events = attach_model(flatten_events(_event_elements(spark, sf_dir)), models)
    return events.select("app_dir", "conv_dir", "event_id", "event_type", "model")


@query
def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of array files (of two events each) becomes events with models."""
    element = F.col("element")
    files = _event_elements(spark, sf_dir).select(
        "app_dir",
        "conv_dir",
        F.concat(F.lit("[ "), element, F.lit(" ,\n"), element, F.lit("]\n")).alias("text"),
    )
    events = flatten_events(array_elements(files))
    return _comparable(attach_model(events, None, model_override="model-x")).drop("position")


def _written_tree(spark: SparkSession, sf_dir: str) -> str:
    """Events and metadata written as a tree of JSON files by the executors.

    Each file holds the events of one app out of 5000 ids, so files don't grow with the data.
    """
    root = scratch_path(spark)
    part = F.floor(F.col("event_id") / 5000).cast("string")
    dirs = (F.concat(F.lit("app-"), (F.col("user_id") % 50).cast("string")), F.concat(F.lit("conv-"), part))
    events = _event_elements(spark, sf_dir, dirs)
    fx.write_arrays(events.withColumn("path", F.concat_ws("/", "app_dir", "conv_dir", F.lit("events.json"))), root, ",\n")
    name = F.when(F.substring_index("app_dir", "-", -1).cast("int") % 7 != 0, F.col("conv_dir")).otherwise("moved")
    records = [
        F.to_json(F.struct(name.alias("conversation_id"), F.concat(F.lit("model-"), F.substring_index("conv_dir", "-", -1), F.lit(f"-{k}")).alias("llm_model")))
        for k in range(2)
    ]
    apps = events.select("app_dir", "conv_dir").distinct().select("app_dir", "conv_dir", F.posexplode(F.array(*records)).alias("k", "element"))
    fx.write_arrays(apps.select(
        F.concat_ws("/", "app_dir", F.lit("conversations.json")).alias("path"), F.struct("conv_dir", "k").alias("place"), "element",
    ), root, ",")
    return root


def _with_action(events: DataFrame) -> DataFrame:
    return _comparable(events.select("*", F.get_json_object("payload", "$.content.action").alias("payload_action")))


@query
def log_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of JSON files, loaded file by file."""
    return _with_action(load_events(spark, _written_tree(spark, sf_dir)))


@query
def log_tree_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree, each file of more than four kilobytes loaded in ranges of as many bytes."""
    return _with_action(load_events(spark, _written_tree(spark, sf_dir), whole_bytes=4096))


@query
def nested_rounds_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.floor(F.col("o_totalprice"))
    rounds = F.struct(price.alias("duration"), (key % 5).alias("react_rounds"))
    unknown = F.struct(F.lit(None).cast("bigint").alias("duration"), F.lit(1).cast("bigint").alias("react_rounds"))
    nothing = F.lit(None).cast("struct<duration: bigint, react_rounds: bigint>")
    entry = F.struct(
        F.when(key % 3 != 0, F.concat(F.lit("order-"), key.cast("string"))).alias("app_id"),
        F.col("o_orderstatus").alias("app_status"),
        F.col("o_orderpriority").alias("app_type"),
        F.when(key % 7 != 0, F.array(rounds, nothing, unknown, rounds)).alias("react_detail_list"),
        F.lit("first").alias("first_query"),
    )
    files = fx.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("app-"), F.col("o_custkey").cast("string")).alias("app_dir"),
        F.lit("").alias("conv_dir"),
        F.concat(F.lit("["), F.to_json(entry), F.lit("]")).alias("text"),
    )
    return flatten_generation_status(array_records(files, STATUS_FIELDS))


@query
def conversation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    name = F.concat(F.lit("conv-"), key.cast("string"))
    ext = F.struct(
        F.when(key % 2 == 0, F.concat(F.lit("own-"), F.col("o_custkey").cast("string"))).alias(APP_ID_FIELD)
    )
    record = F.struct(
        F.when(key % 5 != 0, name).alias("conversation_id"),
        name.alias("id"),
        F.col("o_orderpriority").alias("llm_model"),
        F.when(key % 13 != 0, F.floor("o_totalprice")).alias("total_tokens"),
        F.floor(F.col("o_totalprice") / 2).alias("prompt_tokens"),
        F.floor(F.col("o_totalprice") / 4).alias("completion_tokens"),
        (F.floor("o_totalprice") / 8.0).alias("accumulated_cost"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.when(key % 3 != 0, ext).alias("ext"),
    )
    files = fx.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("app-"), F.col("o_custkey").cast("string")).alias("app_dir"),
        F.lit("").alias("conv_dir"),
        F.concat(F.lit("["), F.to_json(record), F.lit("]")).alias("text"),
    )
    return flatten_conversations(array_records(files, CONVERSATION_FIELDS))


@query
def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as JSON lines and loaded again."""
    path = scratch_path(spark)
    fx.raw_events(spark, sf_dir).select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("session_id").alias("conversation_id"),
        "event_type", "request_id", "model", "provider", "input_tokens", "output_tokens",
        "cache_tokens", "ttft_ms", "latency_ms", "tool_name", "tool_latency_ms", "exit_code",
    ).write.json(path)
    return load_flat_events(spark, path).select(
        "dt", "session_id", "ts", "event_type", "request_id", "model", "provider", "input_tokens",
        "output_tokens", "cache_tokens", "ttft_ms", "latency_ms", "tool_name", "tool_latency_ms",
        F.col("exit_code").cast("bigint").alias("exit_code"),
    )


# --- lake ----------------------------------------------------------------------------------


def _written_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A new lake with the events partitioned by day."""
    spec = TableSpec("raw_events", scratch_path(spark), partition_keys=("dt",))
    lake = Lake(spark, Catalog([spec]))
    lake.write(fx.raw_events(spark, sf_dir), "raw_events", partition_by=["dt"], mode="overwrite")
    return lake


@query
def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events replace all of them, then the other half is appended."""
    lake, events = _written_lake(spark, sf_dir), fx.raw_events(spark, sf_dir)
    for rest, mode in ((0, "overwrite"), (1, "append")):
        lake.write(events.where(F.col("event_id") % 2 == rest), "raw_events", partition_by=["dt"], mode=mode)
    return lake.read("raw_events")


@query
def read_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = ReadFilters(dt_from=DAYS[0], dt_to=DAYS[1])
    return _written_lake(spark, sf_dir).read(
        "raw_events", filters=days, columns=["dt", "session_id", "event_id", "event_type"]
    )


@query
def read_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span of days of some groups of apps, from a lake with a partition for each day and group: only their directories
    are listed."""
    spec = TableSpec("turns", scratch_path(spark), partition_keys=("dt", "app_id"))
    lake = Lake(spark, Catalog([spec]))
    group = F.concat(F.lit("app-"), F.right("app_id", F.lit(1))).alias("app_id")
    lake.write(fx.raw_events(spark, sf_dir).select("dt", group, "session_id", "event_id"), "turns", partition_by=["dt", "app_id"])
    parts = [lake.read("turns", filters=ReadFilters(dt_from=DAYS[0], dt_to=DAYS[1], app_id=f"app-{k}")) for k in (2, 5)]
    parts.append(lake.dataset("turns", {"dt": "2024-01-28", "app_id": "app-3"}))
    whole = functools.reduce(DataFrame.unionByName, parts)
    return whole.groupBy("dt", "app_id").agg(F.count("*").alias("events"), F.countDistinct("session_id").alias("sessions"))


@query
def snapshot_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written in three steps with a replacement between, read as of every version; folders are then made one."""
    store, events = SnapshotStore(spark, scratch_path(spark)), fx.raw_events(spark, sf_dir)
    part = lambda rest: events.where(F.col("event_id") % 3 == rest).select("dt", "event_id", "event_type", "input_tokens")
    for rest, mode in ((0, "append"), (1, "overwrite"), (2, "append")):
        store.write({"raw_events": part(rest)}, partition_by={"raw_events": ["dt"]}, mode=mode)
    store.compact("raw_events")
    versions = [store.read("raw_events", version=v).withColumn("version", F.lit(v)) for v in store.versions()]
    return functools.reduce(DataFrame.unionByName, versions).groupBy("version", "dt", "event_type").agg(
        F.count("*").alias("events"), F.sum("event_id").alias("event_ids"), F.sum("input_tokens").alias("input_tokens"))


@query
def equality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"event_type": "llm_response", "agent_id": "agent1", "tool_name": None}
    return _written_lake(spark, sf_dir).dataset("raw_events", wanted).select(
        "event_id", "agent_id", "event_type", "output_tokens"
    )


@query
def sql_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _written_lake(spark, sf_dir)
    lake.view("raw_events")
    return lake.sql(
        """
        SELECT app_id, count(*) AS large_requests, max(input_tokens) AS largest
        FROM raw_events WHERE input_tokens >= ? AND dt BETWEEN ? AND ? GROUP BY app_id
        """,
        [100, *DAYS],
    )


@query
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as JSON records and read back."""
    path = scratch_path(spark)
    report = duration_summary(spark, sf_dir)
    write_reports({"perf_metrics": {"duration_summary": report}}, path)
    return spark.read.schema(report.schema).json(f"{path}/perf_metrics/duration_summary")


# --- extension points ----------------------------------------------------------------------


@query
def apply_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = apply(BuildTurnsAndErrors(), fx.raw_events(spark, sf_dir))["turns"]
    return apply(BuildSessions(), turns)["sessions"]


@query
def apply_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs written by one pass."""
    found = apply(BuildTurnsAndErrors(), fx.raw_events(spark, sf_dir), folder=scratch_path(spark))
    keys = ["dt", "app_id", "session_id", "turn_index"]
    turns = found["turns"].select(*keys, F.lit("turn").alias("output"), F.col("status").alias("value"))
    errors = found["errors"].select(*keys, F.lit("error").alias("output"), F.col("error_type").alias("value"))
    return turns.unionByName(errors)


class Composed(BatchOperator):
    """Unicode text with letters and marks composed, which Spark has no function for."""

    schemas = {"composed": "event_id BIGINT, label STRING"}

    def transform(self, ctx, batch: pa.Table) -> pa.Table:
        label = [x and unicodedata.normalize("NFC", x) for x in batch["label"].to_pylist()]
        return pa.table({"event_id": batch["event_id"], "label": pa.array(label, pa.string())})


class SplitTokens(BatchOperator):
    """Splits events into those that request and those that answer."""

    schemas = {"asked": "event_id BIGINT, tokens BIGINT", "answered": "event_id BIGINT, latency_ms BIGINT"}

    def transform(self, ctx, batch: pa.Table) -> dict[str, pa.Table]:
        asked = batch.filter(pc.equal(batch["event_type"], "llm_request"))
        answered = batch.filter(pc.equal(batch["event_type"], "llm_response"))
        return {
            "asked": asked.select(["event_id", "input_tokens"]).rename_columns(["event_id", "tokens"]),
            "answered": answered.select(["event_id", "latency_ms"]),
        }


def _token_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_events(spark, sf_dir).select(
        "event_id", "event_type", "input_tokens", "output_tokens", "latency_ms"
    )


#: Letters followed by marks.
MARKED = "e\u0301 a\u0308 Z\u030c"


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat_ws(" ", "tool_name", F.lit(MARKED), "agent_id")
    return fx.raw_events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 5 != 0, label).alias("label"))


@query
def batch_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply(Composed(batch_size=4096), _labels(spark, sf_dir))["composed"]


@query
def batch_arrow_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs written by one pass of the operator."""
    found = apply(SplitTokens(batch_size=4096), _token_columns(spark, sf_dir), folder=scratch_path(spark))
    return found["asked"].unionByName(found["answered"], allowMissingColumns=True)


@query
def batch_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks taken off their letters, which Spark has no function for."""

    def plain(frame):
        frame["label"] = frame["label"].str.normalize("NFD").str.replace("[\u0300-\u036f]", "", regex=True)
        return frame

    return map_pandas(_labels(spark, sf_dir), plain, "event_id BIGINT, label STRING")


class WalkSessions(GroupBatchOperator):
    """Compact turns and errors by walking through whole sessions, one event after the other. A session in parts gives
    counts of its turns in parts too."""

    schemas = {
        "turns": "dt STRING, app_id STRING, session_id STRING, turn_index BIGINT, react_iters BIGINT, error_count BIGINT",
        "errors": "dt STRING, app_id STRING, session_id STRING, turn_index BIGINT, error_type STRING, error_code STRING",
    }

    def transform(self, ctx, batch: pa.Table) -> dict[str, pa.Table]:
        return self._walk(batch, None)[0]

    def transform_part(self, ctx, batch: pa.Table, state, last: bool):
        return self._walk(batch, state)

    def _walk(self, batch: pa.Table, turn: int | None) -> tuple[dict[str, pa.Table], int | None]:
        found, before = [], batch["session_id"][0].as_py() if batch.num_rows else None
        for session, kind, explicit in zip(*(batch[c].to_pylist() for c in ("session_id", "event_type", "turn_index"))):
            if session != before:
                turn, before = None, session
            if explicit is not None:
                turn = explicit
            elif kind == "turn_start":
                turn = (turn or 0) + 1
            found.append(turn if session is not None else None)
        numbered = batch.drop_columns("turn_index").append_column("turn_index", pa.array(found, pa.int64()))
        numbered = numbered.filter(pc.is_valid(numbered["turn_index"]))
        counted = {name: pc.fill_null(pc.equal(numbered["event_type"], kind), False).cast(pa.int64())
                   for name, kind in (("react_iters", "llm_request"), ("error_count", "error"))}
        keys = ["dt", "app_id", "session_id", "turn_index"]
        turns = pa.table({**{k: numbered[k] for k in keys}, **counted}).group_by(keys).aggregate([(n, "sum") for n in counted])
        turns = turns.rename_columns([c.removesuffix("_sum") for c in turns.column_names])
        errors = numbered.filter(pc.fill_null(pc.equal(numbered["event_type"], "error"), False))
        return {"turns": turns, "errors": errors}, turn


@query
def batch_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and errors of whole sessions in batches, sessions of more than a hundred events in parts."""
    events = fx.raw_events(spark, sf_dir).select("dt", "app_id", "session_id", "event_id", "ts", "event_type", "turn_index", "error_type", "error_code")
    events = events.withColumn("session_id", F.when(F.col("event_id") % 4 == 0, "hot").otherwise(F.col("session_id")))
    found = apply(WalkSessions(batch_size=2000, most_rows=100), events, folder=scratch_path(spark))
    keys = ["dt", "app_id", "session_id", "turn_index"]
    turns = found["turns"].groupBy(*keys).agg(F.sum("react_iters").alias("react_iters"), F.sum("error_count").alias("error_count"))
    errors = found["errors"].groupBy(*keys).agg(F.count("*").alias("errors"), F.min("error_type").alias("first_type"), F.max("error_code").alias("last_code"))
    return turns.join(errors, keys, "left")


@query
def batch_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_sql(
        fx.raw_events(spark, sf_dir),
        "SELECT event_type, count(*) AS events, max(input_tokens) AS largest FROM {batch} GROUP BY event_type",
    )


#: Key columns and numbers of every table of every report.
SUITE_COLUMNS: dict[str, dict[str, tuple[list[str], list[str]]]] = {
    "token_stats": {
        "token_summary": (["app_id", "session_id", "llm_model"], ["total_tokens", "prompt_tokens", "completion_tokens", "accumulated_cost"]),
        "token_distribution": ([], ["min_total_tokens", "q1_total_tokens", "median_total_tokens", "q3_total_tokens", "max_total_tokens",
                                    "median_prompt_tokens", "median_completion_tokens", "median_cost", "max_cost"]),
        "model_breakdown": (["llm_model"], ["conversation_count", "total_tokens", "total_prompt_tokens", "total_completion_tokens", "total_cost"]),
    },
    "perf_metrics": {
        "duration_summary": (["app_id", "app_status", "app_type"], ["duration_s", "react_rounds", "seconds_per_round"]),
        "action_distribution": (["app_id", "event_type"], ["event_count"]),
        "throughput": (["app_id"], ["duration_s", "completion_tokens", "prompt_tokens", "output_tokens_per_sec", "total_tokens_per_sec"]),
    },
    "eval_metrics": {
        "success_summary": (["app_status"], ["app_count", "pct"]),
        "react_analysis": (["app_id", "app_status"], ["react_rounds", "duration_s", "seconds_per_round", "min_rounds", "max_rounds"]),
        "tool_usage": (["tool_name"], ["call_count", "sessions_used"]),
        "cost_efficiency": (["app_id", "session_id"], ["accumulated_cost", "total_tokens", "react_rounds", "duration_s", "cost_per_round", "tokens_per_cost_unit"]),
        "agent_delegation": (["app_id", "session_id", "delegated_agent"], ["delegation_count"]),
    },
    "condense_impact": {"condense_impact": (["variant"], ["avg_react_iters", "avg_turn_ms", "avg_in_tokens"])},
    "condense_rows": {"condense_rows": (["session_id", "variant", "status"], ["turn_index", "react_iters", "duration_ms", "input_tokens"])},
}


@query
def report_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of every table of every report: key columns as text, and the sum of the numbers in hundredths."""
    turns, treated = _one_app(spark, sf_dir)
    tables = {
        "raw_events": fx.raw_events(spark, sf_dir),
        "generation_status": fx.generation_status(spark, sf_dir),
        "conversations": fx.conversation_meta(spark, sf_dir),
        "turns": turns,
        "session_treatments": treated,
    }
    params = {"app_id": "app-all", "dt_from": DAYS[0], "dt_to": DAYS[1]}
    found = []
    for report, columns in SUITE_COLUMNS.items():
        for name, df in run_report(report, tables, params).items():
            keys, numbers = columns[name]
            hundredths = [F.coalesce(F.round(F.col(n).cast("double") * 100).cast("bigint"), F.lit(0)) for n in numbers]
            found.append(df.select(
                F.lit(report).alias("report"), F.lit(name).alias("table_name"),
                F.concat_ws("|", F.lit(""), *keys).alias("row_key"), functools.reduce(Column.__add__, hundredths).alias("hundredths"),
            ))
    return functools.reduce(DataFrame.unionByName, found)
