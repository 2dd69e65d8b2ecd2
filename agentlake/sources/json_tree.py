"""Nested JSON logs: ``app-*/conv-*/events.json`` and metadata files per app.

Every file holds one JSON array. A file is read by one task, files in parallel;
large event files are read in byte ranges by many tasks (see ``json_ranges``).
Elements become rows before anything else is parsed. Damaged files and files
without an array stop the job instead of losing rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import TOOL_ACTIONS, blank_to_null, event_date, event_type
from ..schemas import CONVERSATIONS_SCHEMA, EVENT_SCHEMA, GENERATION_STATUS_SCHEMA, column_or_null, conform
from .json_ranges import RANGE_BYTES, array_file_elements

# File names, directory patterns and the fields of the log format.
EVENT_FILES = r"^(app-[^/]*)/(conv-[^/]*)/(events\.json)$"
STATUS_FILES = r"^(app-[^/]*)/()(generation_status\.json)$"
CONVERSATION_FILES = r"^(app-[^/]*)/()(conversations\.json)$"
APP_ID_FIELD = "miaoda_app_id"

# Numbers are read as text first: logs write them as 7, 7.0 or "7".
EVENT_FIELDS = f"""
    event_id STRING, session_id STRING,
    ext STRUCT<{APP_ID_FIELD}: STRING, source: STRING, agent_name: STRING>,
    content STRUCT<
        timestamp: STRING, source: STRING, action: STRING, observation: STRING,
        llm_metrics: STRUCT<
            accumulated_cost: STRING,
            accumulated_token_usage: STRUCT<
                prompt_tokens: STRING, completion_tokens: STRING, cache_read_tokens: STRING>>>
"""
STATUS_FIELDS = """
    app_id: STRING, app_status: STRING, app_type: STRING, first_query: STRING,
    react_detail_list: ARRAY<STRUCT<duration: STRING, react_rounds: STRING>>
"""
CONVERSATION_FIELDS = f"""
    conversation_id: STRING, id: STRING, llm_model: STRING, total_tokens: STRING, prompt_tokens: STRING,
    completion_tokens: STRING, accumulated_cost: STRING, created_at: STRING,
    ext: STRUCT<{APP_ID_FIELD}: STRING>
"""

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
FAIL_FAST = {"mode": "FAILFAST"}
#: Metadata files of at most so many bytes in all are small enough to send their models to every task.
SMALL_METADATA = 16 << 20


def resolve_roots(spark: SparkSession, roots: str | Sequence[str]) -> list[str]:
    """Directories that the given paths or globs name, as the file system itself writes them.

    Relative paths are completed by the file system in use. A path that names nothing raises FileNotFoundError.
    """
    conf, found = spark._jsc.hadoopConfiguration(), {}
    for root in [roots] if isinstance(roots, (str, os.PathLike)) else roots:
        path = spark._jvm.org.apache.hadoop.fs.Path(str(root))
        statuses = path.getFileSystem(conf).globStatus(path)
        if not statuses:
            raise FileNotFoundError(f"no such log directory: {root}")
        found.update((status.getPath().toString(), None) for status in statuses)
    return list(found)


def _reader(spark: SparkSession, pattern: str) -> DataFrameReader:
    file_name = pattern.rsplit("(", 1)[1].rstrip(")$").replace("\\", "")
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", file_name)


def _escaped(resolved: Sequence[str]) -> list[str]:
    return [re.sub(r"([*?\[\]{}\\])", r"\\\1", root) for root in resolved]


def _directories(path: Column, resolved: Sequence[str], pattern: str) -> tuple[Column, list[Column]]:
    """Whether a path lies in one of the roots as ``pattern`` describes, and its app_dir and conv_dir."""
    path = F.regexp_replace(path, SCHEME, "")
    parts = "^(.*)/" + pattern.removeprefix("^").replace("/()", "/").replace("()", "")
    names = [F.regexp_extract(path, parts, k) for k in (2, 3)]
    bases = [re.sub(SCHEME, "", root).rstrip("/") for root in resolved]
    inside = path.rlike(parts) & F.regexp_extract(path, parts, 1).isin(*bases)
    return inside, [names[0].alias("app_dir"), (names[1] if "conv-" in pattern else F.lit("")).alias("conv_dir")]


def read_files(spark: SparkSession, roots: str | Sequence[str], pattern: str, most_bytes: int | None = None) -> DataFrame:
    """Whole files below ``roots`` that match ``pattern``: app_dir, conv_dir, text. With ``most_bytes``, larger ones are
    left out unread.

    ``pattern`` describes the last parts of a path, which must lie directly in one of the roots.
    """
    resolved = resolve_roots(spark, roots)
    files = _reader(spark, pattern).text(_escaped(resolved), wholetext=True)
    if most_bytes is not None:
        files = files.where(F.col("_metadata.file_size") <= most_bytes)
    # Paths are URL-encoded, where a plus sign still stands for itself.
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    files = files.select(decoded.alias("path"), F.col("value").alias("text"))
    inside, names = _directories(F.col("path"), resolved, pattern)
    return files.where(inside).select(*names, "text")


def _sizes(spark: SparkSession, roots: str | Sequence[str], pattern: str) -> DataFrame:
    """path and length of the files that match ``pattern``; nothing of them is read."""
    resolved = resolve_roots(spark, roots)
    files = _reader(spark, pattern).format("binaryFile").load(_escaped(resolved)).select("path", "length")
    return files.where(_directories(F.col("path"), resolved, pattern)[0])


def large_file_elements(spark: SparkSession, roots: str | Sequence[str], pattern: str, more_than: int = RANGE_BYTES) -> DataFrame | None:
    """Elements of the files with more than ``more_than`` bytes, as ``array_elements`` has them, each file read by many
    tasks; None if there are no such files."""
    files = _sizes(spark, roots, pattern).where(F.col("length") > more_than)
    if not files.limit(1).count():
        return None
    found = array_file_elements(files, more_than)
    _, names = _directories(F.col("path"), resolve_roots(spark, roots), pattern)
    parsed = F.from_json(F.concat(F.lit("["), F.col("element"), F.lit("]")), "array<string>", FAIL_FAST)
    return found.select(*names, F.coalesce(F.col("position").cast("int"), F.lit(0)).alias("position"), F.get(parsed, F.lit(0)).alias("element"))


def _parsed_array(element_type: str) -> Column:
    """The text of a file as an array; anything but a sound JSON array fails."""
    failure = F.raise_error(
        F.concat(F.lit("not a JSON array: file in "), F.col("app_dir"), F.lit("/"), F.col("conv_dir"))
    )
    kind = f"array<{element_type}>"
    return F.when(F.col("text").rlike(r"^\s*\["), F.from_json("text", kind, FAIL_FAST)).otherwise(
        failure.cast(kind)
    )


def array_elements(files: DataFrame) -> DataFrame:
    """One row per element of each file: app_dir, conv_dir, position, element (JSON text)."""
    elements = F.posexplode(_parsed_array("string")).alias("position", "element")
    return files.select(*[c for c in files.columns if c != "text"], elements)


def array_records(files: DataFrame, fields: str) -> DataFrame:
    """One row per element of each file: app_dir, position and record (``fields``)."""
    records = _parsed_array(f"struct<{fields}>")
    return files.select("app_dir", F.posexplode(records).alias("position", "record"))


def _number(name: str | Column, type_name: str) -> Column:
    """A number written as 7, 7.0 or "7"; whole numbers keep all their digits, fractions are cut off for BIGINT."""
    value = F.col(name) if isinstance(name, str) else name
    if type_name == "bigint":
        return F.coalesce(value.try_cast("bigint"), value.cast("double").cast("bigint"))
    return value.cast("double").cast(type_name)


def _event_id(value: Column) -> Column:
    return F.coalesce(_number(value, "bigint"), F.lit(0).cast("bigint"))


def flatten_events(elements: DataFrame) -> DataFrame:
    """Event elements as event rows; keeps the directory names, the position and ``model`` if they are there."""
    action = F.col("e.content.action")
    tokens = "e.content.llm_metrics.accumulated_token_usage"
    parsed = elements.withColumn("e", F.from_json("element", EVENT_FIELDS, FAIL_FAST))
    rows = parsed.select(
        "app_dir",
        "conv_dir",
        *[c for c in ("position", "model") if c in elements.columns],
        event_date(F.col("e.content.timestamp")).alias("dt"),
        F.coalesce(blank_to_null(F.col(f"e.ext.{APP_ID_FIELD}")), F.col("app_dir")).alias("app_id"),
        F.coalesce(blank_to_null(F.col("e.session_id")), F.col("conv_dir")).alias("session_id"),
        _event_id(F.col("e.event_id")).alias("event_id"),
        F.col("e.content.timestamp").alias("ts"),
        event_type(action, F.col("e.content.observation")).alias("event_type"),
        F.coalesce(blank_to_null(F.col("e.content.source")), F.col("e.ext.source")).alias("source"),
        F.col("e.ext.agent_name").alias("agent_id"),
        _number(f"{tokens}.prompt_tokens", "bigint").alias("input_tokens"),
        _number(f"{tokens}.completion_tokens", "bigint").alias("output_tokens"),
        _number(f"{tokens}.cache_read_tokens", "bigint").alias("cache_tokens"),
        F.when(action.isin(*TOOL_ACTIONS), action).alias("tool_name"),
        _number("e.content.llm_metrics.accumulated_cost", "double").alias("accumulated_cost"),
        F.col("element").alias("payload"),
    )
    columns = [column_or_null(rows, f.name, f.dataType.simpleString()) for f in EVENT_SCHEMA]
    position = [F.col("position").cast("bigint")] if "position" in elements.columns else []
    return rows.select("app_dir", "conv_dir", *columns, *position)


def conversation_models(records: DataFrame) -> DataFrame:
    """Model per conversation directory: app_dir, conv_dir, llm_model.

    Of records with the same id in one app the last one counts.
    """
    conv_dir = F.coalesce(blank_to_null(F.col("record.conversation_id")), F.col("record.id"), F.lit(""))
    return (
        records.select("app_dir", conv_dir.alias("conv_dir"), "position", "record.llm_model")
        .groupBy("app_dir", "conv_dir")
        .agg(F.max_by("llm_model", "position").alias("llm_model"))
    )


def attach_model(rows: DataFrame, models: DataFrame | None, model_override: str | None = None) -> DataFrame:
    """Set ``model`` of files, elements or flattened events: the override, else the conversation's model."""
    if model_override:
        return rows.withColumn("model", F.lit(model_override))
    joined = rows.drop("model").join(models, ["app_dir", "conv_dir"], "left")
    return joined.withColumnRenamed("llm_model", "model")


def _models(spark: SparkSession, roots: str | Sequence[str]) -> DataFrame:
    """Models of all conversations, marked for broadcast where the sizes of their files prove them small."""
    models = conversation_models(array_records(read_files(spark, roots, CONVERSATION_FILES), CONVERSATION_FIELDS))
    size = _sizes(spark, roots, CONVERSATION_FILES).agg(F.sum("length")).first()[0] or 0
    return F.broadcast(models) if size <= SMALL_METADATA else models


def load_events(spark: SparkSession, root: str | Sequence[str], model_override: str | None = None, whole_bytes: int = RANGE_BYTES) -> DataFrame:
    """Event table of all ``app-*/conv-*/events.json`` files in ``root``: a directory, a glob or several.

    After the event columns comes ``position``, the place in the file, by which events of equal time and id are ordered.
    Models are looked up once for each file, before its events become rows; files are not moved for that unless the
    metadata is large. Files of more than ``whole_bytes`` are divided into ranges of as many bytes and read by many tasks.
    """
    models = None if model_override else _models(spark, root)
    files = attach_model(read_files(spark, root, EVENT_FILES, whole_bytes), models, model_override)
    found = array_elements(files)
    large = large_file_elements(spark, root, EVENT_FILES, whole_bytes)
    if large is not None:
        found = found.unionByName(attach_model(large, models, model_override).select(*found.columns))
    return conform(flatten_events(found), EVENT_SCHEMA, "position")


def flatten_generation_status(records: DataFrame) -> DataFrame:
    rounds = F.coalesce(F.col("record.react_detail_list"), F.array())

    def total(field: str, kind: str) -> Column:
        zero = F.lit(0).cast(kind)
        return F.aggregate(rounds, zero, lambda sum_, item: sum_ + F.coalesce(_number(item[field], kind), zero))

    rows = records.select(
        F.coalesce(blank_to_null(F.col("record.app_id")), F.col("app_dir")).alias("app_id"),
        "record.app_status",
        "record.app_type",
        total("duration", "double").alias("duration_s"),
        total("react_rounds", "bigint").alias("react_rounds"),
        "record.first_query",
    )
    return conform(rows, GENERATION_STATUS_SCHEMA)


def load_generation_status(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """One row per entry of all ``app-*/generation_status.json`` files in ``root``."""
    return flatten_generation_status(array_records(read_files(spark, root, STATUS_FILES), STATUS_FIELDS))


def flatten_conversations(records: DataFrame) -> DataFrame:
    own_app = blank_to_null(F.col(f"record.ext.{APP_ID_FIELD}"))
    counts = ("total_tokens", "prompt_tokens", "completion_tokens")
    rows = records.select(
        F.coalesce(own_app, F.col("app_dir")).alias("app_id"),
        F.coalesce(blank_to_null(F.col("record.conversation_id")), F.col("record.id")).alias("session_id"),
        "record.llm_model",
        *[_number(f"record.{n}", "bigint").alias(n) for n in counts],
        _number("record.accumulated_cost", "double").alias("accumulated_cost"),
        "record.created_at",
    )
    return conform(rows, CONVERSATIONS_SCHEMA)


def load_conversations(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """One row per entry of all ``app-*/conversations.json`` files in ``root``."""
    return flatten_conversations(
        array_records(read_files(spark, root, CONVERSATION_FILES), CONVERSATION_FIELDS)
    )
