"""The library's input tables, derived from general-purpose test tables.

Used by the registered queries, the bench and the tests. Everything is computed
from the whole source tables by Spark.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(prefix: str, *parts) -> Column:
    """Prefix and values joined to a text."""
    return F.concat(F.lit(prefix), *[p.cast("string") for p in parts])


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent events. ``turn_index`` holds the explicit indexes."""
    k, event_id, user = F.col("k"), F.col("event_id"), F.col("user_id")
    source = F.col("event_type")
    rest = event_id % 4
    kind = (
        F.when(source == "signup", "turn_start")
        .when(source == "click", "llm_request")
        .when(source == "view", "llm_response")
        .when(source == "purchase", F.when(event_id % 2 == 0, "tool_call").otherwise("tool_result"))
        .when(rest == 0, "condense")
        .when(rest == 1, "todo_update")
        .when(rest == 2, "delegate")
        .otherwise("error")
    )

    def on(event_type: str, condition: Column | None = None) -> Column:
        is_type = F.col("et") == event_type
        return is_type if condition is None else is_type & condition

    delegate = F.when(
        k % 6 != 0, F.concat(F.lit('"agent'), (k % 6).cast("string"), F.lit('"'))
    ).otherwise(F.lit("null"))
    payload = F.concat(F.lit('{"content":{"args":{"agent":'), delegate, F.lit("}}}"))
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
        .withColumn("et", kind)
        .select(
            F.date_format("ts", "yyyy-MM-dd").alias("dt"),
            _text("app-", user).alias("app_id"),
            F.concat(_text("conv-", user), _text("-", event_id % 3)).alias("session_id"),
            "event_id",
            F.date_trunc("second", "ts").alias("ts"),
            F.col("et").alias("event_type"),
            F.when(k == 50, 5).when(k == 99, 0).cast("bigint").alias("turn_index"),
            _text("agent", k % 2).alias("agent_id"),
            _text("r", F.shiftright("event_id", 2)).alias("request_id"),
            _text("model", k % 3).alias("model"),
            _text("provider", k % 2).alias("provider"),
            F.when(on("llm_request"), k * 10).alias("input_tokens"),
            F.when(on("llm_response"), k).alias("output_tokens"),
            F.when(on("llm_request", k % 2 == 0), k).alias("cache_tokens"),
            F.when(on("llm_response", k % 5 != 0), k * 3).alias("ttft_ms"),
            F.when(on("llm_response", k % 11 != 0), F.floor(F.col("value") * 10)).alias("latency_ms"),
            F.when(on("tool_call"), _text("tool", k % 7)).alias("tool_name"),
            F.when(on("tool_result"), k * 9).alias("tool_latency_ms"),
            F.when(on("tool_result", k % 4 != 0), k % 3).alias("exit_code"),
            F.when(on("error"), _text("E", k % 5)).alias("error_type"),
            F.when(on("error"), _text("C", k % 9)).alias("error_code"),
            F.when(on("delegate"), payload).otherwise(F.lit("{}")).alias("payload"),
            _text("u", user).alias("user_id"),
            _text("impl", event_id % 2).alias("agent_impl"),
            F.when(k % 5 != 0, _text("v", k % 3)).alias("agent_version"),
        )
    )


def generation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apps with their duration and rounds."""
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.count_if(F.col("l_linenumber") <= 2).alias("rounds"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return (
        joined.groupBy("o_custkey")
        .agg(
            F.max("o_orderstatus").alias("status"),
            F.min("o_orderpriority").alias("app_type"),
            F.sum(F.coalesce("quantity", F.lit(0.0))).alias("duration_s"),
            F.sum(F.coalesce("rounds", F.lit(0))).alias("react_rounds"),
        )
        .select(
            _text("app-", F.col("o_custkey")).alias("app_id"),
            F.when(F.col("o_custkey") % 50 != 0, F.col("status")).alias("app_status"),
            "app_type", "duration_s", "react_rounds",
        )
    )


def conversation_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with their token use and cost."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        _text("app-", F.col("o_custkey")).alias("app_id"),
        _text("conv-", key).alias("session_id"),
        F.col("o_orderpriority").alias("llm_model"),
        F.when(key % 13 != 0, F.floor(price)).alias("total_tokens"),
        F.floor(price / 2).alias("prompt_tokens"),
        F.floor(price / 4).alias("completion_tokens"),
        F.when(key % 17 == 0, 0.0).otherwise(F.floor(price / 100).cast("double")).alias("accumulated_cost"),
    )


def session_treatments(events: DataFrame) -> DataFrame:
    """Variant of each treated session."""
    last = F.substring("session_id", -1, 1)
    return (
        events.where(last != "2")
        .select("app_id", "session_id", F.when(last == "0", "control").otherwise("condense").alias("variant"))
        .distinct()
    )


def _qualified(spark: SparkSession, root: str) -> str:
    """A folder as an URI that Arrow opens."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return base.replace("file:/", "file:///", 1) if not base.startswith("file://") else base


def _write_sorted(batches: Iterator[pa.RecordBatch], base: str, separator: str) -> Iterator[pa.RecordBatch]:
    """Elements that come file by file are written batch by batch; gives the paths of the files."""
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(base)
    now, out = None, None
    try:
        for batch in batches:
            begun, rows = [], zip(batch.column("path").to_pylist(), batch.column("element").to_pylist())
            for path, some in groupby(rows, key=itemgetter(0)):
                text = separator.join(element for _, element in some)
                if path == now:
                    out.write((separator + text).encode())
                    continue
                if out:
                    out.write(b"]")
                    out.close()
                system.create_dir(f"{folder}/{os.path.dirname(path)}", recursive=True)
                out, now = system.open_output_stream(f"{folder}/{path}", compression=None), path
                out.write(("[" + text).encode())
                begun.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(begun, pa.string())], names=["path"])
        if out:
            out.write(b"]")
    finally:
        if out:
            out.close()


def write_arrays(elements: DataFrame, root: str, separator: str) -> None:
    """Write JSON array files by the executors: each row is one ``element`` of the file ``path`` below ``root``, in the
    order of ``place`` and then of the texts.

    A task holds one batch of elements, however many and large its files are.
    """
    base = _qualified(elements.sparkSession, root)
    rows = elements.select("path", "place", "element").repartition("path").sortWithinPartitions("path", "place", "element")
    rows.select("path", "element").mapInArrow(lambda batches: _write_sorted(batches, base, separator), "path STRING").agg(F.count("*")).collect()
