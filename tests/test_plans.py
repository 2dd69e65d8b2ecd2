"""Physical plans: what must reach the scan, and what must not appear."""

import re

import pytest

from agentlake.operators import (
    assign_turn_index,
    build_model_spans,
    build_tool_calls,
    first_errors,
    session_metadata,
)
from agentlake.plans import evaluation
from tests.test_oracles import QUERIES, SF_DIR

PYTHON_QUERIES = {"batch_arrow", "batch_arrow_multi", "batch_pandas", "batch_sessions", "log_tree_ranges"}
COLUMNS = (
    "dt STRING, app_id STRING, session_id STRING, event_id BIGINT, ts TIMESTAMP, event_type STRING, "
    "turn_index BIGINT, agent_id STRING, request_id STRING, model STRING, provider STRING, "
    "input_tokens BIGINT, output_tokens BIGINT, cache_tokens BIGINT, ttft_ms DOUBLE, latency_ms DOUBLE, "
    "tool_name STRING, tool_latency_ms DOUBLE, exit_code INT, error_type STRING, payload STRING"
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Read columns and pushed filters of each scan."""
    spark = df.sparkSession
    limit = spark.conf.get("spark.sql.maxMetadataStringLength", "100")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", limit)
    found = []
    for block in re.findall(r"Scan parquet *\nOutput.*?\n\n", text, re.S):
        columns = re.search(r"ReadSchema: struct<(.*)>", block)[1]
        pushed = re.search(r"PushedFilters: \[(.*)\]", block)
        found.append((set(re.findall(r"(\w+):", columns)), pushed[1] if pushed else ""))
    return found


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "table")
    spark.createDataFrame([], COLUMNS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_global_windows_or_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A window without partition columns would put all rows into one task.
    assert not re.search(r"windowspecdefinition\((specifiedwindowframe|[^,()]* (ASC|DESC) )", text)
    if name not in PYTHON_QUERIES:
        assert not re.search(r"PythonUDF|MapInArrow|MapInPandas|ArrowEvalPython|FlatMapGroups", text)


@pytest.mark.parametrize("build", [build_model_spans, build_tool_calls])
def test_pairs_read_only_their_rows_and_columns(events, build):
    for columns, pushed in scans(build(events)):
        assert "payload" not in columns
        assert "IsNotNull(request_id)" in pushed and "EqualTo(event_type," in pushed


def test_first_rows_are_limited_before_the_shuffle(events):
    for df in (first_errors(events), session_metadata(events)):
        before_shuffle = plan(df).split("Exchange")[1]
        assert "WindowGroupLimit" in before_shuffle and ", Partial" in before_shuffle


def test_numbering_sorts_once_and_counts_on_narrow_scans(events):
    wide, *narrow = sorted((columns for columns, _ in scans(assign_turn_index(events))), key=len, reverse=True)
    assert "payload" in wide
    unnamed, *counts = narrow
    assert all(c <= {"session_id", "ts", "event_id", "event_type"} for c in counts)


def test_delegation_reads_the_payload_of_delegations_only(events):
    ((columns, pushed),) = scans(evaluation.agent_delegation(events))
    assert columns == {"app_id", "session_id", "event_type", "payload"}
    assert "EqualTo(event_type,delegate)" in pushed


def test_one_aggregate_gives_all_overall_rounds(spark, tmp_path):
    path = str(tmp_path / "status")
    spark.sql("SELECT 'a' app_id, 's' app_status, 1L react_rounds, 1D duration_s").write.parquet(path)
    text = plan(evaluation.react_analysis(spark.read.parquet(path)))
    partials = set(re.findall(r"functions=\[(partial_.*?)\], output", text))
    assert len(partials) == 1 and re.match(r"partial_min.*partial_avg.*partial_max", partials.pop())
