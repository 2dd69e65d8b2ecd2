"""Spans, calls, turns, sessions and errors on hand-written events."""

from datetime import datetime

import pytest

from agentlake.operators import (
    assign_turn_index,
    build_model_spans,
    build_sessions,
    build_tool_calls,
    build_turns,
    carry_turn_index,
    compact_sessions,
    compact_turns,
    errors_in_turns,
    first_errors,
    session_metadata,
)

COLUMNS = {
    "dt": "STRING", "app_id": "STRING", "session_id": "STRING", "event_id": "BIGINT", "ts": "TIMESTAMP",
    "event_type": "STRING", "turn_index": "BIGINT", "agent_id": "STRING", "request_id": "STRING",
    "model": "STRING", "provider": "STRING", "input_tokens": "BIGINT", "output_tokens": "BIGINT",
    "cache_tokens": "BIGINT", "ttft_ms": "DOUBLE", "latency_ms": "DOUBLE", "tool_name": "STRING",
    "tool_latency_ms": "DOUBLE", "exit_code": "INT", "error_type": "STRING", "error_code": "STRING",
    "user_id": "STRING", "agent_impl": "STRING", "agent_version": "STRING",
}


def events(spark, *rows, without=()):
    columns = [c for c in COLUMNS if c not in without]
    defaults = {"dt": "2024-01-01", "app_id": "a", "session_id": "s"}
    data = [tuple({**defaults, **row}.get(c) for c in columns) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} {COLUMNS[c]}" for c in columns))


def at(second, minute=0):
    return datetime(2024, 1, 1, 10, minute, second)


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_a_whole_turn(spark):
    rows = events(
        spark,
        {"event_id": 1, "ts": at(0), "event_type": "turn_start", "user_id": "u", "agent_impl": "i"},
        {"event_id": 2, "ts": at(1), "event_type": "llm_request", "request_id": "m1", "input_tokens": 70,
         "cache_tokens": 7, "agent_id": "root", "model": "big", "provider": "p"},
        {"event_id": 3, "ts": at(3), "event_type": "llm_response", "request_id": "m1", "output_tokens": 30,
         "latency_ms": 1500.0, "ttft_ms": 300.0},
        {"event_id": 4, "ts": at(4), "event_type": "tool_call", "request_id": "c1", "tool_name": "shell"},
        {"event_id": 5, "ts": at(5), "event_type": "tool_result", "request_id": "c1", "exit_code": 0,
         "tool_latency_ms": 800.0},
    )
    numbered = assign_turn_index(rows)
    (span,) = dicts(build_model_spans(numbered))
    assert (span["span_id"], span["otps"], span["turn_index"]) == ("m1", 20.0, 1)
    assert (span["start_ts"], span["end_ts"], span["malformed_tool_call"]) == (at(1), at(3), False)
    (call,) = dicts(build_tool_calls(numbered))
    assert (call["status"], call["tool_latency_ms"], call["tool_name"]) == ("ok", 800.0, "shell")
    (turn,) = dicts(build_turns(numbered))
    assert (turn["model_spans_count"], turn["tool_calls_count"], turn["react_iters"]) == (1, 1, 1)
    assert (turn["duration_ms"], turn["status"]) == (5000.0, "success")
    assert (turn["input_tokens"], turn["output_tokens"], turn["avg_ttft_ms"]) == (70, 30, 300.0)
    (session,) = dicts(build_sessions(build_turns(numbered), numbered))
    assert (session["turns_count"], session["user_id"], session["agent_version"]) == (1, "u", None)
    assert (session["first_error_turn"], session["status"]) == (None, "success")


def test_every_pair_of_equal_ids_is_kept(spark):
    rows = events(
        spark,
        {"event_id": 1, "session_id": "s1", "event_type": "llm_request", "request_id": "r"},
        {"event_id": 2, "session_id": "s2", "event_type": "llm_response", "request_id": "r", "latency_ms": 0.0,
         "output_tokens": 3},
        {"event_id": 3, "session_id": "s2", "event_type": "llm_response", "request_id": "r", "output_tokens": 3},
    )
    spans = dicts(build_model_spans(rows))
    assert sorted([s["otps"] for s in spans], key=str) == [3000.0, None]
    assert {s["session_id"] for s in spans} == {"s1"}


def test_null_ids(spark):
    kinds = ["llm_request", "llm_response", "tool_call", "tool_result"]
    rows = events(
        spark,
        *[{"event_id": i, "event_type": k} for i, k in enumerate(kinds * 2)],
        *[{"event_id": 10 + i, "event_type": k, "request_id": "x"} for i, k in enumerate(kinds)],
    )
    assert build_model_spans(rows).count() == build_tool_calls(rows).count() == 1


def test_exit_codes(spark):
    rows = events(
        spark,
        *[{"event_id": i, "event_type": "tool_call", "request_id": f"c{i}"} for i in range(3)],
        *[
            {"event_id": 5, "event_type": "tool_result", "request_id": f"c{i}", "exit_code": code}
            for i, code in enumerate([None, 0, 2])
        ],
    )
    status = {c["tool_call_id"]: c["status"] for c in dicts(build_tool_calls(rows))}
    assert status == {"c0": "ok", "c1": "ok", "c2": "error"}


def test_a_turn_over_midnight_has_a_row_per_day(spark):
    rows = events(
        spark,
        {"event_id": 1, "ts": at(1), "event_type": "turn_start"},
        {"event_id": 2, "ts": at(2), "dt": "2024-01-02", "event_type": "error"},
        {"event_id": 3, "ts": at(3), "dt": "2024-01-02", "event_type": "llm_request"},
    )
    turns = dicts(build_turns(assign_turn_index(rows)).orderBy("dt"))
    assert [(t["dt"], t["turn_index"], t["status"]) for t in turns] == [
        ("2024-01-01", 1, "success"), ("2024-01-02", 1, "fail"),
    ]
    assert [(t["input_tokens"], t["avg_ttft_ms"]) for t in turns] == [(0, None), (0, None)]
    compact = dicts(compact_turns(carry_turn_index(rows)).orderBy("dt"))
    assert [(t["react_iters"], t["error_count"]) for t in compact] == [(0, 0), (1, 1)]


def test_errors_before_the_first_turn_are_dropped(spark):
    rows = events(
        spark,
        {"event_id": 1, "ts": at(1), "event_type": "error", "error_type": "early"},
        {"event_id": 2, "ts": at(2), "event_type": "turn_start"},
        {"event_id": 3, "ts": at(3), "event_type": "error", "error_type": "late", "error_code": "7"},
    )
    (error,) = dicts(errors_in_turns(carry_turn_index(rows)))
    assert (error["turn_index"], error["error_type"], error["error_code"]) == (1, "late", "7")


def test_first_error_puts_unnumbered_ones_last(spark):
    rows = events(
        spark,
        {"event_id": 1, "ts": at(1), "event_type": "error", "error_type": "unnumbered"},
        {"event_id": 3, "ts": at(3), "event_type": "error", "error_type": "second", "turn_index": 1},
        {"event_id": 2, "ts": at(3), "event_type": "error", "error_type": "first", "turn_index": 1},
        {"event_id": 4, "ts": at(4), "event_type": "error", "session_id": "t", "error_type": "only"},
    )
    found = {e["session_id"]: (e["first_error_turn"], e["first_error_type"]) for e in dicts(first_errors(rows))}
    assert found == {"s": (1, "first"), "t": (None, "only")}


def test_session_metadata_takes_the_first_event_with_its_nulls(spark):
    rows = events(
        spark,
        {"event_id": 1, "ts": None, "user_id": "no time"},
        {"event_id": 3, "ts": at(1), "user_id": "late"},
        {"event_id": 2, "ts": at(1), "agent_impl": "i"},
    )
    (meta,) = dicts(session_metadata(rows))
    assert meta == {"session_id": "s", "user_id": None, "agent_impl": "i", "agent_version": None}
    bare = events(spark, {"event_id": 1}, without=("user_id", "agent_impl", "agent_version"))
    (meta,) = dicts(session_metadata(bare))
    assert meta == {"session_id": "s", "user_id": None, "agent_impl": None, "agent_version": None}


def test_null_keys_make_groups(spark):
    rows = events(
        spark,
        {"event_id": 1, "ts": at(1), "session_id": None, "turn_index": 4, "event_type": "error",
         "error_type": "e", "user_id": "u"},
        {"event_id": 2, "ts": at(2), "app_id": None, "turn_index": 1, "event_type": "llm_request"},
    )
    turns = build_turns(rows)
    sessions = {s["session_id"]: s for s in dicts(build_sessions(turns, rows))}
    assert sessions[None]["first_error_turn"] == 4 and sessions[None]["user_id"] == "u"
    assert sessions["s"]["app_id"] is None and sessions["s"]["model_spans_count"] == 1
    counts = {s["session_id"]: (s["turns_count"], s["error_turns"]) for s in dicts(compact_sessions(turns))}
    assert counts == {None: (1, 1), "s": (1, 0)}


def test_text_timestamps(spark):
    rows = spark.createDataFrame(
        [("d", "a", "s", i, ts, "turn_start", None, None, None, None) for i, ts in
         enumerate(["2024-01-01T00:00:00.250000", "2024-01-01T00:00:00.251500"])],
        "dt STRING, app_id STRING, session_id STRING, event_id BIGINT, ts STRING, event_type STRING, "
        "input_tokens BIGINT, output_tokens BIGINT, cache_tokens BIGINT, ttft_ms DOUBLE",
    ).selectExpr("*", "1L AS turn_index")
    (turn,) = dicts(build_turns(rows))
    assert turn["duration_ms"] == 1.5


@pytest.mark.parametrize(
    "derive",
    [
        build_model_spans, build_tool_calls, build_turns, first_errors, session_metadata, compact_turns,
        errors_in_turns, lambda e: build_sessions(build_turns(e), e), lambda e: compact_sessions(build_turns(e)),
    ],
)
def test_empty_input_keeps_the_schema(spark, derive):
    row = {"event_id": 1, "ts": at(1), "event_type": "error", "turn_index": 1}
    some, none = derive(events(spark, row)), derive(events(spark))
    assert none.schema == some.schema and none.count() == 0


def test_output_columns(spark):
    rows = events(spark)
    assert build_model_spans(rows).columns == (
        "dt app_id session_id turn_index span_id parent_span_id agent_id model provider start_ts end_ts ttft_ms "
        "latency_ms input_tokens output_tokens cache_tokens otps tool_intents_count malformed_tool_call"
    ).split()
    assert build_tool_calls(rows).columns == (
        "dt app_id session_id turn_index tool_call_id parent_span_id agent_id tool_name start_ts end_ts "
        "tool_latency_ms status exit_code error_type patch_applied patch_reject_reason read_accuracy_score artifacts"
    ).split()
    assert build_turns(rows).columns == (
        "dt app_id session_id turn_index start_ts end_ts duration_ms user_msg_event_id query_level mmu status "
        "finish_event_type react_iters model_spans_count tool_calls_count condense_count todo_update_count "
        "error_count input_tokens output_tokens cache_tokens avg_ttft_ms avg_otps"
    ).split()
    assert build_sessions(build_turns(rows), rows).columns == (
        "dt app_id session_id user_id agent_impl agent_version start_ts end_ts duration_ms status success_reason "
        "turns_count model_spans_count tool_calls_count total_input_tokens total_output_tokens total_cache_tokens "
        "total_cost_usd first_error_turn first_error_type"
    ).split()
