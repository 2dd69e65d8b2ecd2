"""From a tree of JSON logs to JSON reports."""

import json

import pytest

from agentlake.plans import evaluate_logs


def records(path):
    lines = "".join(p.read_text() for p in path.glob("part-*.json")).splitlines()
    return [json.loads(line) for line in lines]


def test_logs_to_reports(spark, tmp_path):
    app = tmp_path / "logs" / "app-x"
    (app / "conv-1").mkdir(parents=True)
    usage = {"prompt_tokens": 30, "completion_tokens": 10}
    events = [
        {"event_id": 1, "content": {"timestamp": "2024-03-01T09:00:00", "action": "run",
                                    "llm_metrics": {"accumulated_token_usage": usage}}},
        {"event_id": 2, "content": {"timestamp": "2024-03-02T09:00:00", "action": "delegate", "args": {"agent": "helper"}}},
    ]
    (app / "conv-1" / "events.json").write_text(json.dumps(events))
    (app / "conversations.json").write_text(json.dumps(
        [{"conversation_id": "conv-1", "llm_model": "m", "total_tokens": 40, "accumulated_cost": 2.0}]))
    (app / "generation_status.json").write_text(json.dumps(
        [{"app_status": "done", "react_detail_list": [{"duration": 4.0, "react_rounds": 2}]}]))

    out = tmp_path / "out"
    reports = evaluate_logs(spark, str(tmp_path / "logs"), str(out))
    assert {name: len(tables) for name, tables in reports.items()} == {
        "token_stats": 3, "perf_metrics": 3, "eval_metrics": 5,
    }
    for name, tables in reports.items():
        for table, df in tables.items():
            assert len(records(out / "reports" / name / table)) == df.count() > 0
    assert records(out / "reports/perf_metrics/throughput") == [
        {"app_id": "app-x", "duration_s": 4.0, "completion_tokens": 10, "prompt_tokens": 30,
         "output_tokens_per_sec": 2.5, "total_tokens_per_sec": 10.0}
    ]
    assert records(out / "reports/eval_metrics/agent_delegation") == [
        {"app_id": "app-x", "session_id": "conv-1", "delegated_agent": "helper", "delegation_count": 1}
    ]
    assert records(out / "reports/token_stats/token_distribution")[0]["median_prompt_tokens"] is None
    assert sorted(p.name for p in (out / "lake/raw/events").glob("dt=*")) == ["dt=2024-03-01", "dt=2024-03-02"]


def test_failed_and_empty_loads(spark, tmp_path):
    app = tmp_path / "logs" / "app-x"
    (app / "conv-1").mkdir(parents=True)
    (app / "conv-1" / "events.json").write_text(json.dumps([{"event_id": 1, "content": {"action": "run"}}]))
    logs, out = str(tmp_path / "logs"), tmp_path / "out"
    assert evaluate_logs(spark, logs, str(out))["perf_metrics"]["action_distribution"].count() == 1
    (app / "conv-1" / "events.json").write_text("[{")
    for bad in (logs, str(tmp_path / "missing")):
        with pytest.raises(Exception):
            evaluate_logs(spark, bad, str(out))
        assert len(records(out / "reports/perf_metrics/action_distribution")) == 1
        assert spark.read.parquet(str(out / "lake/raw/events")).count() == 1
        assert [p.name for p in out.iterdir() if p.name.startswith("lake")] == ["lake"]
    (tmp_path / "none").mkdir()
    for _ in range(2):
        reports = evaluate_logs(spark, str(tmp_path / "none"), str(out))
        assert reports["perf_metrics"]["action_distribution"].count() == 0
        assert reports["eval_metrics"]["react_analysis"].count() == 0
