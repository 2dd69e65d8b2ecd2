"""Reports by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from . import evaluation, perf, tokens, treatments

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Report:
    """``build(tables, params)`` returns the report's DataFrames by name."""

    required_tables: tuple[str, ...]
    build: Callable[[Tables, Mapping[str, Any]], dict[str, DataFrame]]


def _token_stats(t: Tables, params: Mapping[str, Any]) -> dict[str, DataFrame]:
    return {
        "token_summary": tokens.token_summary(t["conversations"]),
        "token_distribution": tokens.token_distribution(t["conversations"]),
        "model_breakdown": tokens.model_breakdown(t["conversations"]),
    }


def _perf_metrics(t: Tables, params: Mapping[str, Any]) -> dict[str, DataFrame]:
    return {
        "duration_summary": perf.duration_summary(t["generation_status"]),
        "action_distribution": perf.action_distribution(t["raw_events"]),
        "throughput": perf.throughput(t["raw_events"], t["generation_status"]),
    }


def _eval_metrics(t: Tables, params: Mapping[str, Any]) -> dict[str, DataFrame]:
    return {
        "success_summary": evaluation.success_summary(t["generation_status"]),
        "react_analysis": evaluation.react_analysis(t["generation_status"]),
        "tool_usage": evaluation.tool_usage(t["raw_events"]),
        "cost_efficiency": evaluation.cost_efficiency(t["conversations"], t["generation_status"]),
        "agent_delegation": evaluation.agent_delegation(t["raw_events"]),
    }


def _condense_impact(t: Tables, params: Mapping[str, Any]) -> dict[str, DataFrame]:
    averages = treatments.condense_impact(
        t["turns"], t["session_treatments"], params["app_id"], params["dt_from"], params["dt_to"]
    )
    return {"condense_impact": averages}


def _condense_rows(t: Tables, params: Mapping[str, Any]) -> dict[str, DataFrame]:
    rows = treatments.condense_rows(t["turns"], t["session_treatments"], params["app_id"])
    return {"condense_rows": rows}


REPORTS: dict[str, Report] = {
    "token_stats": Report(("raw_events", "conversations"), _token_stats),
    "perf_metrics": Report(("raw_events", "generation_status"), _perf_metrics),
    "eval_metrics": Report(("raw_events", "generation_status", "conversations"), _eval_metrics),
    "condense_impact": Report(("turns", "session_treatments"), _condense_impact),
    "condense_rows": Report(("turns", "session_treatments"), _condense_rows),
}


def register_report(name: str, report: Report) -> None:
    REPORTS[name] = report


def run_report(
    name: str, tables: Tables, params: Mapping[str, Any] | None = None
) -> dict[str, DataFrame]:
    """Run a named report over the given tables; lazy, one DataFrame per result."""
    if name not in REPORTS:
        raise KeyError(f"no report {name!r}; known reports: {sorted(REPORTS)}")
    report = REPORTS[name]
    missing = [t for t in report.required_tables if t not in tables]
    if missing:
        raise ValueError(f"report {name!r} needs the tables {missing}")
    return report.build(tables, params or {})
