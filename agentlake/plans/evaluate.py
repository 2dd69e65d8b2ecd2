"""All log reports of a tree of JSON logs, from files to JSON results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources import (
    Catalog,
    Lake,
    TableSpec,
    default_catalog,
    load_conversations,
    load_events,
    load_generation_status,
    write_reports,
)
from ..sources.snapshots import rename_new
from .suite import run_report

LOG_REPORTS = ("token_stats", "perf_metrics", "eval_metrics")


def evaluate_logs(
    spark: SparkSession, data_dir: str, out_dir: str, model_override: str | None = None
) -> dict[str, dict[str, DataFrame]]:
    """Load the logs under ``data_dir``, run the log reports and write them.

    The JSON is parsed once, into Parquet tables in a new folder beside ``out_dir/lake``. Only when all of them are
    complete do they take its place, so a load that fails leaves earlier tables and reports as they were. The reports
    read only the columns they need from there; their results go to ``out_dir/reports/<report>/<table>`` and are
    returned as DataFrames. Logs without events give empty tables.
    """
    root = str(out_dir).rstrip("/")
    staging = f"{root}/lake-{uuid.uuid4().hex}"
    tables = {
        "raw_events": load_events(spark, data_dir, model_override),
        "generation_status": load_generation_status(spark, data_dir),
        "conversations": load_conversations(spark, data_dir),
    }
    new = Lake(spark, _catalog(staging, tables))
    try:
        for name, df in tables.items():
            new.write(df, name, partition_by=["dt"] if name == "raw_events" else None)
    except BaseException:
        _move(spark, staging, None)
        raise
    _move(spark, staging, f"{root}/lake")

    lake = Lake(spark, _catalog(f"{root}/lake", tables))
    stored = {name: lake.read(name) for name in tables}
    reports = {name: run_report(name, stored) for name in LOG_REPORTS}
    write_reports(reports, f"{root}/reports")
    return reports


def _catalog(root: str, tables: dict[str, DataFrame]) -> Catalog:
    catalog = default_catalog(root)
    for name, df in tables.items():
        path = catalog.get(name).path if name in catalog.list() else f"{root}/raw/{name}"
        catalog.register(name, TableSpec(name, path, schema=df.schema))
    return catalog


def _move(spark: SparkSession, source: str, target: str | None) -> None:
    """Let ``source`` take the place of ``target``; without a target, delete it. If the new folder cannot take the place,
    the old one gets it back; nothing old is deleted before the new one stands."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    system = make(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if target is None:
        system.delete(make(source), True)
        return
    aside = f"{source}-before"
    try:
        if system.exists(make(target)):
            rename_new(spark, target, aside)
        rename_new(spark, source, target)
    except BaseException:
        if system.exists(make(aside)) and not system.exists(make(target)):
            rename_new(spark, aside, target)
        system.delete(make(source), True)
        raise
    system.delete(make(aside), True)
