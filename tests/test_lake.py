"""Catalog, filtered reads, writes, SQL and the JSON sink."""

import json
import os

import pytest

from agentlake.sources import Catalog, Lake, ReadFilters, TableSpec, default_catalog, write_reports

ROWS = [
    (f"2024-01-0{day}", f"00{app}", f"s{session}", day * 100 + app * 10 + session)
    for day in range(1, 5) for app in range(2) for session in range(2)
]


@pytest.fixture()
def lake(spark, tmp_path):
    lake = Lake(spark, default_catalog(str(tmp_path / "lake")))
    df = spark.createDataFrame(ROWS, "dt STRING, app_id STRING, session_id STRING, n BIGINT")
    lake.write(df, "raw_events", partition_by=["dt", "app_id", "session_id"])
    lake.write(df, "turns", partition_by=["dt", "app_id"])
    return lake


def read(lake, table, **filters):
    rows = lake.read(table, filters=ReadFilters(**filters)).select("dt", "app_id", "session_id", "n").collect()
    return sorted(map(tuple, rows))


@pytest.mark.parametrize(
    "filters, kept",
    [
        ({}, lambda r: True),
        ({"dt": "2024-01-02"}, lambda r: r[0] == "2024-01-02"),
        ({"dt_from": "2024-01-02", "dt_to": "2024-01-03"}, lambda r: r[0] in ("2024-01-02", "2024-01-03")),
        ({"dt_from": "2024-01-03", "dt_to": "2024-01-02"}, lambda r: False),
        ({"dt_from": "2024-01-02"}, lambda r: r[0] == "2024-01-02"),
        ({"dt_to": "2024-01-03"}, lambda r: r[0] == "2024-01-03"),
        ({"dt": "2024-01-01", "dt_from": "2024-01-02", "dt_to": "2024-01-03"}, lambda r: r[0] == "2024-01-01"),
        ({"app_id": "001"}, lambda r: r[1] == "001"),
        ({"app_id": "001", "session_id": "s1"}, lambda r: r[1:3] == ("001", "s1")),
    ],
)
def test_filters(lake, filters, kept):
    assert read(lake, "raw_events", **filters) == sorted(filter(kept, ROWS))


def test_session_filter_needs_the_partition_key(lake):
    assert read(lake, "turns", app_id="001", session_id="s1") == sorted(r for r in ROWS if r[1] == "001")


def test_bad_days_are_refused(lake):
    with pytest.raises(ValueError):
        lake.read("raw_events", filters=ReadFilters(dt_from="yesterday", dt_to="2024-01-03"))


def test_columns_and_pruned_partitions(lake):
    df = lake.read("raw_events", filters=ReadFilters(dt_from="2024-01-02", dt_to="2024-01-03"), columns=["n"])
    assert df.columns == ["n"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<n:bigint>" in plan
    assert len(df.inputFiles()) <= len(ROWS)


def test_reading_leaves_the_session_settings_alone(lake, spark):
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    lake.read("turns")
    assert spark.conf.get(key) == before


def test_write_modes(lake, spark, tmp_path):
    path = str(tmp_path / "elsewhere")
    df = spark.range(3)
    lake.write(df, "turns", path=path)
    lake.write(df, "turns", path=path)
    assert spark.read.parquet(path).count() == 6
    lake.write(df, "turns", path=path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        lake.write(df, "turns", path=path, mode="replace")
    assert len(read(lake, "turns")) == len(ROWS)


def test_overwriting_drops_all_old_partitions(lake, spark):
    df = spark.createDataFrame(ROWS[:1], "dt STRING, app_id STRING, session_id STRING, n BIGINT")
    lake.write(df, "turns", partition_by=["dt", "app_id"], mode="overwrite")
    assert read(lake, "turns") == ROWS[:1]


def test_catalog():
    catalog = default_catalog("/lake/")
    assert catalog.list() == ["errors", "eval_runs", "raw_events", "sessions", "turn_features", "turns"]
    assert catalog.get("errors").path == "/lake/derived/errors"
    assert catalog.get("raw_events").partition_keys == ("dt", "app_id", "session_id")
    assert catalog.get("turns").schema_version == "v2"
    with pytest.raises(KeyError, match="turn_features"):
        catalog.get("nothing")
    catalog.register("turns", TableSpec("turns", "/new"))
    assert catalog.get("turns").path == "/new"
    assert Catalog().list() == []


def test_views_parameters_and_equality(lake):
    lake.view("turns")
    rows = lake.sql("SELECT n FROM turns WHERE dt = ? AND n > ? ORDER BY n", ["2024-01-02", 200]).collect()
    assert [r.n for r in rows] == [201, 210, 211]
    assert lake.sql("SELECT count(*) FROM turns").first()[0] == len(ROWS)
    kept = lake.dataset("turns", {"dt": "2024-01-01", "app_id": "000"})
    assert sorted(r.n for r in kept.collect()) == [100, 101]
    assert lake.dataset("turns", {"session_id": None}).count() == 0
    assert lake.dataset("turns").count() == len(ROWS)


def test_reports_as_json(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 1.5), ("b", float("inf")), ("c", float("-inf")), ("d", float("nan")), ("é", None)],
        "name STRING, value DOUBLE",
    )
    out = tmp_path / "out"
    for _ in range(2):
        write_reports({"one": {"first": df, "second": df.limit(1)}, "two": {"third": df}}, str(out))
    assert sorted(os.listdir(out)) == ["one", "two"] and sorted(os.listdir(out / "one")) == ["first", "second"]
    parts = [p.read_text() for p in (out / "one" / "first").glob("part-*.json")]
    records = sorted((json.loads(x) for x in "".join(parts).splitlines()), key=lambda r: r["name"])
    assert records == [
        {"name": "a", "value": 1.5}, *[{"name": n, "value": None} for n in ("b", "c", "d", "é")],
    ]
