"""Which directories a filtered read lists and opens."""

import pytest

from agentlake.sources import Lake, ReadFilters, TableSpec, default_catalog
from agentlake.sources.partitions import Directories, Wanted, partition_directories, partition_layout

DAYS = [f"2024-{m:02d}-{d:02d}" for m in range(1, 11) for d in range(1, 26)]


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """A thousand partitions: 250 days of four apps."""
    lake = Lake(spark, default_catalog(str(tmp_path_factory.mktemp("wide"))))
    rows = [(day, f"app {a}", 10 * k + a) for k, day in enumerate(DAYS) for a in range(4)]
    df = spark.createDataFrame(rows, "dt STRING, app_id STRING, n BIGINT")
    df.repartition(4, "dt").write.partitionBy("dt", "app_id").parquet(lake.catalog.get("turns").path)
    return lake, rows


@pytest.fixture()
def looked_at(monkeypatch):
    """Directories that the driver lists or looks up."""
    seen = []
    for name in ("children", "exists"):
        old = getattr(Directories, name)
        monkeypatch.setattr(Directories, name, lambda self, path, old=old: (seen.append(path), old(self, path))[1])
    return seen


@pytest.mark.parametrize(("filters", "kept", "most_files", "most_looks"), [
    (ReadFilters(dt="2024-03-05"), lambda r: r[0] == "2024-03-05", 4, 4),
    (ReadFilters(dt="2024-03-05", app_id="app 2"), lambda r: r[:2] == ("2024-03-05", "app 2"), 1, 5),
    (ReadFilters(dt_from="2024-03-05", dt_to="2024-03-08"), lambda r: "2024-03-05" <= r[0] <= "2024-03-08", 16, 4),
    (ReadFilters(dt_from="2024-03-05", dt_to="2024-03-08", app_id="app 1"), lambda r: "2024-03-05" <= r[0] <= "2024-03-08" and r[1] == "app 1", 4, 8),
    (ReadFilters(app_id="app 3"), lambda r: r[1] == "app 3", 250, 260),
    (ReadFilters(dt="2030-01-01"), lambda r: False, 1, 8),
    (ReadFilters(dt_from="2024-05-09", dt_to="2024-01-01"), lambda r: False, 1, 8),
])
def test_only_wanted_directories_are_opened(wide, looked_at, filters, kept, most_files, most_looks):
    lake, rows = wide
    df = lake.read("turns", filters=filters)
    assert len(looked_at) <= most_looks
    assert len(df.inputFiles()) <= most_files  # all files that Spark has listed, pruned or not
    assert sorted(map(tuple, df.select("dt", "app_id", "n").collect())) == sorted(filter(kept, rows))


def test_datasets_are_found_by_their_partition_values(wide):
    lake, rows = wide
    df = lake.dataset("turns", {"dt": "2024-02-02", "app_id": "app 0", "n": 10 * DAYS.index("2024-02-02")})
    assert len(df.inputFiles()) == 1 and df.count() == 1
    assert lake.dataset("turns", {"dt": None}).count() == 0 and lake.dataset("turns", {"n": 3}).count() == 1


def test_layouts_that_differ_from_the_catalog(spark, tmp_path):
    """What directories there are decides, not what the catalog says of them."""
    lake = Lake(spark, default_catalog(str(tmp_path)))
    df = spark.createDataFrame([("2024-01-01", "a", "s1", 1), ("2024-01-02", "b", "s2", 2)], "dt STRING, app_id STRING, session_id STRING, n BIGINT")
    for keys in ([], ["app_id"], ["session_id", "dt"]):
        lake.write(df, "raw_events", partition_by=keys, mode="overwrite")
        for filters in (ReadFilters(dt="2024-01-02"), ReadFilters(app_id="b"), ReadFilters(session_id="s2", dt_from="2024-01-02", dt_to="2024-02-01")):
            assert [r.n for r in lake.read("raw_events", filters=filters).collect()] == [2]
        assert lake.read("raw_events", filters=ReadFilters(app_id="c")).count() == 0
        assert sorted(lake.read("raw_events", filters=ReadFilters(dt="1999-01-01")).columns) == sorted(df.columns)


def test_odd_partition_values(spark, tmp_path):
    values = ["a/b=c:1%", "{x}*?[y]", "sp ace", "é\\", "007", "7"]
    path = str(tmp_path / "odd [1]{2}")
    spec = TableSpec("odd", path, partition_keys=("app_id",))
    lake = Lake(spark, default_catalog(str(tmp_path)))
    lake.catalog.register("odd", spec)
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)] + [(None, 99)], "app_id STRING, n BIGINT")
    df.write.partitionBy("app_id").parquet(path)
    for k, value in enumerate(values):
        assert [tuple(r) for r in lake.read("odd", filters=ReadFilters(app_id=value)).select("app_id", "n").collect()] == [(value, k)]


def test_levels(spark, wide):
    lake, _ = wide
    root = lake.catalog.get("turns").path
    assert partition_layout(Directories(spark, root), root) == ["dt", "app_id"]
    assert partition_directories(spark, root, {"session_id": Wanted(("x",))}) is None
    found = partition_directories(spark, root, {"dt": Wanted(test=lambda d: d.endswith("-25")), "app_id": Wanted(("app 1", "app 9"))})
    assert len(found) == 10 and all(p.endswith("-25/app_id=app 1") for p in found)
    assert partition_directories(spark, root + "/none", {"dt": Wanted(("x",))}) is None
