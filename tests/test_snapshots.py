"""Writes that appear whole or not at all."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from agentlake.plans import evaluate
from agentlake.sources import Lake, ReadFilters, SnapshotStore, TableSpec, WriteConflict, default_catalog
from agentlake.sources import snapshots


@pytest.fixture()
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def numbers(spark, low, high):
    return spark.range(low, high).withColumn("dt", F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def folders(store, name="t"):
    place = os.path.join(store.root, name)
    return sorted(os.listdir(place)) if os.path.exists(place) else []


def failing(spark):
    return numbers(spark, 0, 50).withColumn("id", F.when(F.col("id") < 40, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))


def test_writes_and_versions(spark, store):
    assert store.versions() == [] and store.tables() == {}
    assert store.write({"t": numbers(spark, 0, 5), "u": spark.range(2)}, partition_by={"t": ["dt"]}) == 1
    old = store.read("t")
    assert store.write({"t": numbers(spark, 5, 9)}, partition_by={"t": ["dt"]}) == 2
    assert ids(store.read("t")) == list(range(9)) and ids(store.read("u")) == [0, 1]
    assert store.write({"t": numbers(spark, 20, 23)}, mode="overwrite") == 3
    assert ids(store.read("t")) == [20, 21, 22] and ids(store.read("t", version=2)) == list(range(9))
    assert ids(old) == list(range(5)) and sorted(store.read("t").columns) == ["dt", "id"]  # a reader keeps what it began with
    assert store.versions() == [1, 2, 3]
    with pytest.raises(KeyError):
        store.read("t", version=9)
    with pytest.raises(KeyError):
        store.read("none")
    assert store.read("none", schema=numbers(spark, 0, 1).schema).count() == 0
    for wrong in ({"mode": "replace"}, {"partition_by": {"t": ["nothing"]}}):
        with pytest.raises(ValueError):
            store.write({"t": numbers(spark, 0, 1)}, **wrong)


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_a_write_that_fails_changes_nothing(spark, store, mode):
    store.write({"t": numbers(spark, 0, 5), "u": spark.range(2)})
    before = store.tables()
    with pytest.raises(Exception, match="lost"):
        store.write({"u": spark.range(9), "t": failing(spark)}, mode=mode)
    assert store.tables() == before and ids(store.read("t")) == list(range(5)) and ids(store.read("u")) == [0, 1]
    assert len(folders(store)) == len(folders(store, "u")) == 1


def test_a_rename_that_fails_changes_nothing(spark, store, monkeypatch):
    store.write({"t": numbers(spark, 0, 5)})

    def broken(*_):
        raise OSError("no rename")

    monkeypatch.setattr(snapshots, "rename_new", broken)
    with pytest.raises(OSError):
        store.write({"t": numbers(spark, 5, 9)}, mode="overwrite")
    monkeypatch.undo()
    assert ids(store.read("t")) == list(range(5)) and len(folders(store)) == 1
    assert os.listdir(os.path.join(store.root, "_versions"))  # hidden leftovers are no versions
    assert store.versions() == [1] and store.write({"t": numbers(spark, 5, 9)}) == 2


def test_a_writer_that_is_killed_leaves_no_trace_in_the_table(spark, store):
    """What a dead driver leaves: a folder without success marker, and a version that was not renamed."""
    store.write({"t": numbers(spark, 0, 5)})
    store._write_folder(numbers(spark, 70, 90), store._folder("t", numbers(spark, 70, 90), []))
    with open(os.path.join(store.root, "_versions", ".half"), "w") as file:
        file.write('{"tables": {')
    assert ids(store.read("t")) == list(range(5)) and store.versions() == [1] and len(folders(store)) == 2
    assert len(store.vacuum()) == 1 and len(folders(store)) == 1 and ids(store.read("t")) == list(range(5))


def test_writers_at_once_lose_nothing(spark, store):
    store.write({"t": numbers(spark, 0, 1)})
    errors = []

    def write(k):
        try:
            SnapshotStore(spark, store.root).write({"t": numbers(spark, 10 * k, 10 * k + 10)})
        except Exception as failure:  # noqa: BLE001
            errors.append(failure)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and ids(store.read("t")) == [0, *range(10, 70)] and store.versions() == list(range(1, 8))


def test_a_version_is_made_once(spark, store):
    assert store._commit(1, {}) and not store._commit(1, {"t": []}) and store.tables() == {}


def test_compact_and_vacuum(spark, store):
    for k in range(4):
        store.write({"t": numbers(spark, 10 * k, 10 * k + 10)}, partition_by={"t": ["dt"]})
    assert store.compact("t") == 5 and len(store.tables()["t"]) == 1 and ids(store.read("t")) == list(range(40))
    assert store.compact("t") == 5
    old = store.read("t", version=4)
    assert ids(old) == list(range(40))
    assert len(store.vacuum(keep=2)) == 0 and store.versions() == [4, 5]
    assert len(store.vacuum()) == 4 and store.versions() == [5] and ids(store.read("t")) == list(range(40))
    with pytest.raises(ValueError):
        store.vacuum(0)


def test_compaction_gives_way_to_a_replacement(spark, store, monkeypatch):
    for k in range(2):
        store.write({"t": numbers(spark, k, k + 1)})
    other = SnapshotStore(spark, store.root)
    slow = store._write_folder

    def late(df, folder):
        slow(df, folder)
        other.write({"t": numbers(spark, 7, 8)}, mode="overwrite")

    monkeypatch.setattr(store, "_write_folder", late)
    with pytest.raises(WriteConflict):
        store.compact("t")
    assert ids(store.read("t")) == [7]


def test_columns_of_several_writes(spark, store):
    store.write({"t": spark.sql("SELECT 1L AS id, 'a' AS dt")}, partition_by={"t": ["dt"]})
    store.write({"t": spark.sql("SELECT 2L AS id, 'b' AS dt, 5 AS extra")}, partition_by={"t": ["dt"]})
    store.write({"t": spark.sql("SELECT 3L AS id, 'c' AS dt, 1.5D AS other")})
    got = sorted(tuple(r) for r in store.read("t").select("id", "dt", "extra", "other").collect())
    assert got == [(1, "a", None, None), (2, "b", 5, None), (3, "c", None, 1.5)]
    store.write({"t": spark.sql("SELECT 'x' AS id")})
    with pytest.raises(TypeError):
        store.read("t")
    with pytest.raises(ValueError):
        store.write({"t": spark.sql("SELECT 1 AS _write")})


def test_lake_tables(spark, tmp_path):
    lake = Lake(spark, default_catalog(str(tmp_path), format="snapshot"))
    for k in range(3):
        lake.write(numbers(spark, 10 * k, 10 * k + 10), "raw_events", partition_by=["dt"])
    df = lake.read("raw_events", filters=ReadFilters(dt="2024-01-02"), columns=["id"])
    assert ids(df) == [k for k in range(30) if k % 3 == 1] and df.columns == ["id"]
    assert all("dt=2024-01-02" in f for f in df.inputFiles())
    assert lake.read("raw_events", filters=ReadFilters(dt="2030-01-01")).count() == 0
    lake.write(numbers(spark, 0, 3), "raw_events", mode="overwrite")
    assert ids(lake.dataset("raw_events", {"dt": "2024-01-01"})) == [0]
    lake.view("raw_events")
    assert lake.sql("SELECT count(*) FROM raw_events").first()[0] == 3
    lake.write(numbers(spark, 0, 7), "raw_events", path=str(tmp_path / "other"))
    assert ids(SnapshotStore(spark, str(tmp_path / "other")).read("raw_events")) == list(range(7))
    lake.catalog.register("odd", TableSpec("odd", "/x", format="csv"))
    with pytest.raises(ValueError):
        lake.read("odd")


@pytest.mark.parametrize("fails_at", [1, 2])
def test_replacing_folders_survives_failing_renames(spark, tmp_path, monkeypatch, fails_at):
    old, new = tmp_path / "lake", tmp_path / "lake-new"
    for place, text in ((old, "old"), (new, "new")):
        place.mkdir()
        (place / "data").write_text(text)
    calls, real = [], snapshots.rename_new

    def rename(*args):
        calls.append(args)
        if len(calls) == fails_at:
            raise OSError("no rename")
        real(*args)

    monkeypatch.setattr(evaluate, "rename_new", rename)
    with pytest.raises(OSError):
        evaluate._move(spark, str(new), str(old))
    assert (old / "data").read_text() == "old" and sorted(os.listdir(tmp_path)) == ["lake"]


def test_replacing_never_moves_into_a_folder(spark, tmp_path):
    for name in ("lake", "lake-new"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "data").write_text(name)
    with pytest.raises(Exception):
        snapshots.rename_new(spark, str(tmp_path / "lake-new"), str(tmp_path / "lake"))
    assert sorted(os.listdir(tmp_path / "lake")) == ["data"]
