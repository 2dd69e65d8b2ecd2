"""User-written operators and reports by name."""

import pyarrow as pa
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from agentlake.operators import (
    BatchOperator,
    BuildSessions,
    BuildTurnsAndErrors,
    Operator,
    apply,
    batch_sql,
    map_pandas,
)
from agentlake.operators import GroupBatchOperator
from agentlake.operators.apply import sized_batches
from agentlake.operators.groups import group_batches, group_starts
from agentlake.plans import REPORTS, Report, register_report, run_report
from agentlake.sources import Lake, default_catalog


def operator(outputs_, result):
    class Fixed(Operator):
        outputs = outputs_

        def transform(self, ctx, df):
            return result(df)

    return Fixed()


def test_single_and_named_outputs(spark):
    df = spark.range(3)
    assert apply(operator(("out",), lambda d: d), df)["out"].count() == 3
    assert apply(operator(("x",), lambda d: {"x": d}), df)["x"].count() == 3
    both = apply(operator(("x", "y"), lambda d: {"y": d.where("id > 0"), "x": d}), df)
    assert (both["x"].count(), both["y"].count()) == (3, 2)


@pytest.mark.parametrize(
    "outputs, result, error",
    [
        (("x",), lambda d: {"y": d}, ValueError),
        (("x", "y"), lambda d: {"x": d}, ValueError),
        (("x",), lambda d: {"x": d, "y": d}, ValueError),
        (("x", "y"), lambda d: d, ValueError),
        (("x",), lambda d: 5, TypeError),
        (("x",), lambda d: {"x": None}, TypeError),
    ],
)
def test_wrong_outputs_fail_before_anything_runs(spark, outputs, result, error):
    with pytest.raises(error):
        apply(operator(outputs, result), spark.range(3))


def test_the_context_is_passed_on(spark, tmp_path):
    seen = []

    class Watching(Operator):
        def transform(self, ctx, df):
            seen.append(ctx)
            return df

    lake = Lake(spark, default_catalog(str(tmp_path)))
    lake.apply(Watching(), spark.range(1))
    assert seen == [lake]


class Sizes(BatchOperator):
    schemas = {"out": "rows BIGINT"}

    def transform(self, ctx, batch):
        return pa.table({"rows": pa.array([batch.num_rows], pa.int32())})


def test_batch_sizes(spark):
    df = spark.range(0, 100, 1, 2)
    found = apply(Sizes(batch_size=30), df)["out"].collect()
    assert sorted(r.rows for r in found) == [20, 20, 30, 30]
    assert sum(r.rows for r in apply(Sizes(), df)["out"].collect()) == 100


def test_regrouping_of_batches():
    batches = [pa.record_batch({"x": list(range(n))}) for n in (5, 0, 1, 9, 2)]
    sizes = [t.num_rows for t in sized_batches(iter(batches), 4)]
    assert sizes == [4, 4, 4, 4, 1]
    assert [t.num_rows for t in sized_batches(iter(batches), None)] == [5, 0, 1, 9, 2]
    values = [v for t in sized_batches(iter(batches), 4) for v in t["x"].to_pylist()]
    assert values == [v for b in batches for v in b["x"].to_pylist()]


class Split(BatchOperator):
    schemas = {"small": "id BIGINT", "large": "id BIGINT, text STRING"}

    def transform(self, ctx, batch):
        ids = batch["id"].to_pylist()
        large = [i for i in ids if i >= 7]
        return {
            "large": pa.table({"text": [str(i) for i in large], "id": pa.array(large, pa.int64())}),
            "small": pa.table({"id": pa.array([i for i in ids if i < 7], pa.int64())}),
        }


def test_several_batch_outputs(spark):
    found = apply(Split(batch_size=4), spark.range(10))
    assert sorted(r.id for r in found["small"].collect()) == list(range(7))
    assert sorted(map(tuple, found["large"].collect())) == [(7, "7"), (8, "8"), (9, "9")]


def test_wrong_batch_outputs(spark):
    class Wrong(BatchOperator):
        schemas = {"a": "id BIGINT", "b": "id BIGINT"}

        def transform(self, ctx, batch):
            return {"a": batch}

    class NoTable(BatchOperator):
        schemas = {"a": "id BIGINT"}

        def transform(self, ctx, batch):
            return [1, 2]

    with pytest.raises(Exception, match="are declared"):
        apply(Wrong(), spark.range(3))["a"].collect()
    with pytest.raises(Exception, match="Arrow tables"):
        apply(NoTable(), spark.range(3))["a"].collect()


def test_pandas_and_sql_over_batches(spark):
    df = spark.range(10)
    doubled = map_pandas(df, lambda frame: frame * 2, "id BIGINT")
    assert sorted(r.id for r in doubled.collect()) == list(range(0, 20, 2))
    assert batch_sql(df, "SELECT sum(id) AS s FROM {batch} WHERE id > {low}", low=7).first().s == 17


def test_turns_errors_and_sessions(spark):
    rows = [("d", "a", "s", i, t, e, None) for i, (t, e) in enumerate(
        [("turn_start", None), ("error", "E"), ("turn_start", None), ("llm_request", None)])]
    events = spark.createDataFrame(
        rows, "dt STRING, app_id STRING, session_id STRING, event_id BIGINT, event_type STRING, "
        "error_type STRING, turn_index BIGINT"
    ).withColumn("ts", F.timestamp_seconds("event_id")).withColumn("error_code", F.lit("1"))
    op = BuildTurnsAndErrors(StorageLevel.MEMORY_AND_DISK)
    found = apply(op, events)
    assert sorted((t.turn_index, t.react_iters, t.status) for t in found["turns"].collect()) == [
        (1, 0, "fail"), (2, 1, "success"),
    ]
    assert [(e.turn_index, e.error_type) for e in found["errors"].collect()] == [(1, "E")]
    (session,) = apply(BuildSessions(), found["turns"])["sessions"].collect()
    assert (session.turns_count, session.error_turns) == (2, 1)
    op.shared.unpersist()


def test_several_outputs_from_one_pass(spark):
    ran = spark.sparkContext.accumulator(0)

    class Both(BatchOperator):
        schemas = {"low": "id BIGINT", "high": "id BIGINT"}

        def transform(self, ctx, batch):
            ran.add(batch.num_rows)
            return {"low": batch.slice(0, 1), "high": batch.slice(1)}

    op = Both()
    found = apply(op, spark.range(100).coalesce(1), storage_level=StorageLevel.MEMORY_AND_DISK)
    assert found["low"].count() + found["high"].count() == 100 and ran.value == 100
    op.shared.unpersist()
    for kind in (Both, BuildSessions):
        with pytest.raises(ValueError, match="at least 1"):
            kind(batch_size=0)
    assert BuildSessions(batch_size=1024).batch_size == 1024


def test_reports_by_name(spark):
    register_report("sizes", Report(("t",), lambda tables, params: {"n": tables["t"].where(f"id > {params['low']}")}))
    assert run_report("sizes", {"t": spark.range(5)}, {"low": 2})["n"].count() == 2
    with pytest.raises(ValueError, match="needs the tables"):
        run_report("sizes", {})
    with pytest.raises(KeyError, match="token_stats"):
        run_report("nothing", {})
    del REPORTS["sizes"]


def test_outputs_from_one_written_pass(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    class Both(BatchOperator):
        schemas = {"low": "id BIGINT", "high": "id BIGINT, text STRING", "none": "x DOUBLE"}

        def transform(self, ctx, batch):
            ran.add(batch.num_rows)
            texts = pa.array([None if i % 2 else str(i) for i in batch["id"].to_pylist()])
            return {"low": batch.slice(0, 1), "high": batch.append_column("text", texts).slice(1), "none": pa.table({"x": pa.array([], pa.float64())})}

    found = apply(Both(), spark.range(100).coalesce(1), folder=str(tmp_path / "outputs"))
    assert ran.value == 100  # before any output is used
    for _ in range(2):
        assert found["low"].count() == 1 and found["none"].collect() == []
        assert sorted(map(tuple, found["high"].collect()))[:2] == [(1, None), (2, "2")]
    assert ran.value == 100 and found["high"].columns == ["id", "text"]
    assert all("_output=low" in f for f in found["low"].where("id >= 0").inputFiles() if "_output=low" in f)
    plan = found["low"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_output" in plan and "high" not in plan.split("ReadSchema")[-1]
    empty = apply(Both(), spark.range(0), folder=str(tmp_path / "empty"))
    assert [empty[n].count() for n in ("low", "high", "none")] == [0, 0, 0]


def test_written_outputs_of_an_operator_share_their_shuffle(spark, tmp_path):
    class Halves(Operator):
        outputs = ("even", "odd")

        def transform(self, ctx, df):
            counted = df.groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("s"))
            return {"even": counted.where("k % 2 = 0"), "odd": counted.where("k % 2 = 1").select("s")}

    found = apply(Halves(), spark.range(100), folder=str(tmp_path / "outputs"))
    assert sorted(map(tuple, found["even"].collect())) == [(k, 450 + 10 * k) for k in range(0, 10, 2)]
    assert sorted(r.s for r in found["odd"].collect()) == [450 + 10 * k for k in range(1, 10, 2)]


# --- whole groups in batches ---------------------------------------------------------------


def streams(rows, sizes):
    """The same rows in record batches of given sizes, over and over."""
    at, k = 0, 0
    while at < len(rows):
        part = rows[at : at + sizes[k % len(sizes)]]
        yield pa.record_batch({"k": pa.array([r[0] for r in part], pa.string()), "j": pa.array([r[1] for r in part], pa.int64()), "v": pa.array([r[2] for r in part], pa.int64())})
        at, k = at + sizes[k % len(sizes)], k + 1


@pytest.mark.parametrize("sizes", [[1], [3], [7, 0, 2], [100]])
@pytest.mark.parametrize(("size", "most"), [(None, 5), (4, 5), (10, 2), (1, 1), (6, 1000)])
def test_groups_stay_whole(sizes, size, most):
    rng = __import__("random").Random(str((sizes, size, most)))
    lengths = [rng.choice([1, 1, 2, 3, 5, 6, 11, 40]) for _ in range(40)]
    names = [(None if g % 9 == 0 else f"g{g // 2:02d}", g if g % 5 else None) for g in range(40)]
    rows = [(*names[g], v) for g, n in enumerate(lengths) for v in range(n)]
    sizes = [s or 1 for s in sizes]
    found, parts = [], {}
    out = list(group_batches(streams(rows, sizes), ("k", "j"), size, most))
    for batch in out:
        own = list(zip(*(batch.table[c].to_pylist() for c in ("k", "j", "v"))))
        found += own
        groups = {r[:2] for r in own}
        if batch.part:
            assert len(groups) == 1 and len(own) <= most
            parts.setdefault(groups.pop(), []).append(batch.last)
        else:
            assert all(sum(r[:2] == g for r in own) == sum(r[:2] == g for r in rows) <= most for g in groups)
    assert sorted(map(str, found)) == sorted(map(str, rows)) and len(found) == len(rows)
    for name, lasts in parts.items():
        assert lasts == [False] * (len(lasts) - 1) + [True]
        assert [r for r in found if r[:2] == name] == [r for r in rows if r[:2] == name]
    assert {names[g] for g, n in enumerate(lengths) if n > most} == set(parts)
    if size:
        whole = [b.table.num_rows for b in out if not b.part]
        assert all(n >= size for n in whole[:-1])


def test_sessions_in_batches(spark):
    rows = [(f"s{k % 7}" if k % 11 else None, (k * 37) % 500, k) for k in range(500)] + [("hot", k, 1000 + k) for k in range(300)]
    df = spark.createDataFrame(rows, "session_id STRING, event_id BIGINT, v BIGINT").withColumn("ts", F.timestamp_seconds(F.lit(0)))

    class Walk(GroupBatchOperator):
        schemas = {"out": "session_id STRING, rows BIGINT, ordered BOOLEAN, parts BIGINT"}

        def rows_of(self, table, state, last):
            before, rows, parts = state or (-1, 0, 0)
            ids = table["event_id"].to_pylist()
            ordered = [before, *ids] == sorted([before, *ids])
            name, rows, parts = table["session_id"][0].as_py(), rows + len(ids), parts + 1
            return [{"session_id": name, "rows": rows, "ordered": ordered, "parts": parts}] if last or not ordered else [], (ids[-1], rows, parts)

        def transform(self, ctx, batch):
            starts = [0, *group_starts(batch.combine_chunks().to_batches()[0], self.keys), batch.num_rows]
            found = [r for a, b in zip(starts, starts[1:]) for r in self.rows_of(batch.slice(a, b - a), None, True)[0]]
            return pa.Table.from_pylist(found, schema=self.arrow())

        def transform_part(self, ctx, batch, state, last):
            found, state = self.rows_of(batch, state, last)
            return pa.Table.from_pylist(found, schema=self.arrow()), state

        @staticmethod
        def arrow():
            return pa.schema([("session_id", pa.string()), ("rows", pa.int64()), ("ordered", pa.bool_()), ("parts", pa.int64())])

    expected = {}
    for name, _, _ in rows:
        expected[name] = expected.get(name, 0) + 1
    for op in (Walk(batch_size=100), Walk(most_rows=50), Walk(batch_size=7, most_rows=299)):
        found = apply(op, df.repartition(6))["out"].collect()
        assert {r.session_id: r.rows for r in found} == expected and len(found) == len(expected) and all(r.ordered for r in found)
        assert {r.session_id: r.parts for r in found} == {n: -(-c // op.most_rows) if c > op.most_rows else 1 for n, c in expected.items()}
    assert apply(Walk(), df.limit(0))["out"].collect() == []

    class NoParts(Walk):
        transform_part = GroupBatchOperator.transform_part

    with pytest.raises(Exception, match="takes no parts"):
        apply(NoParts(most_rows=50), df)["out"].collect()
    with pytest.raises(ValueError, match="most_rows"):
        Walk(most_rows=0)
