"""Reports, rounding and quantiles on edge values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from agentlake.functions import exact_quantiles, quantiles, round2
from agentlake.plans import evaluation, perf, tokens, treatments

STATUS = "app_id STRING, app_status STRING, app_type STRING, duration_s DOUBLE, react_rounds BIGINT"
META = (
    "app_id STRING, session_id STRING, llm_model STRING, total_tokens BIGINT, prompt_tokens BIGINT, "
    "completion_tokens BIGINT, accumulated_cost DOUBLE"
)


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_round2(spark):
    values = [1.005, 0.285, 2.675, -1.005, 1234.565, None]
    found = spark.createDataFrame([(v,) for v in values], "x DOUBLE").select(round2(F.col("x"))).collect()
    expected = [None if v is None else float(np.sign(v) * np.floor(abs(v) * 100.0 + 0.5) / 100.0) for v in values]
    assert [r[0] for r in found] == expected
    assert found[0][0] == 1.0


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [1.0, 2.0],
        [5.0] * 50 + [1.0] * 50,
        [float(x) for x in random.Random(1).sample(range(10**9), 999)],
        [random.Random(i).lognormvariate(0, 4) for i in range(500)],
        [10.0**(i % 300) * (i % 7 - 3) for i in range(900)],
        [1e300, -1e300, 1e-300, 0.0, -0.0, 7.0, 1e18, 1e18 + 4096],
        [1.0 + i * 2.0**-50 for i in range(300)] + [1e30, 1e15],
        [2.0**60, 3.0, 3.0, 4.0, 5.0, None, None],
    ],
)
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v, 1) for v in values], "x DOUBLE, one INT")
    fractions = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = {(r.metric, r.q): r.value for r in exact_quantiles(df, {"x": fractions, "one": [0.5]}).collect()}
    known = [v for v in values if v is not None]
    assert found.pop(("one", 0.5)) == 1.0
    for (_, q), value in found.items():
        assert value == pytest.approx(np.quantile(known, q), rel=1e-12)
    assert len(found) == len(fractions)


@pytest.mark.parametrize(("sketch", "margin", "sorted_rows"), [(8, 0.2, 1 << 21), (16, 0.2, 100), (8, 0.0001, 1 << 21), (8, 0.001, 20), (100, 0.02, 50)])
def test_quantiles_by_small_and_wrong_sketches(spark, monkeypatch, sketch, margin, sorted_rows):
    """Bounds that are much too narrow, or hold more than one task may sort, cost scans, not results."""
    for name, value in (("SKETCH", sketch), ("MARGIN", margin), ("SORTED_ROWS", sorted_rows)):
        monkeypatch.setattr(quantiles, name, value)
    rng = random.Random(3)
    values = rng.choices(range(1000), k=777)
    rows = [(v, v * 1.5 if v % 7 else None, rng.choice([1.0, float("nan"), float("inf"), -5.0])) for v in values]
    df = spark.createDataFrame(rows, "x INT, y DOUBLE, z DOUBLE").repartition(5)
    wanted = {"x": [0.3, 0.0, 1.0, 0.3], "y": [0.5], "z": [0.1, 0.3, 0.99]}
    found = {(r.metric, r.q): r.value for r in exact_quantiles(df, wanted).collect()}
    assert len(found) == 7
    for q in (0.3, 0.0, 1.0):
        assert found["x", q] == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert found["y", 0.5] == pytest.approx(np.quantile([r[1] for r in rows if r[1] is not None], 0.5), rel=1e-12)
    last = sorted((r[2] for r in rows), key=lambda v: (v != v, v if v == v else 0.0))
    assert found["z", 0.1] == last[77] == -5.0 and found["z", 0.3] == 1.0 and np.isnan(found["z", 0.99])


def test_two_scans_find_quantiles(spark):
    scans = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    df = spark.range(0, 50_000, 1, 4).selectExpr("cast((id * 7919) % 50021 AS DOUBLE) AS x").mapInArrow(seen, "x DOUBLE")
    got = {r.q: r.value for r in exact_quantiles(df, {"x": [0.25, 0.5, 0.75]}).collect()}
    exact = np.quantile([(k * 7919) % 50021 for k in range(50_000)], [0.25, 0.5, 0.75])
    assert [got[q] for q in (0.25, 0.5, 0.75)] == pytest.approx(exact.tolist()) and scans.value == 100_000


def test_quantiles_of_clustered_values(spark):
    """Values close to each other, with outliers, are cut apart as well as others."""
    values = spark.range(20_000).selectExpr("1.0e12D + id / 1000 AS x").union(spark.createDataFrame([(0.0,), (1.005e12,), (1e13,)], "x DOUBLE"))
    (row,) = exact_quantiles(values, {"x": [0.5]}).collect()
    assert row.value == pytest.approx(np.quantile([r.x for r in values.collect()], 0.5), rel=1e-15)


def test_infinite_values_sort_last(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, float("inf"), float("inf")]], "x DOUBLE")
    (row,) = exact_quantiles(df, {"x": [0.25]}).collect()
    assert row.value == 2.0


def test_token_distribution_of_nothing(spark):
    (row,) = tokens.token_distribution(spark.createDataFrame([], META)).collect()
    assert set(row) == {None} and len(row) == 18


def test_token_reports(spark):
    rows = [
        ("b", "s1", "m", 10, 6, 4, 1.0), (None, "s2", "m", None, 1, 1, None), ("a", "s3", None, 30, 2, 2, 2.0),
        ("a", "s4", "m", 20, 3, 3, 3.0),
    ]
    df = spark.createDataFrame(rows, META)
    assert [r.session_id for r in tokens.token_summary(df).collect()] == ["s3", "s4", "s1", "s2"]
    (d,) = tokens.token_distribution(df).collect()
    assert (d.min_total_tokens, d.q1_total_tokens, d.median_total_tokens, d.q3_total_tokens) == (10, 15.0, 20.0, 25.0)
    assert (d.median_prompt_tokens, d.median_cost, d.max_cost, d.mean_total_tokens) == (2.5, 2.0, 3.0, 20.0)
    assert [(r.llm_model, r.conversation_count, r.total_tokens, r.avg_cost_per_conv)
            for r in tokens.model_breakdown(df).collect()] == [(None, 1, 30, 2.0), ("m", 3, 30, 2.0)][::-1]


def test_duration_and_rounds(spark):
    rows = [("a", "ok", "t", 10.0, 0), ("b", None, "t", 0.0, 4), ("c", "ok", "t", 10.0, 3), ("d", "ok", "t", None, None)]
    df = spark.createDataFrame(rows, STATUS)
    found = [(r.app_id, r.seconds_per_round) for r in perf.duration_summary(df).collect()]
    assert found == [("a", None), ("c", 3.33), ("b", None), ("d", None)]
    found = [(r.app_id, r.seconds_per_round, r.min_rounds, r.max_rounds) for r in evaluation.react_analysis(df).collect()]
    assert found == [("b", 0.0, 0, 4), ("c", 3.33, 0, 4), ("a", None, 0, 4), ("d", None, 0, 4)]
    assert tuples(evaluation.success_summary(df)) == [("ok", 3, 75.0), (None, 1, 25.0)]


def test_throughput(spark):
    events = spark.createDataFrame(
        [("a", "s1", 5, None), ("a", "s1", 7, 3), ("a", "s2", 1, 1), ("b", "s3", None, 9), ("z", "s4", 1, 1),
         (None, "s5", 1, 1)],
        "app_id STRING, session_id STRING, output_tokens BIGINT, input_tokens BIGINT",
    )
    rows = [("a", "", "", 4.0, 1), ("b", "", "", 2.0, 1), ("c", "", "", 0.0, 1), (None, "", "", 1.0, 1)]
    found = tuples(perf.throughput(events, spark.createDataFrame(rows, STATUS)))
    assert found == [
        ("a", 4.0, 7, 3, 1.75, 2.5), ("a", 4.0, 1, 1, 0.25, 0.5), ("b", 2.0, None, None, None, 0.0),
        ("c", 0.0, None, None, None, None), (None, 1.0, None, None, None, 0.0),
    ]


def test_event_reports(spark):
    events = spark.createDataFrame(
        [
            ("b", "s1", "delegate", None, '{"content":{"args":{"agent":"x"}}}'),
            ("b", "s1", "delegate", None, '{"content":{"args":{"agent":"x"}}}'),
            ("b", "s2", "delegate", None, '{"content":{"args":{"agent":null}}}'),
            ("b", "s2", "delegate", None, "{}"),
            (None, "s2", "tool_call", "t", "{}"),
            ("a", "s1", "tool_call", "t", "{}"),
            ("a", "s1", "tool_call", "u", "{}"),
            ("a", "s2", "tool_call", "t", "{}"),
            ("a", "s2", None, "t", "{}"),
            ("a", None, "think", "u", '{"content":{"args":{"agent":"x"}}}'),
        ],
        "app_id STRING, session_id STRING, event_type STRING, tool_name STRING, payload STRING",
    )
    assert tuples(perf.action_distribution(events)) == [
        ("a", "tool_call", 3), ("a", "think", 1), ("b", "delegate", 4), (None, "tool_call", 1),
    ]
    assert tuples(evaluation.tool_usage(events)) == [("t", 4, 2), ("u", 2, 1)]
    assert tuples(evaluation.agent_delegation(events)) == [("b", "s1", "x", 2)]


def test_cost_efficiency(spark):
    conversations = spark.createDataFrame(
        [("a", "s1", "m", 100, 0, 0, 3.0), ("a", "s2", "m", 100, 0, 0, 0.0), ("n", "s3", "m", 100, 0, 0, None),
         ("z", "s4", "m", 100, 0, 0, 5.0)],
        META,
    )
    status = spark.createDataFrame([("a", "", "", 9.0, 2), ("a", "", "", 8.0, 0), ("z", "", "", 1.0, None)], STATUS)
    found = {(r.session_id, r.react_rounds): (r.cost_per_round, r.tokens_per_cost_unit)
             for r in evaluation.cost_efficiency(conversations, status).collect()}
    assert found == {
        ("s1", 2): (1.5, 33.33), ("s1", 0): (None, 33.33), ("s2", 2): (0.0, None), ("s2", 0): (None, None),
        ("s3", None): (None, None), ("s4", None): (None, 20.0),
    }


def test_treatments(spark):
    turns = spark.createDataFrame(
        [("2024-01-01", "a", "s1", 1, 10.0, 5), ("2024-01-02", "a", "s1", 3, 30.0, 7),
         ("2024-01-02", "a", "s2", 1, 2.0, 1), ("2024-01-03", "a", "s2", 9, 2.0, 1), ("2024-01-02", "b", "s1", 9, 1.0, 1)],
        "dt STRING, app_id STRING, session_id STRING, react_iters BIGINT, duration_ms DOUBLE, input_tokens BIGINT",
    )
    treated = spark.createDataFrame(
        [("a", "s1", "new"), ("a", "s2", "old"), ("b", "s1", "other")],
        "app_id STRING, session_id STRING, variant STRING",
    )
    own = treated.where("app_id = 'a'")
    found = tuples(treatments.condense_impact(turns, own, "a", "2024-01-01", "2024-01-02"))
    assert found == [("old", 1.0, 2.0, 1.0), ("new", 2.0, 20.0, 6.0)]
    rows = treatments.condense_rows(turns, treated, "a")
    assert rows.count() == 4 and {r.variant for r in rows.collect()} == {"new", "old"}
    assert sorted(rows.columns) == sorted([*turns.columns, "variant"])
