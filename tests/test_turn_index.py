"""Turn numbering against a plain loop, with sessions cut into slices of all kinds."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from agentlake.operators import assign_turn_index, carry_turn_index
from agentlake.operators.slices import Slicing, with_slices

SCHEMA = "row INT, session_id STRING, ts TIMESTAMP, event_id BIGINT, event_type STRING, turn_index BIGINT"
SLICINGS = [
    Slicing(),
    Slicing(crowded_rows=10),
    Slicing(crowded_rows=60),
    Slicing(crowded_rows=0),
]


def _random_events(seed):
    rng = random.Random(seed)
    day = datetime(1969, 12, 31, 22)  # slices before and after the origin of time
    rows = []
    for row in range(400):
        ts = rng.choice(
            [
                None,
                day,
                day + timedelta(hours=rng.randrange(4)),
                day + timedelta(seconds=rng.randrange(10)),
                day + timedelta(microseconds=rng.randrange(4_000_000)),
                day + timedelta(minutes=rng.randrange(400), microseconds=rng.randrange(3)),
            ]
        )
        rows.append(
            (
                row,
                rng.choice(["hot", "hot", "hot", "b", "c", None]),
                ts,
                rng.choice([None, row, row, row, 400 - row]),
                rng.choice(["turn_start", "error", "llm_request", None]),
                rng.choice([None, None, None, None, None, None, 0, 5, 9]),
            )
        )
    return rows


def _last(value):
    return (value is None, value)


def _ordered(rows):
    return sorted(rows, key=lambda r: (_last(r[2]), _last(r[3]), _last(r[5]), _last(r[4])))


def _counted(rows):
    counters, result = {}, {}
    for row, session, _, _, kind, _ in rows:
        counters[session] = counters.get(session, 0) + (kind == "turn_start")
        result[row] = (counters[session] or None) if session is not None else None
    return result


def _carried(rows):
    current, result = {}, {}
    for row, session, _, _, kind, explicit in rows:
        if session is None:
            continue
        if explicit is not None:
            current[session] = explicit
        elif kind == "turn_start":
            current[session] = current.get(session, 0) + 1
        result[row] = current.get(session)
    return result


def _found(df):
    return {r["row"]: r["turn_index"] for r in df.select("row", "turn_index").collect()}


@pytest.mark.parametrize("slicing", SLICINGS)
def test_counting_matches_a_loop(spark, slicing):
    rows = _random_events(1)
    df = spark.createDataFrame(rows, SCHEMA)
    # Overwritten indexes do not take part in the order of ties here.
    rows = sorted(rows, key=lambda r: (_last(r[2]), _last(r[3]), _last(r[4])))
    assert _found(assign_turn_index(df.drop("turn_index"), slicing)) == _counted(rows)


@pytest.mark.parametrize("slicing", SLICINGS)
@pytest.mark.parametrize("seed", [2, 3])
def test_carrying_matches_a_loop(spark, slicing, seed):
    rows = _random_events(seed)
    found = _found(carry_turn_index(spark.createDataFrame(rows, SCHEMA), slicing))
    assert found == _carried(_ordered(rows))


NOON = datetime(2024, 1, 1, 12)
CROWDS = {
    "one outlier": [(NOON + timedelta(milliseconds=k), k) for k in range(2000)] + [(datetime(1970, 1, 1), 2000)],
    "bursts": [(NOON + timedelta(hours=k % 3, microseconds=k % 2), k) for k in range(2000)],
    "sparse ids": [(None, k << 40) for k in range(-1000, 1000)],
    "ids at both ends": [(None, (1 << 63) - 1 - k) for k in range(1000)] + [(NOON, k - (1 << 63)) for k in range(1000)],
    "no time, no id": [(None, 0)] * 2000,
}


@pytest.mark.parametrize("name", CROWDS)
def test_slices_are_few_small_and_in_order(spark, name):
    rows = [(k, "hot", ts, event_id, "error", None) for k, (ts, event_id) in enumerate(CROWDS[name])]
    rows += [(10_000 + k, "small", NOON, k, "error", None) for k in range(90)]
    df, cut = with_slices(spark.createDataFrame(rows, SCHEMA).withColumn("position", F.col("row")), Slicing(crowded_rows=100))
    sizes = [r["count"] for r in df.where("session_id = 'hot'").groupBy("_slice").count().collect()]
    assert cut and max(sizes) < 200 and len(sizes) <= len(CROWDS[name]) / 100 + 1
    hot = df.where("session_id = 'hot'").orderBy(F.asc_nulls_last("ts"), "event_id", "position").collect()
    assert [r["_slice"] for r in hot] == sorted(r["_slice"] for r in hot) and {r["_cut"] for r in hot} == {True}
    assert [tuple(r) for r in df.where("session_id = 'small'").select("_slice", "_cut").distinct().collect()] == [(0, False)]


def test_explicit_then_start_then_zero(spark):
    at = datetime(2024, 1, 1)
    kinds = [("note", None), ("note", 5), ("turn_start", None), ("note", None), ("note", 0), ("note", None)]
    rows = [(i, "s", at + timedelta(seconds=i), i, *k) for i, k in enumerate(kinds)]
    found = _found(carry_turn_index(spark.createDataFrame(rows, SCHEMA)))
    assert [found[i] for i in range(6)] == [None, 5, 6, 6, 0, 0]


def test_text_timestamps_and_column_order(spark):
    rows = [
        ("2024-01-01T00:00:02Z", 1, "s", "turn_start"),
        ("2024-01-01T00:00:01Z", 2, "s", "error"),
        ("", 3, "s", "error"),
    ]
    events = spark.createDataFrame(rows, "ts STRING, event_id INT, session_id STRING, event_type STRING")
    numbered = assign_turn_index(events)
    assert numbered.columns == ["ts", "event_id", "session_id", "event_type", "turn_index"]
    assert {r["event_id"]: r["turn_index"] for r in numbered.collect()} == {1: 1, 2: None, 3: 1}


def test_empty_input_keeps_the_schema(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert assign_turn_index(empty).schema == empty.schema
    assert carry_turn_index(empty).columns == empty.columns
    assert assign_turn_index(empty).count() == carry_turn_index(empty).count() == 0
