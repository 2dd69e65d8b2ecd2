"""Turn numbering of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import timestamp_of
from .slices import SLICE_KEYS, Slicing, earlier_slices, inside_slice, with_slices


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _one_where(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _with_turn_index(numbered: DataFrame, index: Column, columns: list[str]) -> DataFrame:
    kept = [index.alias(c) if c == "turn_index" else F.col(c) for c in columns]
    return numbered.select(*kept, *([] if "turn_index" in columns else [index.alias("turn_index")]))


def assign_turn_index(events: DataFrame, slicing: Slicing = Slicing()) -> DataFrame:
    """Number the turns of each session by counting its ``turn_start`` events.

    Overwrites ``turn_index``. Events before the first turn and events without
    a session get null. Runs a job that counts the events of each session.
    """
    start = _one_where(F.col("event_type") == "turn_start")
    named = events.where(F.col("session_id").isNotNull())
    sliced, cut = with_slices(named, slicing)
    numbered = sliced.withColumn("_inside", F.sum(start).over(inside_slice(sliced)))
    count = F.col("_inside")
    if cut:
        before = (
            sliced.where("_cut")
            .groupBy(*SLICE_KEYS)
            .agg(F.sum(start).alias("_n"))
            .select(*SLICE_KEYS, F.sum("_n").over(earlier_slices()).alias("_before"))
        )
        numbered = numbered.join(before, SLICE_KEYS, "left")
        count = F.coalesce(F.col("_before"), _zero()) + count
    index = F.nullif(count, _zero())
    # Events without a session are not numbered and need no shuffle.
    unnamed = events.where(F.col("session_id").isNull())
    return _with_turn_index(numbered, index, events.columns).unionByName(
        _with_turn_index(unnamed, F.lit(None).cast("bigint"), events.columns)
    )


def carry_turn_index(events: DataFrame, slicing: Slicing = Slicing()) -> DataFrame:
    """Number turns where some events carry an explicit ``turn_index``.

    An explicit index holds and is counted on from: a later ``turn_start``
    without one adds 1, other events repeat the current value. Null until the
    first index or turn start; events without a session are dropped.

    With R the number of implicit starts up to a row, the index at a row is R
    plus the latest (explicit index - R at that index), 0 if there is none.
    """
    events = events.where(F.col("session_id").isNotNull())
    explicit = F.col("turn_index").cast("bigint")
    start = _one_where(explicit.isNull() & (F.col("event_type") == "turn_start"))
    sliced, is_cut = with_slices(events, slicing)

    def scanned(rows: DataFrame) -> DataFrame:
        inside = inside_slice(rows)
        offset = F.when(explicit.isNotNull(), explicit - F.col("_starts"))
        return rows.withColumn("_starts", F.sum(start).over(inside)).withColumn(
            "_anchor", F.last(offset, ignorenulls=True).over(inside)
        )

    if not is_cut:
        starts, anchor = F.col("_starts"), F.col("_anchor")
        index = F.when(anchor.isNotNull() | (starts > 0), F.coalesce(anchor, _zero()) + starts)
        return _with_turn_index(scanned(sliced), index, events.columns)

    # Of cut sessions, find where each slice ends up. Only explicit and starting
    # rows move its state; the others need not be sorted for that.
    cut = sliced.where("_cut")
    moving = cut.where(explicit.isNotNull() | (F.col("event_type") == "turn_start")).select(
        *SLICE_KEYS, "ts", "event_id", "event_type", "turn_index", *(c for c in ("position",) if c in events.columns)
    )
    ends = (
        scanned(moving)
        .where(explicit.isNotNull())
        .groupBy(*SLICE_KEYS)
        .agg(F.max_by("_anchor", _ascending_key(moving)).alias("_end_anchor"))
    )
    earlier = earlier_slices()
    before = (
        cut.groupBy(*SLICE_KEYS)
        .agg(F.sum(start).alias("_n"))
        .join(ends, SLICE_KEYS, "left")
        .withColumn("_starts_before", F.coalesce(F.sum("_n").over(earlier), _zero()))
        .withColumn(
            "_anchor_before",
            F.last(F.col("_end_anchor") - F.col("_starts_before"), ignorenulls=True).over(earlier),
        )
        .select(*SLICE_KEYS, "_starts_before", "_anchor_before")
    )
    numbered = scanned(sliced).join(before, SLICE_KEYS, "left")
    starts_before = F.coalesce(F.col("_starts_before"), _zero())
    starts = starts_before + F.col("_starts")
    anchor = F.coalesce(F.col("_anchor") - starts_before, F.col("_anchor_before"))
    index = F.when(anchor.isNotNull() | (starts > 0), F.coalesce(anchor, _zero()) + starts)
    return _with_turn_index(numbered, index, events.columns)


def _ascending_key(rows: DataFrame) -> Column:
    """Struct that compares like ``event_order``; the flags put nulls last."""
    fields = []
    names = [c for c in ("event_id", "position", "turn_index", "event_type") if c in rows.columns]
    for part in (timestamp_of(rows), *map(F.col, names)):
        n = len(fields)
        fields += [part.isNull().alias(f"k{n}"), part.alias(f"k{n + 1}")]
    return F.struct(*fields)
