"""Cut crowded sessions into ordered slices of bounded size.

A running value over a session needs its events in order, but one session may
hold a large share of all rows, too many for one window partition. Sessions are
counted first. The events of those with too many are dealt by range of session
and order, and written once with the number of their range; these ranges are
the slices, about equally large wherever outliers, bursts or gaps lie. A
running value is then an associative scan: every slice is summed up, the sums
are added up in order, and a second pass over the slices starts from there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import timestamp_of
from ..scratch import stored

SLICE_KEYS = ["session_id", "_slice"]


@dataclass(frozen=True)
class Slicing:
    """Sessions of more than ``crowded_rows`` events are cut into slices of about so many. Events that are equal in their
    whole order key stay together. The driver holds one name for each ``crowded_rows`` events of crowded sessions."""

    crowded_rows: int = 1 << 20


def with_slices(events: DataFrame, slicing: Slicing) -> tuple[DataFrame, bool]:
    """Add ``_slice``, by which the slices of a session sort, and ``_cut``: whether
    the session has several. Also tells whether any has. All events must have a
    session. Runs a job that counts the events of each session, and one that
    writes the events of crowded ones, which are then read from there."""
    spark = events.sparkSession
    counts = events.groupBy("session_id").agg(F.count("*").alias("_rows")).where(F.col("_rows") > slicing.crowded_rows)
    crowded = [(r["session_id"], r["_rows"]) for r in counts.toLocalIterator()]
    whole = events.withColumn("_slice", F.lit(0)).withColumn("_cut", F.lit(False))
    if not crowded:
        return whole, False
    names = F.broadcast(spark.createDataFrame([(s,) for s, _ in crowded], "session_id STRING"))
    slices = -(-sum(rows for _, rows in crowded) // max(1, slicing.crowded_rows))
    dealt = events.join(names, "session_id", "left_semi").repartitionByRange(slices, "session_id", *event_order(events))
    cut = stored(dealt.withColumn("_slice", F.spark_partition_id())).withColumn("_cut", F.lit(True))
    return whole.join(names, "session_id", "left_anti").unionByName(cut), True


def event_order(events: DataFrame) -> list[Column]:
    """Order of events in a session; the last two only settle full ties, so that
    every evaluation, also one repeated after a lost executor, agrees on them."""
    ties = [F.col(c).asc_nulls_last() for c in ("position", "turn_index", "event_type") if c in events.columns]
    return [timestamp_of(events).asc_nulls_last(), F.col("event_id").asc_nulls_last(), *ties]


def inside_slice(sliced: DataFrame):
    return (
        Window.partitionBy(*SLICE_KEYS)
        .orderBy(*event_order(sliced))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def earlier_slices():
    return (
        Window.partitionBy("session_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
