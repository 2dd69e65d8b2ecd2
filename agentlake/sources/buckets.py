"""Tables stored by session, so that what follows needs no further shuffle by session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import scratch_path, stored

#: Bits in which ``monotonically_increasing_id`` counts the rows of a partition.
_ROW_BITS = 33


def write_buckets(df: DataFrame, table: str, buckets: int, keys: Sequence[str] = ("session_id",), path: str | None = None) -> DataFrame:
    """Store ``df`` as the table ``table``, replacing it, with all rows of a key in one of ``buckets`` buckets, sorted by key;
    returns it. Joins, groups and windows by the keys (or by them and more) then read the buckets side by side without a
    shuffle, if both sides have as many. Each bucket is one file and one task, so there should be as many as keep a
    bucket, and its largest session, small enough for a task."""
    if buckets < 1:
        raise ValueError(f"buckets must be at least 1, not {buckets}")
    dealt = df.repartition(buckets, *keys)
    place = path or scratch_path(df.sparkSession)
    dealt.write.mode("overwrite").option("path", place).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def number_sessions(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """(session_id, session_number): a dictionary of all sessions (not null), numbered from 1 without gaps, in order.

    Sessions are ranged over tasks and written once; numbers are places in a range plus the sizes of the ranges before.
    """
    spark = events.sparkSession
    number = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = events.where("session_id IS NOT NULL").select("session_id").distinct().repartitionByRange(number, "session_id")
    place = F.monotonically_increasing_id()
    placed = stored(names.sortWithinPartitions("session_id").withColumn("place", place))
    part = F.shiftright("place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.col("place") - F.shiftleft(part, _ROW_BITS)
    return placed.join(F.broadcast(before), part == F.col("part")).select("session_id", (F.col("before") + inside + 1).alias("session_number"))


def with_session_numbers(events: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Events with the number of their session (null without one), for reports that count sessions by bitmaps."""
    numbers = number_sessions(events) if dictionary is None else dictionary
    return events.drop("session_number").join(numbers, "session_id", "left").select(*(c for c in events.columns if c != "session_number"), "session_number")
