"""Batches of whole groups, such as sessions, in order.

A ``GroupBatchOperator`` gets Arrow tables in which every group that occurs is whole and in order, as logic that walks
through sessions needs them. Groups are brought together by one shuffle and one sort, which spill to disk; a task
holds a batch and the group that is being gathered, no more. A group above ``most_rows`` rows, which may hold a
large share of the table, is handed over in parts, with whatever the operator wants to know of the parts before.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .apply import BatchOperator, named_outputs
from .slices import event_order


class GroupBatch(NamedTuple):
    table: pa.Table
    part: bool = False  # of a single group that is too long
    last: bool = True  # of its parts


class GroupBatchOperator(BatchOperator):
    """Subclass with ``schemas`` and ``transform(ctx, batch)``, as of a ``BatchOperator``; batches hold at least ``batch_size``
    rows, except for the last one of a task. For groups above ``most_rows`` rows define ``transform_part`` too."""

    #: Rows that agree in these are a group; null is a value.
    keys: tuple[str, ...] = ("session_id",)

    def __init__(self, batch_size: int | None = None, most_rows: int = 1 << 18):
        super().__init__(batch_size)
        if most_rows < 1:
            raise ValueError(f"most_rows must be at least 1, not {most_rows}")
        self.most_rows = most_rows

    def order(self, df: DataFrame) -> list[Column]:
        """The order of rows inside a group: by default that of events in a session."""
        return event_order(df)

    def transform_part(self, ctx: Any, batch: pa.Table, state: Any, last: bool) -> tuple[Any, Any]:
        """Outputs of the next rows of a long group, and the state for its following part (None before the first)."""
        raise NotImplementedError(f"a group has more than {self.most_rows} rows, and {type(self).__name__} takes no parts")

    def arranged(self, df: DataFrame) -> DataFrame:
        return df.repartition(*self.keys).sortWithinPartitions(*(F.asc_nulls_first(k) for k in self.keys), *self.order(df))

    def results(self, batches: Iterator[pa.RecordBatch], convert: Any) -> Iterator[tuple[str, pa.Table]]:
        state = None
        for batch in group_batches(batches, self.keys, self.batch_size, self.most_rows):
            if batch.part:
                made, state = self.transform_part(None, batch.table, state, batch.last)
                state = None if batch.last else state
            else:
                made = self.transform(None, batch.table)
            yield from named_outputs(made, self.outputs, convert).items()


def group_starts(batch: pa.RecordBatch, keys: tuple[str, ...]) -> list[int]:
    """Places at which a row differs in its keys from the one before it; the first row is none."""
    n = batch.num_rows
    if n < 2:
        return []
    changed = None
    for key in keys:
        column = batch.column(key)
        one, other = column.slice(0, n - 1), column.slice(1)
        differs = pc.or_(pc.fill_null(pc.not_equal(one, other), False), pc.xor(one.is_null(), other.is_null()))
        changed = differs if changed is None else pc.or_(changed, differs)
    return (pc.indices_nonzero(changed).to_numpy() + 1).tolist()


def group_batches(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], size: int | None, most: int) -> Iterator[GroupBatch]:
    """Regroup a stream in which the rows of a group stand together into tables of whole groups with at least ``size`` rows
    (default: what a batch completes), and groups of more than ``most`` rows into parts of ``most``."""
    held: list[pa.RecordBatch] = []  # whole groups
    gathered: list[pa.RecordBatch] = []  # of the last group
    held_rows = gathered_rows = 0
    key, parted = None, False

    def key_of(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(k)[row].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = group_starts(batch, keys)
        if gathered and key_of(batch, 0) != key:
            starts.insert(0, 0)
        if starts:
            head = batch.slice(0, starts[0])
            if gathered or head.num_rows:
                gathered.append(head)
                gathered_rows += head.num_rows
            if parted or gathered_rows > most:
                yield from _parts(gathered, most)
            elif gathered_rows:
                held += gathered
                held_rows += gathered_rows
            for low, high in zip(starts, starts[1:]):
                if high - low > most:
                    yield from _parts([batch.slice(low, high - low)], most)
                else:
                    held.append(batch.slice(low, high - low))
                    held_rows += high - low
            gathered, parted = [batch.slice(starts[-1])], False
            gathered_rows = gathered[0].num_rows
        else:
            gathered.append(batch)
            gathered_rows += batch.num_rows
        key = key_of(batch, batch.num_rows - 1)
        if held_rows and held_rows >= (size or 1):
            yield GroupBatch(pa.Table.from_batches(held))
            held, held_rows = [], 0
        if gathered_rows > most:  # whole parts go out; a last one stays, as more may follow
            table = pa.Table.from_batches(gathered)
            ready = (gathered_rows - 1) // most * most
            yield from _parts(table.slice(0, ready).to_batches(), most, last=False)
            gathered, gathered_rows, parted = table.slice(ready).to_batches(), gathered_rows - ready, True
    if parted or gathered_rows > most:
        yield from _parts(gathered, most)
    elif gathered_rows:
        held += gathered
        held_rows += gathered_rows
    if held_rows:
        yield GroupBatch(pa.Table.from_batches(held))


def _parts(batches: list[pa.RecordBatch], most: int, last: bool = True) -> Iterator[GroupBatch]:
    table = pa.Table.from_batches(batches)
    lows = range(0, table.num_rows, most)
    for low in lows:
        yield GroupBatch(table.slice(low, most), True, last and low == lows[-1])
