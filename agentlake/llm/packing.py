"""Packing token pieces into as few sequences of a fixed capacity as it can.

How many pieces there are of each length is all that a plan needs, so the plan is made from a histogram of at most
``capacity`` numbers, whatever the size of the corpus. It consists of recipes: so many sequences of these lengths each.
Pieces are then numbered within their length, in parallel, and the number of a piece tells its recipe, sequence and
place; texts are never moved.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.llm.rows import without
from agentlake.llm.storage import materialize
from agentlake.llm.token_files import word_encoder
from agentlake.llm.words import slices

#: Pieces that leave a task at once.
OUT_ROWS = 512


# --- the plan --------------------------------------------------------------------------------------------------------


class Complements:
    """Exact complements: which gaps one, two or three of the available lengths fill, kept up to date as lengths run out.

    ``single[s]``, ``pairs[s]`` and ``triples[s]`` count the multisets of one, two and three different or equal lengths
    with sum s. They index sums by hash (place in an array), so a gap without an entry costs one look.
    """

    def __init__(self, available: np.ndarray):
        self.single = np.zeros(len(available), bool)
        self.pairs = np.zeros(len(available), np.int64)
        self.triples = np.zeros(len(available), np.int64)
        for length in np.flatnonzero(available):
            self._change(int(length), 1)

    def _change(self, length: int, by: int) -> None:
        size = len(self.single)
        if by > 0:
            self.single[length] = True
            self.pairs[length:] += self.single[: size - length]
            self.triples[length:] += self.pairs[: size - length].copy()
        else:
            self.triples[length:] -= self.pairs[: size - length].copy()
            self.pairs[length:] -= self.single[: size - length]
            self.single[length] = False

    def remove(self, length: int) -> None:
        self._change(length, -1)

    def pair(self, gap: int, left: np.ndarray, most: int) -> tuple[int, int] | None:
        """Two lengths that fill the gap, the longer as long as can be up to ``most``; ``left`` tells how many there are."""
        if gap < 2 or not self.pairs[gap]:
            return None
        long = np.arange((gap + 1) // 2, min(gap - 1, most) + 1)
        short = gap - long
        good = np.flatnonzero((left[long] > (long == short)) & (left[short] > 0))
        return (int(long[good[-1]]), int(short[good[-1]])) if len(good) else None

    def fill(self, gap: int, left: np.ndarray) -> tuple[int, ...] | None:
        """The fewest lengths, one to three, that fill the gap with what is left; of equally many the longest first."""
        if left[gap] > 0:
            return (gap,)
        if (two := self.pair(gap, left, gap)) is not None:
            return two
        if gap < 3 or not self.triples[gap]:
            return None
        first = np.arange((gap + 2) // 3, gap - 1)
        for length in first[(left[first] > 0) & (self.pairs[gap - first] > 0)][::-1].tolist():
            left[length] -= 1
            two = self.pair(gap - length, left, length)
            left[length] += 1
            if two is not None:
                return (length, *two)
        return None


@dataclass(frozen=True)
class Recipe:
    """``sequences`` sequences, each of ``parts``: (length, how often), the longest first."""

    parts: tuple[tuple[int, int], ...]
    sequences: int

    @property
    def filled(self) -> int:
        return sum(length * times for length, times in self.parts)


def _recipes(counts: np.ndarray, capacity: int, exact: bool, patient: bool) -> list[Recipe]:
    """Open a sequence with the longest length there is; fill the rest exactly with one to three lengths if that goes,
    else put in the longest that fits and look again. A recipe is repeated as often as its lengths last, which is what
    packing one sequence after the other would do, as what is available only shrinks.

    ``patient`` leaves lengths without an exact filling for the end; without ``exact`` this is best-fit decreasing.
    """
    left = counts.copy()
    complements = Complements(left > 0) if exact else None
    made, waiting = [], np.zeros_like(counts)

    def consume(parts: Counter) -> None:
        times = min(int(left[length]) // n for length, n in parts.items())
        made.append(Recipe(tuple(sorted(parts.items(), reverse=True)), times))
        for length, n in parts.items():
            left[length] -= n * times
            if not left[length] and complements:
                complements.remove(length)

    def one(length: int) -> tuple[Counter, bool]:
        parts, gap = Counter([length]), capacity - length
        left[length] -= 1
        while gap:
            if complements and (found := complements.fill(gap, left)):
                parts.update(found)
                gap -= sum(found)
                continue
            fitting = np.flatnonzero(left[: gap + 1] > 0)
            if not len(fitting):
                break
            parts[int(fitting[-1])] += 1
            left[fitting[-1]] -= 1
            gap -= int(fitting[-1])
            taken.append(int(fitting[-1]))
        left[length] += 1
        for x in taken:
            left[x] += 1
        taken.clear()
        return parts, gap == 0

    taken: list[int] = []
    while (there := np.flatnonzero(left)).size:
        length = int(there[-1])
        parts, full = one(length)
        if patient and not full:
            waiting[length], left[length] = left[length], 0
            complements.remove(length)
        else:
            consume(parts)
    if waiting.any():
        made += _recipes(waiting, capacity, exact, False)
    return made


def plan_sequences(counts: dict[int, int], capacity: int) -> list[Recipe]:
    """Recipes that use every piece once. ``counts``: number of pieces by length, 1 to ``capacity``.

    Made by exact complements, with lengths that find none either filled at once or packed by best fit at the end, and
    by best fit alone; the way with the fewest sequences counts.
    """
    table = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        table[length] = n
    ways = [_recipes(table, capacity, *way) for way in ((True, False), (True, True), (False, False))]
    return min(ways, key=lambda recipes: sum(r.sequences for r in recipes))


class Places:
    """Where the n-th piece of a length goes: its sequence and the place there."""

    def __init__(self, recipes: list[Recipe], capacity: int):
        self.shift = 63 - int(capacity + 1).bit_length()
        used, rows, base = Counter(), [], 0
        for recipe in recipes:
            offset = 0
            for length, times in recipe.parts:
                rows.append(((length << self.shift) + used[length], times, base, offset))
                used[length] += times * recipe.sequences
                offset += length * times
            base += recipe.sequences
        self.sequences = base
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.keys, self.times, self.base, self.offset = (np.ascontiguousarray(c) for c in table.T)

    def find(self, length: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << self.shift) + turn
        at = np.searchsorted(self.keys, key, side="right") - 1
        over = key - self.keys[at]
        return self.base[at] + over // self.times[at], self.offset[at] + over % self.times[at] * length


# --- pieces of documents ---------------------------------------------------------------------------------------------


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep: list[str] | None = None) -> DataFrame:
    """Token pieces of at most ``capacity`` ids: the columns in ``keep`` (default all but ``text``), then piece (from 0),
    start (ids of the document before it), length and ids (little-endian unsigned 32-bit).

    Every row is a document: its text's ids, then ``end_id``. Only documents longer than the capacity are cut, into
    full pieces and a last one that may be shorter. Null and empty texts are one piece of the end id. Repeated rows are
    documents of their own; input columns called like a result are replaced; no rows give none. ``tokenizer``: a file of
    the tokenizers library whose words end at ASCII white space.
    """
    made = ("piece", "start", "length", "ids")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made and (keep is not None or c != "text")]
    kinds = (T.IntegerType(), T.LongType(), T.LongType(), T.BinaryType())
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in zip(made, kinds)])
    names = [f"k{i}" for i in range(len(kept))]
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, end_id)
        for batch in batches:
            for part in slices(batch):
                ids, counts = encoder.encode(part.column("text"))
                data = ids.astype("<u4", copy=False).tobytes()
                pieces = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(counts[row] - start, capacity)
                begin = 4 * ((np.cumsum(counts) - counts)[row] + start)
                for k in range(0, len(row), OUT_ROWS):
                    cut = slice(k, k + OUT_ROWS)
                    own = part.select(names).take(pa.array(row[cut]))
                    parts = [data[a : a + n] for a, n in zip(begin[cut].tolist(), (4 * length[cut]).tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [*(own.column(n) for n in names), pa.array(piece[cut].astype(np.int32)), pa.array(start[cut]), pa.array(length[cut]), pa.array(parts, pa.binary())],
                        names=[*kept, *made])

    return rows.mapInArrow(run, schema)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Append sequence_id and offset (both long): where each piece of ``length`` ids goes. Sequences hold at most
    ``capacity`` ids, without gaps, and are as few as the plan can make them.

    Works on any table with a whole-number column ``length``; give it no more columns than needed, as rows are written
    once and shuffled once. Rows whose length is null, below 1 or above the capacity get null in both columns. Input
    columns called like a result are replaced; repeated rows are pieces of their own; no rows give none.

    A task numbers its pieces within each length as it writes them; sums of these counts over the tasks before it make
    the numbers whole. The driver gets one count for each length.
    """
    made = ("sequence_id", "offset", "pack_task", "pack_turn")
    rows = without(pieces, made)
    names, length = rows.columns, F.col("length").cast("long")
    usable = F.coalesce(length.between(1, capacity), F.lit(False))
    rows = rows.withColumn("pack_turn", F.when(usable, length).otherwise(0))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("pack_task", T.LongType()), T.StructField("pack_turn", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            own = batch.column(batch.num_columns - 1).to_numpy()
            order = np.argsort(own, kind="stable")
            new = np.diff(own[order], prepend=-1) != 0
            first = np.flatnonzero(new)
            place = np.empty(len(own), np.int64)
            place[order] = np.arange(len(own)) - np.repeat(first, np.diff([*first, len(own)]))
            turn = seen[own] + place
            seen += np.bincount(own, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.full(len(own), task)), pa.array(turn)], names=schema.names)

    stored = materialize(rows.mapInArrow(number, schema), "pieces")
    counts = stored.where(usable).groupBy(length.alias("pack_length"), "pack_task").agg(F.count("*").alias("n"))
    whole = counts.groupBy("pack_length").agg(F.sum("n").alias("n")).collect()  # one row a length
    places = stored.sparkSession.sparkContext.broadcast(Places(plan_sequences({r.pack_length: r.n for r in whole}, capacity), capacity))
    earlier = Window.partitionBy("pack_length").orderBy("pack_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("pack_length", F.col("pack_task").alias("pack_of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = stored.join(counts, (length == F.col("pack_length")) & (F.col("pack_task") == F.col("pack_of")), "left")
    ranked = ranked.select(*(F.col(f"`{c}`") for c in names), F.col("pack_length"), (F.col("before") + F.col("pack_turn")).alias("pack_turn"))
    schema = T.StructType([*(ranked.schema[c] for c in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, turn = (batch.column(batch.num_columns - k) for k in (2, 1))
            known = own.is_valid().to_numpy(zero_copy_only=False)
            found = np.zeros((2, batch.num_rows), np.int64)
            found[:, known] = places.value.find(own.drop_null().to_numpy(), turn.drop_null().to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *(pa.array(x, mask=~known) for x in found)], names=schema.names)

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids (binary): the packed pieces' ids in their places, one row a sequence. A group holds at most
    one sequence's ids, so at most the capacity; rows without sequence are left out."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all_, part: F.concat(all_, part["ids"]))
    return packed.where("sequence_id IS NOT NULL").groupBy("sequence_id").agg(joined.alias("ids"))
