"""Comparing word windows of all documents through compact messages.

Documents stand in groups of a few megabytes of text, in ascending order of doc_id (rows of one id, or of none, in
the order of their texts' hashes). Each group sends the hashes of its
windows, each once, to buckets by hash; a bucket compares what all groups sent and answers each group with the hashes
that concern it. Messages hold sorted hashes as byte planes of their differences, about three bytes a window, where a
shuffled row would take thirty. A window that every document has costs one entry for each group, so no bucket is hot.

The text is shuffled once; every step that follows reads the same exchange.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP_BYTES = 8 << 20
#: Bytes of text whose windows one bucket compares.
BUCKET_BYTES = 12 << 20
#: Most pieces of the doc_id distribution that groups follow.
PIECES = 256

MESSAGE = "bucket long, grp long, payload binary"
ANSWER = "grp long, payload binary"


@dataclass(frozen=True)
class Layout:
    """How many groups and buckets, and which rows a group holds: ``parts[i]`` groups from ``bounds[i]`` up to, but without,
    ``bounds[i + 1]``. Where that is a single id, its rows are divided by hashes of their texts; so are rows without id."""

    bounds: tuple[int, ...]
    parts: tuple[int, ...]
    buckets: int
    bits: int  # of a hash that serves as a filter; false hits cost work, not results
    without_id: int = 1

    @property
    def groups(self) -> int:
        return sum(self.parts) + self.without_id  # null ids come last

    @property
    def partitions(self) -> int:
        return min(self.groups, 2000 + self.groups // 16)

    def _piece(self, doc_id: Column) -> tuple[Column, ...]:
        """Of an id: its value, the piece's bounds, first group and number of groups."""
        value, piece = doc_id.cast("long"), piece_of(doc_id, self.bounds)
        low, high = (F.element_at(_longs(self.bounds), piece + k) for k in (0, 1))
        starts = [sum(self.parts[:k]) for k in range(len(self.parts))]
        start, parts = (F.element_at(_longs(values), piece) for values in (starts, self.parts))
        return value, low, high, start, parts

    def group(self, doc_id: Column, text_hash: Column) -> Column:
        """Ascending with doc_id and then the text's hash, of about equal size; null ids last."""
        value, low, high, start, parts = self._piece(doc_id)
        share = text_hash.cast("double") / F.lit(2.0**64) + F.lit(0.5)
        inside = F.when(high - low > 1, (value - low).cast("double") / (high - low).cast("double")).otherwise(share)
        place = start + F.least(F.floor(F.greatest(inside, F.lit(0.0)) * parts), parts - 1)
        last = sum(self.parts) + F.least(F.floor(share * self.without_id), F.lit(self.without_id - 1))
        return F.when(doc_id.isNull(), last).otherwise(place).cast("long")

    def groups_of(self, doc_id: Column) -> Column:
        """All groups that may hold rows of an id (not null)."""
        _, low, high, start, parts = self._piece(doc_id)
        whole = F.sequence(start, start + parts - 1)
        return F.when(high - low > 1, F.array(self.group(doc_id, F.lit(0)))).otherwise(whole)


def _longs(values) -> Column:
    return F.array(*(F.lit(int(v)).cast("long") for v in values)) if values else F.array().cast("array<long>")


def piece_of(doc_id: Column, bounds: tuple[int, ...]) -> Column:
    """Number, from 1, of the piece between two bounds that an id lies in."""
    return F.size(F.filter(_longs(bounds[1:-1]), lambda b: b <= doc_id.cast("long"))) + 1


def text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def plan_layout(docs: DataFrame, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> Layout:
    """Pieces begin at quantiles of the ids, and at every id whose rows alone are too large for a group; each piece is
    divided by the bytes of its texts. Where ids stand so close together that a group is still more than twice as
    large as it should be, its piece is cut at quantiles of that group, until none is."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length("text").alias("bytes"), text_hash().alias("hash"))
    size = F.coalesce(F.sum("bytes"), F.lit(0))
    whole, known, nameless = rows.agg(size, F.count("doc_id"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("bytes"))), F.lit(0))).first()
    buckets, bits = max(1, math.ceil(whole / bucket_bytes)), min(64, max(1, whole // 4).bit_length() + 12)
    without_id = max(1, math.ceil(nameless / group_bytes))
    if not known:
        return Layout((0, 1), (1,), buckets, bits, without_id)
    named = rows.where("doc_id IS NOT NULL")
    pieces = min(PIECES, max(1, whole // group_bytes))
    quantiles = named.approxQuantile("doc_id", [k / pieces for k in range(pieces + 1)], 1 / (4 * pieces))
    first, last = named.agg(F.min("doc_id"), F.max("doc_id")).first()
    # at most one id for each ``group_bytes`` of texts
    crowded = [r.doc_id for r in named.groupBy("doc_id").agg(size.alias("bytes"), F.count("*").alias("n")).where((F.col("bytes") > group_bytes) & (F.col("n") > 1)).collect()]
    starts = {first, *(q for q in map(int, quantiles) if first < q <= last), *crowded, *(c + 1 for c in crowded if c < last)}
    while True:
        bounds = (*sorted(starts), last + 1 if last < (1 << 63) - 1 else last)
        sizes = dict(named.groupBy(piece_of(F.col("doc_id"), bounds).alias("piece")).agg(size).collect())
        parts = tuple(max(1, math.ceil(sizes.get(k + 1, 0) / group_bytes)) for k in range(len(bounds) - 1))
        layout = Layout(bounds, parts, buckets, bits, without_id)
        group = layout.group(F.col("doc_id"), F.col("hash"))
        grouped = named.withColumn("grp", group)
        large = grouped.groupBy("grp").agg(size.alias("bytes"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        large = [r.grp for r in large.where((F.col("bytes") > 2 * group_bytes) & (F.col("low") < F.col("high"))).collect()]
        if not large:
            return layout
        cuts = F.percentile_approx("doc_id", [k / 8 for k in range(1, 8)], F.lit(1000))
        found = grouped.where(F.col("grp").isin(large)).groupBy("grp").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), cuts.alias("cuts")).collect()
        more = {c for r in found for c in (*r.cuts, r.low + 1, r.high) if r.low < c <= r.high}
        if not more - starts:
            return layout
        starts |= more


def in_groups(docs: DataFrame, layout: Layout) -> DataFrame:
    """doc_id, text, the text's hash and group, one shuffle."""
    grouped = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash().alias("text_hash"))
    return grouped.withColumn("grp", layout.group(F.col("doc_id"), F.col("text_hash"))).repartition(layout.partitions, "grp")


def pack(values: np.ndarray, codes: np.ndarray) -> bytes:
    """Sorted values without repeats, and a byte for each."""
    steps = np.diff(values)
    width = (int(steps.max(initial=1)).bit_length() + 7) // 8
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return b"".join([bytes([width]), int(values[0]).to_bytes(8, "little"), codes.astype(np.uint8).tobytes(), np.ascontiguousarray(planes).tobytes()])


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = payload[0]
    n = (len(payload) - 9 + width) // (width + 1)
    codes = np.frombuffer(payload, np.uint8, n, 9)
    steps = np.zeros((n, 8), np.uint8)
    steps[1:, :width] = np.frombuffer(payload, np.uint8, (n - 1) * width, 9 + n).reshape(width, n - 1).T
    values = steps.view("<u8").reshape(n)
    values[0] = int.from_bytes(payload[1:9], "little")
    return np.cumsum(values, dtype=np.uint64), codes


def messages(group: int, values: np.ndarray, codes: np.ndarray, buckets: int, bits: int) -> pa.Table:
    """One row for each bucket that the sorted ``values`` (hashes cut to ``bits``) fall into."""
    number = np.minimum((values.astype(np.float64) * (buckets / 2.0**bits)).astype(np.int64), buckets - 1)  # rises with the value
    used, first = np.unique(number, return_index=True)
    ends = [*first[1:].tolist(), len(values)]
    packed = [pack(values[a:b], codes[a:b]) for a, b in zip(first.tolist(), ends)]
    return pa.table({"bucket": pa.array(used, pa.int64()), "grp": pa.array(np.full(len(used), group)), "payload": pa.array(packed, pa.binary())})


#: From sorted values, their codes and run numbers: which entries to answer, and the codes of the answers.
Decide = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def answers(sent: DataFrame, decide: Decide) -> DataFrame:
    """Compare the entries of each bucket. ``decide(run, codes)`` sees the entries sorted by value and then by group,
    ``run`` numbering equal values, and returns a mask of entries to send back and codes for all entries."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("grp")
        parts = [unpack(p) for p in table["payload"].to_pylist()]
        groups = table["grp"].to_numpy()
        values = np.concatenate([v for v, _ in parts])
        codes = np.concatenate([c for _, c in parts])
        source = np.repeat(np.arange(len(parts)), [len(v) for v, _ in parts])
        del parts
        order = np.argsort(values, kind="stable")
        values, codes, source = values[order], codes[order], source[order]
        run = np.cumsum(np.diff(values, prepend=values[:1]) != 0)
        back, out = decide(run, codes)
        values, out, source = values[back], out[back], source[back]
        order = np.argsort(source, kind="stable")
        values, out, source = values[order], out[order], source[order]
        used, first = np.unique(source, return_index=True)
        ends = [*first[1:].tolist(), len(source)]
        packed = [pack(values[a:b], out[a:b]) for a, b in zip(first.tolist(), ends)]
        return pa.table({"grp": pa.array(groups[used], pa.int64()), "payload": pa.array(packed, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(compare, ANSWER)


def run_sums(run: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each entry, the sum over all entries with an equal value."""
    return np.bincount(run, weights=values)[run] if len(run) else values


def merged(payloads: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All answers that a group got, sorted by value."""
    parts = [unpack(p) for p in payloads]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    values, codes = np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(values, kind="stable")
    return values[order], codes[order]


def find(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value, or -1."""
    if len(sorted_values) == 0:
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[at] == wanted, at, -1)
