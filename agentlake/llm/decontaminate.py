"""Benchmark decontamination by multi-pattern search (Wu-Manber).

Every run of ``width`` words of a benchmark item is a pattern (an item of fewer words is one pattern). Documents are
brought to the same form, words joined by single spaces, and searched: a shift table over byte blocks skips positions at
which no pattern can end, buckets by the block at the pattern's tail select patterns, and byte comparison confirms them.
Positions are advanced for thousands of stretches of the text at once.

Spark makes the patterns, each once with all its items, and writes them in blocks of about ``block_bytes`` to the shared
folder. Documents are read once: a task gathers a few megabytes of them and loads one block after the other, so what it
holds is bounded however large the benchmark is, and nothing of it passes through the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.llm.rows import without
from agentlake.llm.storage import materialize, new_folder
from agentlake.llm.words import ALPHANUMERIC, SLICE_BYTES, Words, find_words, grouped_sums, slices

#: Least lengths in bytes of the pattern classes; each class is searched with shifts as long as its shortest pattern.
CLASSES = (1, 8, 16, 32, 64)
LANES = 8192
#: Text that is gathered before the blocks are gone through, where there are several.
GATHERED_BYTES = 24 << 20
_TABLE_BITS = 20

_fold = np.arange(256, dtype=np.uint8)
_fold[~ALPHANUMERIC] = 0x20
_fold[0x41:0x5B] += 0x20


def normal_form(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Folded words in one buffer with one space around each, and the place of each word's first byte."""
    inside = ALPHANUMERIC[words.buffer]
    inside[words.end] = True  # the separator behind each word
    form = np.empty(int(np.count_nonzero(inside)) + 1, dtype=np.uint8)
    form[0] = 0x20
    form[1:] = _fold[words.buffer[inside]]
    lengths = words.end - words.start + 1
    return form, np.cumsum(lengths) - lengths + 1


def item_patterns(texts: list[str | None], width: int) -> list[set[bytes]]:
    """Patterns of each text: b" w1 .. wn "."""
    words = find_words(pa.array(texts, pa.large_string()), ALPHANUMERIC, fold=True)
    form, places = normal_form(words)
    ends = np.append(places[1:], len(form))
    found = []
    for low, high in zip(words.first[:-1], words.first[1:]):
        last = max(low + 1, high - width + 1) if high > low else low
        found.append({form[places[i] - 1 : ends[min(i + width, high) - 1]].tobytes() for i in range(low, last)})
    return found


class WuManber:
    """Search for patterns of at least ``low`` bytes each; ``find`` gives (place, pattern number) of every occurrence.
    Patterns lie in one buffer, from ``starts`` to ``ends``."""

    def __init__(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.raw, self.starts, self.ends = buffer.tobytes(), starts, ends
        self.least = int((ends - starts).min())
        self.block = min(8, self.least)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        blocks = np.ndarray((len(buffer) + 1,), "<u8", self.raw + b"\0" * 8, strides=(1,))
        span = self.least - self.block + 1
        self.shift = np.full(1 << _TABLE_BITS, span, dtype=np.int32)
        for k in range(span):  # from afar to near; the last block of a pattern's head has shift 0
            tails = blocks[starts + k] & self.mask
            self.shift[self._slot(tails)] = span - 1 - k
        self.order = np.argsort(tails, kind="stable")
        self.keys = tails[self.order]

    @staticmethod
    def _slot(blocks: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, text: np.ndarray) -> tuple[list[int], list[int]]:
        n = len(text) - self.least + 1  # number of places at which a pattern can begin
        if n <= 0:
            return [], []
        raw = text.tobytes() + b"\0" * 8
        blocks = np.ndarray((len(text),), "<u8", raw, strides=(1,))
        lead = self.least - self.block
        bounds = np.linspace(0, n, min(LANES, n) + 1).astype(np.int64)
        at, stop = bounds[:-1].copy(), bounds[1:]
        hits = []
        while len(at):
            tail = blocks[at + lead] & self.mask
            move = self.shift[self._slot(tail)]
            zero = np.flatnonzero(move == 0)
            if len(zero):
                known = self.keys[np.minimum(np.searchsorted(self.keys, tail[zero]), len(self.keys) - 1)] == tail[zero]
                hits.append((at[zero[known]], tail[zero[known]]))
            at = at + np.maximum(move, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        places, numbers = [], []
        for some, tails in hits:
            low, high = np.searchsorted(self.keys, tails), np.searchsorted(self.keys, tails, side="right")
            for place, a, b in zip(some.tolist(), low.tolist(), high.tolist()):
                for number in self.order[a:b].tolist():
                    start, end = int(self.starts[number]), int(self.ends[number])
                    if raw.startswith(self.raw[start:end], place):
                        places.append(place)
                        numbers.append(number)
        return places, numbers


PATTERNS = "pattern binary, items array<string>"


def benchmark_patterns(benchmark: DataFrame, width: int) -> DataFrame:
    """pattern and the sorted ids (as text) of the items that have it, each pattern once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                for item, patterns in zip(part.column("item").to_pylist(), item_patterns(part.column("text").to_pylist(), width)):
                    if patterns:
                        yield pa.RecordBatch.from_arrays([pa.array(list(patterns), pa.binary()), pa.array([item] * len(patterns))], names=["pattern", "item"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    found = items.mapInArrow(run, "pattern binary, item string")
    return found.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))


def write_patterns(benchmark: DataFrame, width: int, block_bytes: int) -> tuple[str, int]:
    """Write the patterns in blocks of about ``block_bytes``, dealt by hash; returns the folder and the number of blocks."""
    spark = benchmark.sparkSession
    patterns = materialize(benchmark_patterns(benchmark, width), "patterns")
    size = patterns.agg(F.sum(F.length("pattern") + 16)).first()[0] or 0
    blocks, folder = -(-size // block_bytes), new_folder(spark, "blocks")
    if blocks:
        block = F.pmod(F.xxhash64("pattern"), F.lit(blocks)).alias("block")
        patterns.select("*", block).repartition(min(blocks, 1000), "block").write.partitionBy("block").parquet(folder)
    return folder, blocks


class Matcher:
    """Searches for one block of patterns in slices of documents."""

    def __init__(self, patterns: pa.Table):
        self.items = patterns["items"].combine_chunks()
        column = patterns["pattern"].combine_chunks().cast(pa.large_binary())
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        buffer = np.frombuffer(column.buffers()[2], np.uint8)
        starts, ends = offsets[:-1], offsets[1:]
        spaces = np.concatenate([[0], np.cumsum(buffer == 0x20)])
        self.words = spaces[ends] - spaces[starts] - 1
        self.searches = []
        for low, high in zip(CLASSES, [*CLASSES[1:], 1 << 62]):
            chosen = np.flatnonzero((ends - starts >= low) & (ends - starts < high))
            if len(chosen):
                self.searches.append((chosen, WuManber(buffer, starts[chosen], ends[chosen])))

    def mark(self, words: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Whether each word is hit, and the items found in each text (by its number)."""
        form, places = normal_form(words)
        edges = np.zeros(len(words.doc) + 1, dtype=np.int64)
        items: dict[int, set[str]] = defaultdict(set)
        for chosen, search in self.searches:
            found, numbers = search.find(form)
            first = np.searchsorted(places, np.asarray(found, dtype=np.int64) + 1)
            for word, number in zip(first.tolist(), numbers):
                pattern = int(chosen[number])
                last = word + int(self.words[pattern]) - 1
                if words.doc[word] == words.doc[last]:
                    edges[word] += 1
                    edges[last + 1] -= 1
                    items[int(words.doc[word])].update(self.items[pattern].as_py())
        return np.cumsum(edges[:-1]) > 0, items


@lru_cache(maxsize=1)
def load_matcher(folder: str, block: int) -> Matcher | None:
    """The matcher of a block, kept by a worker process until it needs another one; None where no pattern fell into it."""
    system, base = pa.fs.FileSystem.from_uri(folder)
    place = f"{base}/block={block}"
    if system.get_file_info(place).type == pa.fs.FileType.NotFound:
        return None
    return Matcher(pa.dataset.dataset(place, filesystem=system, format="parquet").to_table(["pattern", "items"]))


RESULTS = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("found_items", T.ArrayType(T.StringType()))]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 32 << 20,
                   keep: list[str] | None = None) -> DataFrame:
    """Benchmark items in documents.

    ``docs`` needs ``text``; ``benchmark`` needs ``item_id`` and ``text``. Returns the columns of ``docs`` (or those of
    ``keep``) with ``n_words``, ``n_hit`` (words inside any occurrence) and ``found_items`` (ids as text, sorted, each
    once); input columns of these names are replaced. Null and empty texts have no words and no hits. Items without
    words are never found, a null id counts as "", equal ids as one item. Equal rows get equal results. An empty
    benchmark hits nothing. A document's place is never compared across rows: no occurrence spans two documents.
    """
    names = [n for n, _ in RESULTS]
    docs = without(docs, names)
    keep = [c for c in (keep or docs.columns) if c.lower() not in names]
    out = docs.select(*dict.fromkeys(f"`{c}`" for c in [*keep, "text"]))
    folder, blocks = write_patterns(benchmark, width, block_bytes)
    schema = T.StructType([*(out.schema[c] for c in keep), *(T.StructField(n, t) for n, t in RESULTS)])
    gathered_bytes = SLICE_BYTES if blocks <= 1 else GATHERED_BYTES

    def found(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanned = [find_words(part.column("text"), ALPHANUMERIC, fold=True) for part in parts]
        hits = [np.zeros(len(words.doc), bool) for words in scanned]
        items: list[dict[int, set[str]]] = [defaultdict(set) for _ in parts]
        for block in range(blocks):
            matcher = load_matcher(folder, block)
            for k, words in enumerate(scanned if matcher else ()):
                hit, new = matcher.mark(words)
                hits[k] |= hit
                for i, names in new.items():
                    items[k][i] |= names
        for part, words, hit, own in zip(parts, scanned, hits, items):
            n_hit = grouped_sums(hit.astype(np.int64), words.first)
            lists = pa.array([sorted(own[i]) if i in own else [] for i in range(part.num_rows)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(words.count), pa.array(n_hit), lists], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for part in slices(batch):
                parts.append(part)
                size += part.column("text").nbytes
                if size >= gathered_bytes:
                    yield from found(parts)
                    parts, size = [], 0
        if parts:
            yield from found(parts)

    return out.mapInArrow(run, schema)
