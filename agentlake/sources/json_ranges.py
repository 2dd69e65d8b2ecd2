"""Elements of large JSON array files, by byte ranges in many tasks.

Where an array's elements begin cannot be told from the middle of a file: a bracket or comma may stand inside a string,
and at any depth. So a file is read twice. In the first reading each range is summed up for every state in which it
may begin (outside of strings, inside, after a backslash): in which state it ends, how deep the brackets lead, and how
many commas there are at each depth. Such sums can be chained, so one small group per file tells each range's true
state, depth and number of elements before it. In the second reading each range gives the elements that begin in it,
reading on where the last one goes further.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a range; files up to this size are better read as a whole.
RANGE_BYTES = 64 << 20
#: Bytes that are scanned at once.
CHUNK_BYTES = 4 << 20
#: Bytes of elements that leave a task at once.
BATCH_BYTES = 4 << 20
#: Ranges whose sums leave a task at once.
BATCH_RANGES = 256

#: States are sums of these; 0 is outside of strings.
INSIDE, ESCAPED = 1, 2
STATES = range(4)
_BACKSLASH, _QUOTE, _COMMA = 0x5C, 0x22, 0x2C
_STEP = np.zeros(256, np.int8)
_STEP[[0x5B, 0x7B]], _STEP[[0x5D, 0x7D]] = 1, -1
_STRUCTURAL = _STEP != 0
_STRUCTURAL[_COMMA] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True


def scan(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Places of brackets and commas outside of strings, of bytes that begin in ``state``, and the state behind them."""
    if not len(data):
        return np.empty(0, np.int64), state
    slashes = np.flatnonzero(data == _BACKSLASH)
    quotes = data == _QUOTE
    pending = 0
    if state & ESCAPED:
        quotes[0] = False
        slashes = slashes[slashes > 0]
    if len(slashes):
        first = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        length = np.diff([*first, len(slashes)])
        behind = (slashes[first] + length)[length % 2 == 1]  # what an odd run of backslashes escapes
        pending = int(len(behind) and behind[-1] == len(data))
        quotes[behind[: len(behind) - pending]] = False
    inside = np.logical_xor.accumulate(quotes) ^ bool(state & INSIDE)
    at = np.flatnonzero(_STRUCTURAL[data])
    return at[~inside[at]], INSIDE * bool(inside[-1]) + ESCAPED * pending


@dataclass
class Path:
    """What happens to a range that begins in one state."""

    end: int
    depth: int = 0
    opened: int = 0
    commas: Counter = None  # by depth, counted from the range's beginning


def summarise(data: np.ndarray) -> list[Path]:
    """One path for each state."""
    paths = []
    for state in STATES:
        if state & ESCAPED and len(data) and data[0] not in (_BACKSLASH, _QUOTE):
            paths.append(paths[state - ESCAPED])  # nothing there that an escape would change
            continue
        at, end = scan(data, state)
        step = _STEP[data[at]].astype(np.int64)
        depth = np.cumsum(step)
        values, counts = np.unique(depth[step == 0], return_counts=True)
        paths.append(Path(end, int(step.sum()), int((step > 0).sum()), Counter(dict(zip(values.tolist(), counts.tolist())))))
    return paths


def chain(first: list[Path], second: list[Path]) -> list[Path]:
    """The paths of two neighbouring ranges as one."""
    out = []
    for a in first:
        b = second[a.end]
        commas = a.commas + Counter({depth + a.depth: n for depth, n in b.commas.items()})
        out.append(Path(b.end, a.depth + b.depth, a.opened + b.opened, commas))
    return out


def elements(read, low: int, high: int, state: int, depth: int, position: int, opened: bool) -> Iterator[tuple[int, bytes]]:
    """(position, text) of the elements that begin between two places, given what the first reading knows of ``low``.

    ``read(place, size)`` returns bytes of the file, fewer or none at its end.
    """
    border, parts, at = None, [], low  # border: the position of the element that is being read
    while at < high or border is not None:
        raw = read(at, min(CHUNK_BYTES, high - at) if at < high else CHUNK_BYTES)
        if not raw:
            raise ValueError("the array does not end")
        data = np.frombuffer(raw, np.uint8)
        places, state = scan(data, state)
        step = _STEP[data[places]].astype(np.int64)
        after = depth + np.cumsum(step)
        marks = np.flatnonzero(((step == 0) & (after == 1)) | ((step > 0) & (after == 1)) | ((step < 0) & (after == 0)) | (after < 0))
        begin = 0
        for mark in marks.tolist():
            place, kind = int(places[mark]), int(step[mark])
            if kind > 0:
                if opened or raw[place] != 0x5B:
                    raise ValueError("more than an array")
                _blank(data, begin, place)
                opened, border, parts = True, position, []
            else:
                if after[mark] < 0 or (kind < 0 and raw[place] != 0x5D):
                    raise ValueError("brackets do not match")
                if border is not None:
                    text = b"".join([*parts, raw[begin:place]]).strip(b" \t\n\r")
                    if text:
                        yield border, text
                    elif kind == 0 or border:
                        raise ValueError("an element is missing")
                if kind == 0:
                    position += 1
                    border, parts = (position, []) if at + place < high else (None, [])
                else:
                    border = None
            begin = place + 1
            if border is None and at + place >= high:
                return
        depth = int(after[-1]) if len(after) else depth
        if border is not None:
            parts.append(raw[begin:])
        elif depth == 0:
            _blank(data, begin, len(data))
        at += len(raw)


def _blank(data: np.ndarray, low: int, high: int) -> None:
    if not _SPACE[data[low:high]].all():
        raise ValueError("text outside of the array")


# --- files -----------------------------------------------------------------------------------------------------------


def open_input(path: str) -> pa.NativeFile:
    """A file of any file system that Arrow opens, by its path as Spark writes it."""
    parts = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)$", path)
    scheme, host, place = parts.groups() if parts else ("file", "", path)
    if scheme == "file":
        return pa.fs.LocalFileSystem().open_input_file(place)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    system, _ = pa.fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system.open_input_file(f"{host}{place}" if scheme in ("s3", "gs", "abfs", "abfss") else place)


def _chunks(source: pa.NativeFile, low: int, high: int) -> Iterator[np.ndarray]:
    for at in range(low, high, CHUNK_BYTES):
        raw = source.read_at(min(CHUNK_BYTES, high - at), at)
        if len(raw) < min(CHUNK_BYTES, high - at):
            raise ValueError("the file has become shorter")
        yield np.frombuffer(raw, np.uint8)


SUMS = "path string, low long, high long, state int, end int, depth long, opened long, levels array<long>, commas array<long>"
STARTS = "path string, low long, high long, state int, depth long, position long, opened boolean"


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, BATCH_RANGES) for at in range(0, batch.num_rows, BATCH_RANGES))


def _summarise_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in _sliced(whole)):
        rows = []
        for path, low, high in zip(*(batch.column(c).to_pylist() for c in ("path", "low", "high"))):
            whole = None
            with open_input(path) as source:
                for data in _chunks(source, low, high):
                    paths = summarise(data)
                    whole = paths if whole is None else chain(whole, paths)
            for state, p in enumerate(whole):
                rows.append({"path": path, "low": low, "high": high, "state": state, "end": p.end, "depth": p.depth, "opened": p.opened,
                             "levels": list(p.commas), "commas": list(p.commas.values())})
        yield pa.RecordBatch.from_pylist(rows, schema=_arrow(SUMS))


def _find_starts(key: tuple, table: pa.Table) -> pa.Table:
    """The state, depth and number of elements at the beginning of each range of a file."""
    rows, state, depth, opened, commas = [], 0, 0, 0, 0
    by_low: dict[int, list[dict]] = {}
    for row in table.to_pylist():
        by_low.setdefault(row["low"], [None] * len(STATES))[row["state"]] = row
    for low in sorted(by_low):
        own = by_low[low][state]
        rows.append({"path": own["path"], "low": low, "high": own["high"], "state": state, "depth": depth, "position": commas, "opened": opened > 0})
        commas += sum(n for level, n in zip(own["levels"], own["commas"]) if level + depth == 1)
        state, depth, opened = own["end"], depth + own["depth"], opened + own["opened"]
    if state or depth or not opened:
        raise ValueError(f"not a JSON array: file {key[0].as_py()}")
    return pa.Table.from_pylist(rows, schema=_arrow(STARTS))


def _read_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow("path string, position long, element string")
    for batch in batches:
        for row in batch.to_pylist():
            path, rows, size = row.pop("path"), [], 0
            with open_input(path) as source:
                try:
                    for position, text in elements(lambda at, n: source.read_at(n, at), **row):
                        rows.append({"path": path, "position": position, "element": text.decode()})
                        size += len(text) + len(path)
                        if size > BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                except ValueError as wrong:
                    raise ValueError(f"not a JSON array: file {path}: {wrong}") from None
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def array_file_elements(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, position, element): the text of every element of JSON array files of any size, and its place in the array.

    ``files``: path (as Spark writes it) and length. Each file is read twice, by ranges of ``range_bytes``; what is kept of
    a range between the readings is a few numbers. A file that is no single array stops the job; whether its elements are
    sound JSON is for their reader to say. A range's elements come from one task, and so does an element of any length.
    """
    spark = files.sparkSession
    lows = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = files.select("path", "length", F.explode(lows).alias("low"))
    ranges = ranges.select("path", "low", F.least(F.col("low") + range_bytes, "length").alias("high"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.repartition(tasks, "path", "low")
    starts = dealt.mapInArrow(_summarise_ranges, SUMS).groupBy("path").applyInArrow(_find_starts, STARTS)
    return starts.repartition(tasks, "path", "low").mapInArrow(_read_elements, "path string, position long, element string")
