"""Vectorised scanning of Arrow text columns: word bounds, 64-bit word and window hashes.

A column of texts is treated as one byte buffer in which every text ends with a separator, so a word never spans two
rows. Hashes depend on the bytes of a word alone; equal words have equal hashes everywhere, in every task and run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20

_U = np.uint64
_RADIX = 0x9E3779B97F4A7C15 | 1
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)


def _byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Words are runs of anything but ASCII white space.
NOT_SPACE = ~_byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of ASCII letters, digits and everything beyond ASCII.
ALPHANUMERIC = _byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any bits of the result can serve as a hash."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(33))
        x = x * _U(0xFF51AFD7ED558CCD)
        x = x ^ (x >> _U(33))
        x = x * _U(0xC4CEB9FE1A85EC53)
        return x ^ (x >> _U(33))


@lru_cache(maxsize=2)
def _byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)) | _U(1)
    if fold:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64; kept for sizes up to a few slices."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        full = max(size, SLICE_BYTES + 1024)
        known = np.ones(1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            while len(known) < full:
                known = np.concatenate([known, known * _U(pow(base, len(known), 1 << 64))])
        known = known[:full]
        if full <= 4 * SLICE_BYTES:
            _powers[base] = known
    return known


#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_fold_table = np.arange(256, dtype=np.uint8)
_fold_table[0x41:0x5B] += 0x20


def _folded(buffer: np.ndarray) -> np.ndarray:
    return _fold_table[buffer]


@dataclass
class Words:
    """Words of some texts, in order. ``start``/``end`` are byte offsets into ``buffer``; ``first[i]`` is the number of
    words before text i and ``offsets[i]`` its first byte (one more entry each at the end); ``doc`` is the text of each word."""

    buffer: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    offsets: np.ndarray
    _fold: bool

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        size = len(self.buffer)
        with np.errstate(over="ignore"):
            prefix = np.zeros(size + 1, dtype=np.uint64)
            terms = _byte_values(self._fold)[self.buffer]
            terms *= _power_table(_RADIX, size)[:size]
            np.cumsum(terms, out=prefix[1:])
            value = (prefix[self.end] - prefix[self.start]) * _power_table(_RADIX_INVERSE, size)[self.start]
        return mix(value)

    def fingerprints(self) -> np.ndarray:
        """64-bit hashes for telling words apart: two lanes, stirred after every eight bytes, so that no pattern of letters
        is known to collide; words above ``LONG_WORD`` bytes get a cryptographic hash. (``hashes`` is a polynomial, whose
        collisions can be written down; it serves models, which fold words together anyway.)"""
        form = _folded(self.buffer) if self._fold else self.buffer
        blocks = np.ndarray((len(form) + 1,), "<u8", form.tobytes() + b"\0" * 9, strides=(1,))
        length = self.end - self.start
        first = np.minimum(length, 8)
        with np.errstate(over="ignore"):
            part = blocks[self.start] & _MASKS[first]
            a = mix(part ^ (length.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
            b = mix(part + _U(0xA0761D6478BD642F))
            rows, at = np.flatnonzero((length > 8) & (length <= LONG_WORD)), 8
            while len(rows):
                left = np.minimum(length[rows] - at, 8)
                part = blocks[self.start[rows] + at] & _MASKS[left]
                a[rows] = mix(a[rows] ^ part)
                b[rows] = mix(b[rows] * _U(0xE7037ED1A0B428DB) + part)
                at += 8
                rows = rows[length[rows] > at]
            value = mix(a ^ (b << _U(23)) ^ (b >> _U(41)))
        raw = form.tobytes() if (length > LONG_WORD).any() else b""
        for k in np.flatnonzero(length > LONG_WORD).tolist():
            digest = hashlib.blake2b(raw[self.start[k] : self.end[k]], digest_size=8).digest()
            value[k] = int.from_bytes(digest, "little")
        return value

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``width`` words within one text."""
        n = len(hashes) - width + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        inside = self.doc[:n] == self.doc[width - 1 :]
        value = roll(hashes, width)
        at = np.flatnonzero(inside)
        return at, value[at]


def roll(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values."""
    n = len(hashes) - width + 1
    with np.errstate(over="ignore"):
        value = np.full(n, width, dtype=np.uint64)
        for k in range(width):
            value *= _U(0x2545F4914F6CDD1D)
            value += hashes[k : k + n]
    return mix(value)


def find_words(texts: pa.Array, word_bytes: np.ndarray = NOT_SPACE, fold: bool = False) -> Words:
    """Words of each text; null has none. ``fold`` makes A-Z equal to a-z in hashes."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    joined = pc.binary_join_element_wise(pc.fill_null(texts, b""), pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    offsets = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = joined.buffers()[2]
    if data is None or len(joined) == 0:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint8), none, none, none, np.zeros(len(joined) + 1, np.int64), np.zeros(len(joined) + 1, np.int64), fold)
    buffer = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = word_bytes[buffer]
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(joined)), np.diff(first))
    return Words(buffer, start, end, doc, first, offsets, fold)


def slices(table: pa.Table | pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut into runs of rows with at most ``limit`` bytes of text, or one row."""
    if isinstance(table, pa.Table):
        for batch in table.to_batches():
            yield from slices(batch, text, limit)
        return
    if table.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(table.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends = np.cumsum(sizes)
    at = 0
    while at < table.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield table.slice(at, to - at)
        at = to


def grouped_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
