"""Removal of word sequences that occur earlier in the corpus, by fixed-block anchors.

Every document is cut into blocks of ``width // 2`` words that do not overlap; they are the index. Wherever a sequence of
``width`` words is repeated, its earlier place holds one of these blocks whole, so some window of ``width // 2`` words at
the later place equals an indexed block. All rolling windows are therefore probed against the index; hits (anchors) are
extended to the windows of ``width`` words around them, and of equal windows all but the first are marked. The union of
marked windows is the set of maximal exact repeats.

Two exchanges of compact messages (see ``gram_exchange``) do this: one for blocks and probes, one for the windows around
anchors. Windows are compared by 64-bit fingerprints of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from agentlake.llm import gram_exchange as X
from agentlake.llm.words import Words, find_words, slices

RESULTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
DIGESTS = T.StructType([*RESULTS.fields[:3], T.StructField("kept_sha256", T.StringType())])
_IS_BLOCK, _REPEATED = 1, 2


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), ("text_hash", "ascending"), ("text", "ascending")])


def _windows(table: pa.Table, width: int) -> list[tuple[Words, np.ndarray, np.ndarray]]:
    """(words, first words, hashes) of the windows in each slice of a group."""
    found = []
    for part in slices(table):
        words = find_words(part.column("text"))
        found.append((words, *words.windows(words.fingerprints(), width)))
    return found


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable")
    return values[order], order


def _send_anchors(layout: X.Layout, half: int) -> Callable:
    shift = np.uint64(64 - layout.bits)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        values, blocks = [], []
        for words, at, hashes in _windows(table, half):
            values.append(hashes >> shift)
            blocks.append((at - words.first[words.doc[at]]) % half == 0)
        values, blocks = np.concatenate(values), np.concatenate(blocks)
        values, order = _distinct(values)
        blocks = blocks[order]
        first = np.flatnonzero(np.diff(values, prepend=values[:1] + np.uint64(1)) != 0)
        codes = np.zeros(len(first), np.uint8)
        if len(first):
            codes[np.add.reduceat(blocks.astype(np.int64), first) > 0] |= _IS_BLOCK
            codes[np.diff(np.append(first, len(values))) > 1] |= _REPEATED
        return X.messages(key[0].as_py(), values[first], codes, layout.buckets, layout.bits)

    return run


def _anchors(run: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexed blocks that some other window equals."""
    indexed = X.run_sums(run, (codes & _IS_BLOCK) > 0) > 0
    often = X.run_sums(run, np.where(codes & _REPEATED, 2, 1)) > 1
    return indexed & often, codes


def _send_windows(layout: X.Layout, half: int, width: int) -> Callable:
    shift = np.uint64(64 - layout.bits)

    def run(key: tuple, docs: pa.Table, back: pa.Table) -> pa.Table:
        anchors, _ = X.merged(back["payload"].to_pylist())
        chosen = [np.empty(0, np.uint64)]
        for part in slices(docs):
            words = find_words(part.column("text"))
            hashes = words.fingerprints()
            at, probes = words.windows(hashes, half)
            hit = np.zeros(len(hashes) + 1, np.int64)
            hit[at[X.find(anchors, probes >> shift) >= 0] + 1] = 1
            before = np.cumsum(hit)
            at, whole = words.windows(hashes, width)
            chosen.append(whole[before[at + width - half + 1] > before[at]])
        values = np.unique(np.concatenate(chosen))
        return X.messages(key[0].as_py(), values, np.zeros(len(values), np.uint8), layout.buckets, 64)

    return run


def _later(run: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All but the first group of each value."""
    return np.diff(run, prepend=-1) == 0, codes


def _remove(width: int, digest: bool) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256" if digest else "kept_text", pa.string())])

    def run(key: tuple, docs: pa.Table, back: pa.Table) -> pa.Table:
        docs = _ordered(docs)
        later, _ = X.merged(back["payload"].to_pylist())
        found = _windows(docs, width)
        values = np.concatenate([np.empty(0, np.uint64), *(h for _, _, h in found)])
        ordered, order = _distinct(values)
        again = np.zeros(len(values), bool)
        again[order] = np.diff(ordered, prepend=ordered[:1] + np.uint64(1)) == 0  # stable: the first of equal ones is the earliest
        again |= X.find(later, values) >= 0
        counts, removed, texts, at = [], [], [], 0
        for words, starts, hashes in found:
            marked = starts[again[at : at + len(hashes)]]
            at += len(hashes)
            edges = np.zeros(len(words.doc) + width + 1, np.int64)
            edges[marked] += 1
            edges[marked + width] -= 1
            kept = np.cumsum(edges)[: len(words.doc)] == 0
            counts.append(words.count)
            gone = np.concatenate([[0], np.cumsum(~kept)])[words.first]
            removed.append(np.diff(gone))
            texts += _kept_texts(words, kept)
        made = [hashlib.sha256(t).hexdigest() for t in texts] if digest else [t.decode() for t in texts]
        whole = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (counts, removed)]
        return pa.table([docs["doc_id"], pa.array(whole[0], pa.int64()), pa.array(whole[1], pa.int64()), pa.array(made, pa.string())], schema=schema)

    return run


def _kept_texts(words: Words, kept: np.ndarray) -> list[bytes]:
    """Kept words of each text, joined by one space."""
    start, end = words.start[kept], words.end[kept]
    edges = np.zeros(len(words.buffer) + 2, np.int8)
    edges[start] += 1
    edges[end + 1] -= 1  # with the separator behind; words never touch
    form = words.buffer.copy()
    form[end] = 0x20
    data = form[np.cumsum(edges, dtype=np.int8)[: len(form)].astype(bool)].tobytes()
    sizes = np.concatenate([[0], np.cumsum(end - start + 1)])
    number = np.concatenate([[0], np.cumsum(kept)])[words.first]
    places = sizes[number].tolist()
    return [data[a : max(a, b - 1)] for a, b in zip(places[:-1], places[1:])]


def remove_repeats(docs: DataFrame, width: int = 20, digest: bool = False, layout: X.Layout | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (or its SHA-256, ``kept_sha256``) of every row of ``docs``.

    Words are runs of anything but ASCII white space, unchanged. A word is removed where a window of ``width``
    consecutive words of its document covers it that also starts earlier: in a document with a smaller doc_id, or
    earlier in the same one. Windows are judged on the input. Documents of fewer words lose nothing; null and empty
    texts have no words and an empty kept text. Rows of equal doc_id (or null, which comes last) stand in the order of
    their texts' xxHash64 and then of the texts, so of repeated rows one stays, and rows of one id can be spread. Other columns are not read.
    """
    if width % 2:
        raise ValueError("width must be even: blocks take half of it")
    half = width // 2
    layout = layout or X.plan_layout(docs)
    groups = X.in_groups(docs, layout)
    anchors = X.answers(groups.groupBy("grp").applyInArrow(_send_anchors(layout, half), X.MESSAGE), _anchors)
    windows = groups.groupBy("grp").cogroup(anchors.groupBy("grp")).applyInArrow(_send_windows(layout, half, width), X.MESSAGE)
    later = X.answers(windows, _later)
    return groups.groupBy("grp").cogroup(later.groupBy("grp")).applyInArrow(_remove(width, digest), DIGESTS if digest else RESULTS)
