"""Grouping of spelling variants: words one edit apart, and the frequent word that each of them leads to.

A word's letter counts are a point in space. One edit moves the point by at most two in L1 distance: an insertion or
deletion changes one count by one, a replacement takes one from a count and adds one to another. K-d trees over these
points are searched for every pair of equal or neighbouring lengths, leaving out boxes that no single edit can reach;
of the points found, the order of the letters decides.

Words are dealt to cells of a k-d tree whose planes are fitted on a sample; every word is stored in its cell and sent
to each other cell that an edit of it could reach, so no pair is missed wherever the planes lie.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.llm.storage import materialize

#: Words have at least so many letters, and occur at least so often.
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A form is so many times as frequent as its variant.
RATIO = 2
#: One in so many words of a document loses a letter.
DAMAGED = 97
#: Different words that a task counts before it hands the counts on.
COUNTED_WORDS = 400_000
#: Words that planes are fitted on, and the number of words that a cell should hold.
SAMPLE, CELL = 100_000, 8192
#: Points in a leaf.
LEAF = 24
#: Elements of an array of differences at once.
BLOCK = 1 << 20


# --- words -----------------------------------------------------------------------------------------------------------


def _runs(least: int) -> re.Pattern:
    return re.compile(rb"[a-z\xc0-\xff]{%d,}" % least)


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, damaged: int = DAMAGED) -> DataFrame:
    """(word, n) of all words of at least ``least_letters`` code points that occur ``least_count`` times or more.

    Words are the longest runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. Where ``damaged`` divides the
    unsigned crc32 of ``<doc_id>:<word>`` (UTF-8; a null id is empty), the word loses the code point at that number
    modulo its length. Null and empty texts have none; repeated rows count each time; other columns are not read. Tasks
    count before the shuffle and hand over what they have whenever that has grown to ``COUNTED_WORDS`` words.
    """
    pattern = _runs(least_letters)
    whole = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text"))

    def rows(counts: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, crc = Counter(), zlib.crc32
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                # one byte a letter; what lies beyond becomes a question mark, which ends a word like any other sign
                runs = pattern.findall(text.encode("latin-1", "replace").lower())
                counts.update(runs)
                start = crc(f"{doc_id}:".encode())
                hits = [w for w in set(runs) if not crc(w if w.isascii() else w.decode("latin-1").encode(), start) % damaged]
                own = Counter(runs) if len(hits) > 4 else None
                for w in hits:
                    n = own[w] if own else runs.count(w)
                    place = crc(w.decode("latin-1").encode(), start) % len(w)
                    counts[w] -= n
                    if len(w) > least_letters:
                        counts[w[:place] + w[place + 1 :]] += n
                if len(counts) > COUNTED_WORDS:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    found = whole.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least_count)


# --- letter counts and trees -----------------------------------------------------------------------------------------


class Letters:
    """The code points that some words use, each with a column."""

    def __init__(self, words: list[str]):
        used = np.unique(np.frombuffer("".join(words).encode("latin-1"), np.uint8))
        self.names = [chr(c) for c in used.tolist()]
        self.columns = np.full(256, len(used))
        self.columns[used] = np.arange(len(used))

    def counts(self, words: list[str]) -> np.ndarray:
        """One row a word: how often it has each letter, and in the last column how many others it has."""
        width = len(self.names) + 1
        data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        place = np.repeat(np.arange(0, width * len(words), width), sizes) + self.columns[data]
        return _narrow(np.bincount(place, minlength=width * len(words)).reshape(-1, width))


#: Every code point that a word may have.
ANY_LETTERS = Letters([chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))])


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Small numbers for words of usual length, which the search is quicker with."""
    return counts.astype(np.int8 if counts.max(initial=0) < 64 else np.int64)


@dataclass
class Node:
    low: np.ndarray  # the box: smallest and largest counts
    high: np.ndarray
    rows: np.ndarray | None = None  # of a leaf: its points
    cell: int = -1
    parts: tuple[Node, Node] | None = None


class LetterTree:
    """K-d tree of points. Boxes either fit the points tightly or, with ``open_boxes``, are bounded by planes alone, so
    that they also hold points that come later."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, open_boxes: bool = False):
        self.points, self.leaf, self.open, self.cells = points, leaf, open_boxes, 0
        size = points.shape[1]
        self.root = self._node(np.arange(len(points)), np.zeros(size, points.dtype), np.full(size, np.iinfo(points.dtype).max, points.dtype))

    def _node(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> Node:
        own = self.points[rows]
        if not self.open and len(rows):
            low, high = own.min(axis=0), own.max(axis=0)
        if len(rows) > self.leaf:
            cut = self._plane(own)
            if cut is not None:
                axis, value = cut
                less, most = own[:, axis] < value, high.copy()
                most[axis] = value - 1
                least = low.copy()
                least[axis] = value
                return Node(low, high, parts=(self._node(rows[less], low, most), self._node(rows[~less], least, high)))
        self.cells += 1
        return Node(low, high, rows, self.cells - 1)

    @staticmethod
    def _plane(own: np.ndarray) -> tuple[int, int] | None:
        """The axis and value that come closest to halving the points; None if all are the same."""
        best = None
        for axis in np.flatnonzero(own.max(axis=0) > own.min(axis=0)):
            column = np.sort(own[:, axis])
            for value in {int(column[len(column) // 2]), int(column[len(column) // 2]) + 1}:
                less = int(np.searchsorted(column, value))
                even = min(less, len(column) - less)
                if even and (best is None or even > best[0]):
                    best = even, int(axis), value
        return best and best[1:]

    def cells_near(self, queries: np.ndarray, more: int, fewer: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, cell) for every cell with a point, if any, that has at most ``more`` letters that the query lacks and
        lacks at most ``fewer`` that it has."""
        found = [(rows, np.full(len(rows), node.cell)) for node, rows in self._reached(queries, more, fewer)]
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2

    def near(self, queries: np.ndarray, more: int, fewer: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) for all points that have exactly ``more`` letters that the query lacks and lack exactly
        ``fewer`` that it has."""
        found = [(np.empty(0, np.int64),) * 2]
        for node, rows in self._reached(queries, more, fewer):
            points = self.points[node.rows]
            step = max(1, BLOCK // max(1, points.size))
            for k in range(0, len(rows), step):
                apart = points[None, :, :] - queries[rows[k : k + step], None, :]
                gained = np.maximum(apart, 0).sum(axis=2, dtype=np.int32)
                query, point = np.nonzero((gained == more) & (gained - apart.sum(axis=2, dtype=np.int32) == fewer))
                found.append((rows[k : k + step][query], node.rows[point]))
        return tuple(np.concatenate(c) for c in zip(*found))

    def _reached(self, queries: np.ndarray, more: int, fewer: int) -> Iterator[tuple[Node, np.ndarray]]:
        """Leaves and the queries whose edits can reach their box."""
        if queries.dtype != self.points.dtype:  # either has a long word; counts of both stay as they are
            queries, points = queries.astype(np.int64), self.points.astype(np.int64)
            self.__init__(points, self.leaf, self.open)
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, rows = stack.pop()
            own = queries[rows]
            lacking = np.maximum(node.low - own, 0).sum(axis=1, dtype=np.int32)
            over = np.maximum(own - node.high, 0).sum(axis=1, dtype=np.int32)
            rows = rows[(lacking <= more) & (over <= fewer)]
            if not len(rows):
                continue
            if node.parts:
                stack += [(part, rows) for part in node.parts]
            else:
                yield node, rows


# --- pairs -----------------------------------------------------------------------------------------------------------


def _shared(a: str, b: str) -> int:
    """Number of letters at the beginning in which two words agree, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter inserted into ``a``, or replaced in it, makes ``b``."""
    k = _shared(a, b)
    if len(a) == len(b):
        return a != b and a[k + 1 :] == b[k + 1 :]
    return len(b) == len(a) + 1 and a[k:] == b[k + 1 :]


def class_pairs(from_: list[str], to: dict[str, int], lost: str, gained: str) -> Iterator[tuple[int, str]]:
    """(number in ``from_``, word of ``to``) one edit apart, of words with the same letters each, where the edit gains one
    letter and perhaps loses one. Looked up by making the edits, so that many anagrams cost no more than their letters."""
    if len(from_) * len(to) <= 4 * (len(from_) + len(to)):
        for number, word in enumerate(from_):
            for other in to:
                if one_edit(word, other):
                    yield number, other
        return
    for number, word in enumerate(from_):
        made = set()
        if lost:
            made.update(word[:k] + gained + word[k + 1 :] for k, letter in enumerate(word) if letter == lost)
        else:
            made.update(word[:k] + gained + word[k:] for k in range(len(word) + 1))
        for other in made:
            if other in to:
                yield number, other


def by_letters(words: list[str]) -> dict[str, list[int]]:
    """Numbers of the words by their letters in order."""
    found: dict[str, list[int]] = {}
    for number, word in enumerate(words):
        found.setdefault("".join(sorted(word)), []).append(number)
    return found


def pairs_in_cell(points: list[str], same: list[str], shorter: list[str]) -> Iterator[tuple[int, int, int]]:
    """(0, i, j): ``same[i]`` and ``points[j]`` differ by one replaced letter. (1, i, j): ``points[j]`` is ``shorter[i]`` with
    one letter more. Words of the same letters are one point of the tree, and one query."""
    if not points:
        return
    classes = by_letters(points)
    letters, members = Letters(points), list(classes.values())
    counts = letters.counts(list(classes))
    tree, lookup = LetterTree(counts), [{points[j]: j for j in own} for own in members]
    names = [*letters.names, ""]
    for kind, words, fewer in ((0, same, 1), (1, shorter, 0)):
        asked = by_letters(words)
        queries = letters.counts(list(asked))
        able = np.flatnonzero(queries[:, -1] <= fewer)
        asking = list(asked.values())
        query, point = tree.near(queries[able], 1, fewer)
        query = able[query]
        change = counts[point] - queries[query]
        gained, lost = change.argmax(axis=1).tolist(), change.argmin(axis=1).tolist()
        for q, p, more, less in zip(query.tolist(), point.tolist(), gained, lost):
            own = asking[q]
            if len(own) == 1 and len(lookup[p]) == 1:
                j = members[p][0]
                if one_edit(words[own[0]], points[j]):
                    yield kind, own[0], j
                continue
            there = [words[i] for i in own]
            gone = ""
            if fewer:  # the letter that goes may be one that no point has
                gone = names[less] or next(c for c in there[0] if c not in letters.names)
            for number, other in class_pairs(there, lookup[p], gone, names[more]):
                yield kind, own[number], lookup[p][other]


# --- Spark -----------------------------------------------------------------------------------------------------------


def _planes(words: DataFrame, sample: int, cell: int) -> dict[int, LetterTree]:
    """A tree of cells for every length with many words. Fitted on about ``sample`` words, those of the smallest hashes;
    where planes lie decides how even cells are, never what is found. The trees hold at most as many nodes."""
    total = words.count()
    if total <= cell:
        return {}
    below = int(min(1.0, sample / total) * (1 << 32))
    few = [r.word for r in words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(1 << 32)) < below).collect()]
    leaf = max(8, cell * len(few) // total)
    by_length: dict[int, list[str]] = {}
    for word in few:
        by_length.setdefault(len(word), []).append(word)
    trees = {}
    for length, own in by_length.items():
        if len(own) > leaf:
            trees[length] = LetterTree(ANY_LETTERS.counts(list(by_letters(own))), leaf, open_boxes=True)
    return trees


def _dealt(words: DataFrame, trees: dict[int, LetterTree]) -> DataFrame:
    """Rows (length, cell, kind, word, n): every word in its cell (kind 0), in the other cells of its length that a
    replacement can reach (1), and in the cells of the next length that an insertion can reach (2)."""
    sent = words.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                own = [words[k] for k in rows.tolist()]
                for target, kinds in ((size, ((0, 0, 0), (1, 1, 1))), (size + 1, ((2, 1, 0),))):
                    tree = sent.value.get(target)
                    counts = ANY_LETTERS.counts(own) if tree else None
                    home = np.zeros(len(own), np.int64)
                    for kind, more, fewer in kinds:
                        if tree:
                            query, cell = tree.cells_near(counts, more, fewer)
                            if kind == 0:
                                home[query] = cell
                            elif kind == 1:
                                query, cell = query[cell != home[query]], cell[cell != home[query]]
                        else:
                            query, cell = (np.arange(len(own)) if kind != 1 else np.empty(0, np.int64)), None
                            cell = np.zeros(len(query), np.int64)
                        for k in range(0, len(query), 1 << 14):
                            some, its = query[k : k + (1 << 14)], cell[k : k + (1 << 14)]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(some), target)), pa.array(its), pa.array(np.full(len(some), kind, np.int32)),
                                 pa.array([own[i] for i in some.tolist()], pa.string()), pa.array(n[rows[some]])],
                                names=["length", "cell", "kind", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "length long, cell long, kind int, word string, n long")


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """(word, near, near_n): all pairs of words exactly one inserted, deleted or replaced letter apart, in both directions.

    ``words`` has word (not null, different, of code points up to U+00FF) and n. A task holds a cell, of about ``cell``
    words, and the words that could be one edit from some word of it.
    """

    def pairs(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        words, n = table["word"].to_pylist(), table["n"].to_numpy()
        own, around, shorter = (np.flatnonzero(kind == k) for k in range(3))
        same = np.concatenate([own, around])
        pick = lambda rows: [words[k] for k in rows.tolist()]
        left, right = [], []
        for which, i, j in pairs_in_cell(pick(own), pick(same), pick(shorter)):
            if which == 0:  # every word asks for its own, so each direction is found once
                left.append(same[i])
                right.append(own[j])
            else:
                left += [shorter[i], own[j]]
                right += [own[j], shorter[i]]
        left, right = np.array(left, np.int64), np.array(right, np.int64)
        return pa.table({"word": table["word"].take(pa.array(left)), "near": table["word"].take(pa.array(right)), "near_n": pa.array(n[right])})

    dealt = _dealt(words, _planes(words, sample, cell))
    return dealt.groupBy("length", "cell").applyInArrow(pairs, "word string, near string, near_n long")


def group_spellings(words: DataFrame, ratio: int = RATIO, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``words`` (word, n).

    n_near counts the words one edit away. The form is the most frequent of them (ties: smallest in code-point order) if
    it is at least ``ratio`` times as frequent as the word, else null, and form_n its frequency. The root is reached by
    following forms to the last; a word without form is its own. ``ratio`` is above 1, so frequencies rise along the way
    and there are no circles. No words give no rows.
    """
    words = materialize(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    around = near_words(words, sample, cell).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(around, "word", "left")
    frequent = -F.col("best.less") >= ratio * F.col("n")
    formed = materialize(joined.select(
        "word", F.when(frequent, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, -F.col("best.less")).alias("form_n")), "forms")
    # each round doubles the steps that are followed; a chain has no more than log(n) / log(ratio) of them
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            break
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
