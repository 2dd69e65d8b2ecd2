"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors: one for each of its words, one for each character n-gram of them (counted in
UTF-8 bytes, with a mark at both ends of a word), all found by hash, and one that tells how often the word stood in the
document before. A softmax layer turns the mean into class probabilities. Vectors and layer are trained together by
stochastic gradient descent in numpy, on a bounded number of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from agentlake.llm.labelled import fit_in_task, logistic, score_rows, training_rows
from agentlake.llm.words import Words, find_words, grouped_sums


@dataclass(frozen=True)
class Settings:
    dimension: int = 8
    word_bits: int = 17
    gram_bits: int = 18
    gram_sizes: tuple[int, ...] = (3, 4, 5)
    repeat_steps: int = 8
    epochs: int = 4
    rate: float = 1.0
    seed: int = 1

    @property
    def rows(self) -> int:
        return (1 << self.word_bits) + (1 << self.gram_bits) + self.repeat_steps


def _features(words: Words, s: Settings):
    """Pairs of (row of each feature, number of features before each text), one pair for each kind of feature."""
    hashes = words.hashes()
    yield (hashes >> np.uint64(64 - s.word_bits)).astype(np.int64), words.first
    # how often a word stood in its text before, as a power of two
    place = (words.doc.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24))
    order = np.argsort(place, kind="stable")
    run = np.flatnonzero(np.diff(place[order], prepend=place[:1] + np.uint64(1)) != 0)
    seen = np.empty(len(place), np.int64)
    seen[order] = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
    step = np.minimum(np.log2(seen + 1).astype(np.int64), s.repeat_steps - 1)
    yield (1 << s.word_bits) + (1 << s.gram_bits) + step, words.first
    text = np.concatenate([np.array([0x20], np.uint8), words.buffer])
    inside = np.zeros(len(text) + 1, bool)
    inside[1:-1] = _inside(words)
    outside = np.concatenate([[0], np.cumsum(~inside[:-1])])
    text[~inside[:-1]] = 0x20
    begins = (text & 0xC0) != 0x80
    value = np.zeros(len(text), np.uint32)
    for size in range(1, max(s.gram_sizes) + 1):
        n = len(text) - size + 1
        if n <= 0:
            return
        value = value[:n] * np.uint32(0x01000193) + text[size - 1 :]
        if size in s.gram_sizes:
            at = np.flatnonzero(begins[:n] & (outside[size - 1 : size - 1 + n] == outside[1 : n + 1]) & inside[1 : n + 1])
            some = value[at] + np.uint32(size)
            some = (some ^ (some >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            some ^= some >> np.uint32(13)
            # byte ``at`` of the shifted text precedes byte ``at`` of the buffer, which is inside of a word
            yield (1 << s.word_bits) + (some >> np.uint32(32 - s.gram_bits)).astype(np.int64), np.searchsorted(at, words.offsets)


def _inside(words: Words) -> np.ndarray:
    edges = np.zeros(len(words.buffer) + 1, np.int8)
    edges[words.start] += 1
    edges[words.end] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8).astype(bool)


@dataclass
class QualityModel:
    """Only what scoring needs: the part of each vector that moves the second class's score, and the bias."""

    settings: Settings
    pull: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        words = find_words(texts)
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for rows, first in _features(words, self.settings):
            total += grouped_sums(self.pull[rows].astype(np.float64), first)
            count += np.diff(first)
        return logistic(total / np.maximum(count, 1) + self.bias)


def fit(texts: list[str], labels: np.ndarray, settings: Settings = Settings()) -> QualityModel:
    """Train on whole texts; without any, the model answers one half for every text."""
    s, random = settings, np.random.default_rng(settings.seed)
    vectors = (random.random((s.rows, s.dimension), np.float32) - np.float32(0.5)) * np.float32(2 / s.dimension)
    layer, bias = np.zeros((2, s.dimension), np.float32), np.zeros(2, np.float32)
    if len(texts):
        bias[1] = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    documents = []
    for text in texts:
        parts = [rows for rows, _ in _features(find_words(pa.array([text], pa.large_string())), s)]
        rows, counts = np.unique(np.concatenate(parts), return_counts=True)
        documents.append((rows.astype(np.int32), (counts / max(counts.sum(), 1)).astype(np.float32)))
    steps, done = s.epochs * len(texts), 0
    for _ in range(s.epochs):
        for k in random.permutation(len(texts)):
            rate = s.rate * (1 - done / steps)
            done += 1
            rows, share = documents[k]
            mean = share @ vectors[rows]
            out = layer @ mean + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[labels[k]] -= 1
            change = layer.T @ error
            layer -= rate * np.outer(error, mean)
            bias -= 0.1 * rate * error
            # the step for a vector in the direction of its share, scaled so that a document moves its mean by rate
            vectors[rows] -= np.outer(share * (rate / max(float(share @ share), 1e-12)) * 0.05, change)
    return QualityModel(s, (vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def train_quality(docs: DataFrame, labels: DataFrame, held, max_rows: int = 3000, settings: Settings = Settings()) -> QualityModel:
    """Fit on at most ``max_rows`` labelled rows (``labels``: doc_id, quality) for which ``held(doc_id)`` is false."""
    return fit_in_task(training_rows(docs, labels, "quality", held, max_rows), lambda texts, y: fit(texts, y, settings))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` with ``score``, the probability of good quality, and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored, and nothing but the text: equal texts have equal scores. Null and empty texts have no
    features and get the score of the bias. Input columns called like results are replaced.
    """
    return score_rows(docs, model, threshold, keep)
