"""Token counts of a unigram tokenizer without its tokens: a count-only Viterbi search.

An Aho-Corasick automaton over the vocabulary lists, for every place in a segment, the pieces that end there. Dynamic
programming keeps for every place only the best score and the number of pieces on the best path, so nothing is traced
back and no piece is built. Ties follow the tokenizer (``Unigram`` of the tokenizers library): among equal scores at a
place, the path whose last piece begins first stays; a character that no piece of one character covers costs the least
score of the vocabulary less ten; runs of such characters count their UTF-8 bytes with byte fallback, one without.

Texts are cut as the Metaspace pre-tokenizer cuts them: a space becomes U+2581, one is put before the text, and each
begins a segment. No piece reaches across, so segments are counted once and remembered.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from agentlake.llm.rows import map_texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Distinct segments that a worker process remembers.
REMEMBERED = 600_000


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    unknown: int
    byte_fallback: bool


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece model file, as they stand."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    return Vocabulary(tuple(model.id_to_piece(i) for i in range(n)), tuple(model.get_score(i) for i in range(n)), model.unk_id(), any(model.is_byte(i) for i in range(n)))


class CountingSearch:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        best = dict(zip(vocabulary.pieces, vocabulary.scores))  # of equal pieces the last counts, as in the tokenizer
        for piece, score in best.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown_score = min(vocabulary.scores) - UNKNOWN_PENALTY
        self.byte_fallback = vocabulary.byte_fallback
        self.known: dict[str, tuple[int, float]] = {}

    def segment(self, segment: str) -> tuple[int, float]:
        """Number of pieces and score of the best path."""
        n = len(segment)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        unknown_score, by_bytes = self.unknown_score, self.byte_fallback
        matches = self.automaton.iter(segment)
        match = next(matches, None)
        for end in range(1, n + 1):
            start, best, single = -1, 0.0, False
            while match is not None and match[0] == end - 1:
                length, value = match[1]
                at = end - length
                value += score[at]
                if start < 0 or value > best or (value == best and at < start):
                    start, best = at, value
                single = single or length == 1
                match = next(matches, None)
            if not single:
                value = unknown_score + score[end - 1]
                if start < 0 or value > best:
                    score[end], unknown[end] = value, True
                    if by_bytes:
                        count[end] = count[end - 1] + len(segment[end - 1].encode())
                    else:
                        count[end] = count[end - 1] + (0 if unknown[end - 1] else 1)
                    continue
            score[end], count[end] = best, count[start] + 1
        return count[n], score[n]

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        segments = text.replace(SPACE, " ").split(" ")
        if not segments[0] and len(segments) > 1:  # the text begins with a space, no other is put before
            del segments[0]
        known, total, whole = self.known, 0, 0.0
        if len(known) > REMEMBERED:
            known.clear()
        for s in segments:
            found = known.get(s)
            if found is None:
                found = known[s] = self.segment(SPACE + s)
            total += found[0]
            whole += found[1]
        return total, whole


@lru_cache(maxsize=2)
def counting_search(path: str) -> CountingSearch:
    return CountingSearch(load_vocabulary(path))


def count_tokens(docs: DataFrame, vocabulary_path: str, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` (or those of ``keep``) with ``n_tokens`` and ``best_score`` of the whole text.

    ``vocabulary_path`` is a sentencepiece file that every executor can open, such as one of an installed package; its
    scores are used as log probabilities. Null and empty texts have no tokens and score 0. Rows are counted one by one;
    input columns called like results are replaced. A very long segment takes time and memory in proportion.
    """

    def make():
        search = counting_search(vocabulary_path)

        def run(part: pa.RecordBatch) -> list:
            found = [search.text(t) for t in part.column("text").to_pylist()]
            return [np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.float64)]

        return run

    return map_texts(docs, [("n_tokens", T.LongType()), ("best_score", T.DoubleType())], make, keep=keep)
