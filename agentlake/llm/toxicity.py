"""Toxicity classifier with a counterfactual penalty.

A logistic model over how often words and word beginnings stand in a document (the logarithm of one more than the
count). They are features where enough training rows hold them; the rest says nothing about toxicity. Labelled documents whose sentences name a group (identity terms, given as
lists of terms that can stand for one another) have counterfactual copies, in which those terms are swapped for others of
their list. Most sentences name none, so sentences of labelled rows also get a copy with a mention put in, of every
term in turn. Beside the log loss, training penalises the squared difference between the scores of a text and its
copies, so that naming a group does not move the score, although groups may be named more often in toxic rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from agentlake.llm.labelled import fit_in_task, logistic, score_rows, training_rows
from agentlake.llm.words import ALPHANUMERIC, Words, find_words, mix

#: Terms for groups of people that can stand for one another in a sentence.
IDENTITY_TERMS: dict[str, tuple[str, ...]] = {
    "religion": ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "catholic", "protestant", "atheist"),
    "religions": ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "catholics", "protestants", "atheists"),
    "origin": ("african", "american", "asian", "european", "arab", "mexican", "chinese", "indian", "latino", "black", "white"),
    "origins": ("africans", "americans", "asians", "europeans", "arabs", "mexicans", "indians", "latinos", "blacks", "whites"),
    "gender": ("female", "male", "transgender", "nonbinary"),
    "person": ("woman", "man"),
    "people": ("women", "men"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "homosexual", "heterosexual", "queer"),
    "ability": ("blind", "deaf", "disabled", "paralyzed"),
    "age": ("old", "young", "elderly", "teenage"),
}

#: Mentions that are put into sentences, by language.
MENTIONS: dict[str, tuple[str, ...]] = {
    "en": tuple(dict.fromkeys(term for terms in IDENTITY_TERMS.values() for term in terms)) + ("immigrants", "refugees"),
    "fr": ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées", "africains", "arabes", "asiatiques", "noirs", "blancs", "femmes",
           "hommes", "homosexuels", "lesbiennes", "aveugles", "sourds", "handicapés", "immigrés", "réfugiés"),
    "de": ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten", "afrikaner", "araber", "asiaten", "schwarze", "weiße", "frauen",
           "männer", "homosexuelle", "lesben", "blinde", "gehörlose", "behinderte", "einwanderer", "flüchtlinge"),
    "es": ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos", "africanos", "árabes", "asiáticos", "negros", "blancos", "mujeres",
           "hombres", "homosexuales", "lesbianas", "ciegos", "sordos", "discapacitados", "inmigrantes", "refugiados"),
}

_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[0x41:0x5B] += 0x20

_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]?")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def swap_terms(text: str, lists: Mapping[str, Sequence[str]], turn: int) -> str | None:
    """The text with every identity term exchanged, in each sentence that holds one, for the ``turn``-th term after it in
    its list; None where no sentence holds one."""
    next_term = {}
    for terms in lists.values():
        for i, term in enumerate(terms):
            if len(terms) > 1:
                next_term[term] = terms[(i + 1 + turn % (len(terms) - 1)) % len(terms)]
    changed, out = False, []
    for sentence in _SENTENCE.findall(text):
        if not any(w.lower() in next_term for w in _WORD.findall(sentence)):
            out.append(sentence)
            continue
        changed = True
        out.append(_WORD.sub(lambda m: next_term.get(m[0].lower(), m[0]), sentence))
    return "".join(out) if changed else None


def insert_mention(text: str, term: str, turn: int) -> tuple[str, str] | None:
    """A sentence of the text, the ``turn``-th after the first in a circle, and the same with ``term`` between two of its
    words; None for texts without words."""
    sentences = [s for s in _SENTENCE.findall(text[:SENTENCE_SPAN]) if _WORD.search(s)]
    if not sentences:
        return None
    sentence = sentences[turn % len(sentences)]
    ends = [m.end() for m in _WORD.finditer(sentence)]
    place = ends[turn % len(ends)]
    return sentence, f"{sentence[:place]} {term}{sentence[place:]}"


#: Characters at a row's beginning from which sentences for mentions are taken; scores are of whole texts.
SENTENCE_SPAN = 4000
#: Word beginnings of so many bytes are features beside whole words.
PREFIXES = (4, 5, 6, 7, 8)


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every whole word and of every word's beginnings that are shorter than it."""
    hashes, docs = [words.hashes()], [words.doc]
    lengths = words.end - words.start
    form = _FOLD[words.buffer]
    value = np.full(len(words.start), 0xCBF29CE484222325, np.uint64)
    with np.errstate(over="ignore"):
        for size in range(1, max(PREFIXES) + 1):
            longer = lengths > size
            value = value * np.uint64(0x9E3779B97F4A7C15) + form[np.minimum(words.start + size - 1, len(form) - 1)] + np.uint64(1) if len(form) else value
            if size in PREFIXES:
                hashes.append(mix(value[longer]))
                docs.append(words.doc[longer])
    return np.concatenate(hashes), np.concatenate(docs)


def _counted(row: np.ndarray, column: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values: the logarithm of one more than the count, zero where nothing is counted."""
    pairs, counts = np.unique(row * max(columns, 1) + column, return_counts=True)
    return pairs // max(columns, 1), pairs % max(columns, 1), np.log1p(counts)


def _table(texts: Sequence[str], together: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, text and count of every feature of every text, a few texts at a time."""
    parts = []
    for low in range(0, len(texts), together):
        hashes, docs = _features(find_words(pa.array(texts[low : low + together], pa.large_string()), ALPHANUMERIC, fold=True))
        order = np.lexsort((hashes, docs))
        hashes, docs = hashes[order], docs[order]
        first = np.flatnonzero((np.diff(hashes, prepend=hashes[:1] + np.uint64(1)) != 0) | (np.diff(docs, prepend=-1) != 0))
        parts.append((hashes[first], (docs[first] + low).astype(np.int32), np.diff(np.append(first, len(hashes))).astype(np.int32)))
    return tuple(np.concatenate(x) for x in zip(*parts))


@dataclass
class ToxicityModel:
    words: np.ndarray  # hashes of features, sorted
    weights: np.ndarray
    bias: float
    swapped: int = 0  # counterfactual pairs that training used
    inserted: int = 0

    def __post_init__(self) -> None:
        self.near = np.zeros(1 << 20, bool)
        self.near[(self.words >> np.uint64(44)).astype(np.int64)] = True

    def scores(self, texts: pa.Array) -> np.ndarray:
        moves = np.zeros(len(texts))
        if len(self.words):
            hashes, docs = _features(find_words(texts, ALPHANUMERIC, fold=True))
            some = np.flatnonzero(self.near[(hashes >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.words, hashes[some]), len(self.words) - 1)
            hit = self.words[at] == hashes[some]
            row, column, value = _counted(docs[some[hit]], at[hit], len(self.words))
            moves = np.bincount(row, weights=self.weights[column] * value, minlength=len(texts))
        return logistic(moves + self.bias)


@dataclass(frozen=True)
class Settings:
    least_rows: int = 5  # that hold a word or beginning before it becomes a feature
    penalty: float = 1.0  # of counterfactual differences
    shrink: float = 1e-3  # weights move towards zero by this much a step, and stay there unless data pull them away
    copies: int = 2  # swapped copies of a row that names a group
    mentions: int = 1  # sentences of a row into which a mention is put
    steps: int = 300
    rate: float = 0.5


def counterfactuals(texts: Sequence[str], lists: Mapping[str, Sequence[str]], mentions: Mapping[str, Sequence[str]], settings: Settings) -> tuple[list[tuple[int, str]], list[tuple[str, str]]]:
    """(row, copy with other terms) for rows that name a group, and (sentence, the same with a mention) for all rows, each
    term in turn."""
    terms = list(dict.fromkeys(term for own in mentions.values() for term in own))
    swaps, inserts = [], []
    for i, text in enumerate(texts):
        for turn in range(settings.copies):
            if (swapped := swap_terms(text, lists, turn)) is not None:
                swaps.append((i, swapped))
        for turn in range(settings.mentions if terms else 0):
            if (pair := insert_mention(text, terms[(i * settings.mentions + turn) % len(terms)], turn + i)) is not None:
                inserts.append(pair)
    return swaps, inserts


def fit(texts: Sequence[str], labels: np.ndarray, lists: Mapping[str, Sequence[str]] = IDENTITY_TERMS, settings: Settings = Settings(),
        mentions: Mapping[str, Sequence[str]] = MENTIONS) -> ToxicityModel:
    """Train on whole texts; without any, or with one label only, the model gives every text the share of toxic rows."""
    s = settings
    base = float(np.log((np.sum(labels) + 0.5) / (len(labels) - np.sum(labels) + 0.5)))
    if len(set(np.asarray(labels).tolist())) < 2:
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), base)
    swaps, inserts = counterfactuals(texts, lists, mentions, s)
    copies = [copy for _, copy in swaps] + [copy for _, copy in inserts] + [sentence for sentence, _ in inserts]
    n = len(texts)
    names, row, counts = _table([*texts, *copies])
    known, rows = np.unique(names[row < n], return_counts=True)
    known = known[rows >= s.least_rows]
    if not len(known):
        return ToxicityModel(known, np.empty(0), base)
    at = np.minimum(np.searchsorted(known, names), len(known) - 1)
    hit = known[at] == names
    row, column, value = row[hit], at[hit], np.log1p(counts[hit])
    y = np.asarray(labels, np.float64)
    # rows of copies and of what they are copies of; a mention weighs as if all sentences had it
    left = n + np.arange(len(swaps) + len(inserts))
    right = np.concatenate([np.array([i for i, _ in swaps], np.int64), n + len(swaps) + len(inserts) + np.arange(len(inserts))])
    terms = max(1, len({term for own in mentions.values() for term in own}))
    weight = np.concatenate([np.full(len(swaps), 1 / max(1, len(swaps))), np.full(len(inserts), min(terms, len(inserts)) / max(1, len(inserts)))])
    balance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    weights, bias = np.zeros(len(known)), 0.0
    speed, bias_speed = np.full(len(known), 1e-8), 1e-8
    for _ in range(s.steps):  # proximal gradient steps, with a rate of each weight's own
        moves = np.bincount(row, weights=weights[column] * value, minlength=n + len(copies)) + bias
        pull = np.zeros(n + len(copies))
        pull[:n] = balance * (logistic(moves[:n]) - y)
        if len(left) and s.penalty:
            apart = 2 * s.penalty * weight * (moves[left] - moves[right])
            pull += np.bincount(left, weights=apart, minlength=len(pull)) - np.bincount(right, weights=apart, minlength=len(pull))
        gradient = np.bincount(column, weights=pull[row] * value, minlength=len(known))
        speed += gradient**2
        step = s.rate / np.sqrt(speed)
        weights -= step * gradient
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * s.shrink, 0)
        slope = float(pull[:n].sum())
        bias_speed += slope**2
        bias -= s.rate / np.sqrt(bias_speed) * slope
    used = weights != 0
    return ToxicityModel(known[used], weights[used], bias, len(swaps), len(inserts))


def train_toxicity(docs: DataFrame, labels: DataFrame, held, max_rows: int = 4000, lists: Mapping[str, Sequence[str]] = IDENTITY_TERMS, settings: Settings = Settings(),
                   mentions: Mapping[str, Sequence[str]] = MENTIONS) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled rows (``labels``: doc_id, toxic) for which ``held(doc_id)`` is false. The model
    tells how many counterfactual pairs it was fitted with (``swapped``, ``inserted``)."""
    return fit_in_task(training_rows(docs, labels, "toxic", held, max_rows), lambda texts, y: fit(texts, y, lists, settings, mentions))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` with ``score``, the probability of a toxic text, and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored, and nothing but the text: equal texts have equal scores. Null and empty texts have no words
    and get the score of the bias. Input columns called like results are replaced.
    """
    return score_rows(docs, model, threshold, keep)
