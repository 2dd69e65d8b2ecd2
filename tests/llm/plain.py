"""Plain Python versions of the operators, and tables for edge cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"src{k % 3}" if k % 7 else None, len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS)


def random_texts(n, seed=0, words=60, vocabulary=400):
    """Texts that repeat one another's passages, some of them nearly whole."""
    r = random.Random(seed)
    names = [f"w{k}" if k % 5 else f"Wé{k}," for k in range(vocabulary)]
    made = []
    for _ in range(n):
        new = [r.choice(names) for _ in range(r.randint(0, words))]
        if made and r.random() < 0.5:
            old = r.choice(made)
            if r.random() < 0.5:
                new = [w if r.random() < 0.98 else r.choice(names) for w in old]
            else:
                a = r.randint(0, len(old))
                new[len(new) // 2 : len(new) // 2] = old[a : a + r.randint(0, 45)]
        made.append(new)
    return [r.choice([" ", " ", "\n", "  "]).join(w) for w in made]


EDGE_TEXTS = [None, "", " \t\n\r", "one", "One two\x0bthree", "a b c d e", "x" * 5000, "é́ \U0001f600 \x00z  q", "same words here again " * 30, "long " * 30_000]


def parity_words(size):
    """Two words whose letters follow the parity of the bits of their places: polynomials modulo 2**64 take them for one
    from 1,024 letters on."""
    word = "".join("ab"[k.bit_count() % 2] for k in range(size))
    return [word, word.translate(str.maketrans("ab", "ba"))]


def plain_components(texts, percent=80, width=5):
    sets, lists = {}, defaultdict(list)
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(FOLD))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
        for s in sets[i]:
            lists[s].append(i)
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in sets.items():
        shared = defaultdict(int)
        for s in own:
            for j in lists[s]:
                shared[j] += j > i
        for j, n in shared.items():
            if n and 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: (len(sets[i]), top(i)) for i in sets}


def plain_found(texts, items, width=10):
    patterns = defaultdict(set)
    for item, t in items:
        w = ALPHANUMERIC.findall((t or "").translate(FOLD))
        for k in range(max(1, len(w) - width + 1)) if w else ():
            patterns[tuple(w[k : k + width])].add(str(item if item is not None else ""))
    found = []
    for t in texts:
        w, hit, names = ALPHANUMERIC.findall((t or "").translate(FOLD)), set(), set()
        for size in {len(p) for p in patterns}:
            for k in range(len(w) - size + 1):
                if (p := tuple(w[k : k + size])) in patterns:
                    names |= patterns[p]
                    hit.update(range(k, k + size))
        found.append((len(w), len(hit), sorted(names)))
    return found


def plain_repeats(rows, width=20):
    """Of (doc_id, text) rows in order: number of words, number removed, checksum of what is left."""
    seen, out = set(), []
    for _, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - width + 1):
            window = tuple(w[k : k + width])
            if window in seen:
                gone.update(range(k, k + width))
            seen.add(window)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
