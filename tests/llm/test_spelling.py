import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from agentlake.llm.queries import QUERIES
from agentlake.llm.spelling import Letters, LetterTree, class_pairs, count_words, group_spellings, near_words, one_edit
from tests.llm.plain import EDGE_TEXTS, FOLD, docs_of

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def plain_counts(rows, least_letters=5, least_count=3, damaged=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % damaged == 0:
                place = h % len(word)
                word = word[:place] + word[place + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if n >= least_count and len(w) >= least_letters}


def edited(a, b):
    """Whether the edit distance of two words is one, by the whole table."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i])
        for j, y in enumerate(b, 1):
            rows[i].append(min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y)))
    return rows[-1][-1] == 1


def plain_pairs(words):
    """All ordered pairs one edit apart: words that agree once a letter is taken out of, or hidden in, either."""
    keys, found = defaultdict(set), set()
    for w in words:
        for k in range(len(w)):
            keys[len(w), w[:k], w[k + 1 :]].add(w)
    for own in keys.values():
        found |= {(a, b) for a in own for b in own if a != b}
    for w in words:
        for k in range(len(w)):
            if (less := w[:k] + w[k + 1 :]) in words:
                found |= {(w, less), (less, w)}
    return found


def plain_groups(words, ratio=2):
    near = defaultdict(list)
    for a, b in plain_pairs(words):
        near[a].append(b)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def random_words(n, seed, letters="abcdeé", sizes=(5, 6, 7)):
    r = random.Random(seed)
    words = {}
    while len(words) < n:
        words["".join(r.choice(letters) for _ in range(r.choice(sizes)))] = int(r.paretovariate(0.6)) + 2
    return words


def test_one_edit():
    r = random.Random(2)
    words = ["", "a", "aa", *("".join(r.choice("abc") for _ in range(r.randint(0, 6))) for _ in range(150))]
    for a in words:
        for b in words:
            if len(b) in (len(a), len(a) + 1):
                assert one_edit(a, b) == edited(a, b), (a, b)


def test_tree_finds_what_a_scan_finds():
    letters = Letters(["abcdeé"])
    points = letters.counts(list(random_words(400, 1)))
    queries = np.vstack([points[::3], letters.counts(list(random_words(50, 2, "abcdeéx", sizes=(4, 8))))])
    apart = points[None] - queries[:, None]
    gained, lost = np.maximum(apart, 0).sum(axis=2), np.maximum(-apart, 0).sum(axis=2)
    for leaf in (1, 7, 1000):
        tree, cells = LetterTree(points, leaf), LetterTree(points[::5], leaf, open_boxes=True)
        home = dict(zip(*(x.tolist() for x in cells.cells_near(points, 0, 0))))
        assert sorted(home) == list(range(len(points)))  # every later point has one cell
        for more, fewer in ((1, 1), (1, 0)):
            exact = set(zip(*(x.tolist() for x in np.nonzero((gained == more) & (lost == fewer)))))
            found = list(zip(*(x.tolist() for x in tree.near(queries, more, fewer))))
            assert len(found) == len(set(found)) and set(found) == exact
            reached = set(zip(*(x.tolist() for x in cells.cells_near(queries, more, fewer))))
            assert all((q, home[p]) in reached for q, p in exact)


def test_anagrams_are_looked_up():
    r = random.Random(0)
    anagrams = lambda letters, n: list({"".join(r.sample(letters, len(letters))) for _ in range(n)})
    for lost, gained, a, b in (("c", "x", "aabbccdd", "aabbcxdd"), ("", "x", "aabbccdd", "aabbccddx")):
        left, right = anagrams(a, 300), anagrams(b, 300)
        right += [w[:3] + "x" + w[3 + bool(lost) :] for w in left if not lost or w[3] == lost]
        right = list(dict.fromkeys(right))
        found = list(class_pairs(left, {w: k for k, w in enumerate(right)}, lost, gained))
        assert len(found) == len(set(found)) and set(found) == {(i, w) for i, x in enumerate(left) for w in right if edited(x, w)} != set()


@pytest.mark.parametrize(("letters", "sizes", "cell"), [("abcdeé", (5, 6, 7), 40), ("abcdefghijklmnopqrstuvwxyzß×ÿ", (5, 6), 64), ("ab", (5, 6, 7, 8, 9), 30), ("abc", (5, 40), 10_000)])
def test_groups_equal_all_pairs(spark, letters, sizes, cell):
    words = random_words({"ab": 200}.get(letters, 900), 3, letters, sizes)
    for w in list(words)[:200]:
        words.setdefault(w[:2] + "z" + w[2:], 3)
        words.setdefault(w[:1] + "é" + w[2:], 2)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    pairs = [(r.word, r.near) for r in near_words(df, sample=300, cell=cell).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == plain_pairs(words)
    assert rows_of(group_spellings(df, sample=300, cell=cell)) == plain_groups(words)


def test_long_words_ties_and_chains(spark):
    long = "ab" * 20_000
    words = {long: 3, long + "c": 9, "x" + long[1:]: 3, "aaaaa": 4, "aaaab": 8, "aaaac": 8, "aaabb": 16, "aabbb": 33, "zzzzz": 5}
    got = rows_of(group_spellings(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain_groups(words)
    assert got["aaaaa"][:2] == ("aaaab", "aabbb") and got["aaaac"][0] == "aaabb" or got["aaaac"][0] is None
    assert got[long][:2] == (long + "c", long + "c") and got["zzzzz"] == (None, "zzzzz", 5, 0, None)


def test_counts(spark):
    r = random.Random(6)
    pool = ["Straße", "naïve", "naÏve", "x÷yzab", "ñandú", "WORDS", "words", "abcd", "abcde", "Łódźłódź", "日本abcdeé", "résumé"]
    texts = EDGE_TEXTS + [" ".join(r.choice(pool) + r.choice(["", "", ",", "1", "a"]) for _ in range(r.randint(0, 400))) for _ in range(120)]
    texts += ["abcdefghij " * 50_000]
    ids = [None if k % 9 == 0 else k for k in range(len(texts))]
    docs = docs_of(spark, texts, ids).repartition(5).selectExpr("*", "1 AS N", "2 AS word")
    for damaged in (97, 5):
        got = {r.word: r.n for r in count_words(docs, damaged=damaged).collect()}
        assert got == plain_counts(list(zip(ids, texts)), damaged=damaged)


def test_many_repeats_of_a_word_in_one_document(spark):
    """A document in which more than a few words lose a letter."""
    words = ["".join(chr(97 + (k // 26**j) % 26) for j in range(5)) for k in range(3000)]
    text = " ".join(words * 3)
    got = {r.word: r.n for r in count_words(docs_of(spark, [text])).collect()}
    assert got == plain_counts([(0, text)])


def test_empty_tables(spark):
    docs = docs_of(spark, ["a"]).limit(0)
    assert count_words(docs).collect() == [] and group_spellings(count_words(docs)).collect() == []


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query(spark, size):
    df = QUERIES["op11_spelling"](spark, f"/root/testdata/sf{size}")
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    docs = spark.read.parquet(f"/root/testdata/sf{size}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(df) == plain_groups(plain_counts(docs))
