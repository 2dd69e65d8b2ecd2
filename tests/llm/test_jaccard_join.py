import functools
import itertools
import random

import pytest

from agentlake.llm import gram_exchange, jaccard_join
from agentlake.llm.components import components
from agentlake.llm.jaccard_join import combination_prefix, near_duplicates
from tests.llm.plain import EDGE_TEXTS, docs_of, parity_words, plain_components, random_texts


def check(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs_of(spark, texts)).collect()}
    expected = plain_components(dict(enumerate(texts)))
    assert got == expected
    return len(expected) - len({c for _, c in expected.values()})


def test_equals_all_pairs(spark):
    assert check(spark, random_texts(250, seed=8, words=80) + EDGE_TEXTS + EDGE_TEXTS[3:6]) > 20


def test_crowded_columns_that_do_not_link(spark):
    """Documents of a few common passages share all columns, link with some and not with others."""
    r = random.Random(2)
    passages = [" ".join(f"p{k}x{j}" for j in range(12)) for k in range(8)]
    texts = [" ".join(r.sample(passages, r.randint(4, 8))) for _ in range(120)]
    base = " ".join(f"b{k}" for k in range(150)).split()
    for _ in range(80):  # copies at about the threshold
        copy = list(base)
        for _ in range(r.randint(0, 5)):
            copy[r.randrange(150)] = f"n{r.random()}"
        texts.append(" ".join(copy))
    assert check(spark, texts) > 40


def test_many_groups_and_buckets(spark, monkeypatch):
    texts = random_texts(250, seed=12, words=80) + EDGE_TEXTS
    small = functools.partial(gram_exchange.plan_layout, group_bytes=1500, bucket_bytes=2000)
    layout = small(docs_of(spark, texts))
    assert layout.groups > 30 and layout.buckets > 30
    monkeypatch.setattr(gram_exchange, "plan_layout", small)
    assert check(spark, texts) > 20


def passages(n, seed, wordings=4, number=20, size=12):
    r = random.Random(seed)
    wording = [[" ".join(f"p{k}v{v}x{j}" for j in range(size)) for v in range(wordings)] for k in range(number)]
    return [[wording[k][r.randrange(wordings)] for k in range(number)] for _ in range(n)]


@pytest.mark.parametrize(("number", "size", "wordings"), [(20, 12, 3), (3, 40, 3), (40, 5, 2)])
def test_crowded_columns_meet_by_combinations(spark, monkeypatch, number, size, wordings):
    """Copies with a passage or some words changed, among documents of common passages."""
    monkeypatch.setattr(jaccard_join, "CROWDED_ROWS", 6)
    r = random.Random(number)
    made = passages(180, number, wordings, number, size)
    for old in made[:60]:
        new = list(old)
        for k in r.sample(range(number), r.randint(0, max(1, number // 8))):
            words = new[k].split()
            words[r.randrange(size)] = f"n{r.random()}"
            new[k] = " ".join(words) if r.random() < 0.7 else f"other {r.random()}"
        made.append(new)
    check(spark, [" ".join(m) for m in made])


def test_common_passages_do_not_list_all_pairs(spark, monkeypatch):
    pairs, real = [], jaccard_join.materialize

    def counted(df, name):
        out = real(df, name)
        if name in ("pairs", "keys"):
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", counted)
    n = 1600
    rows = near_duplicates(docs_of(spark, [" ".join(m) for m in passages(n, 1)])).collect()
    assert len({r.component_id for r in rows}) == n and sum(pairs) < 0.35 * n * (n - 1) / 2


def test_prefixes_hold_enough_columns():
    """Whatever shares the needed weight has k columns among the first ones."""
    r = random.Random(7)
    for _ in range(300):
        weights = [r.choice([1, 1, 2, 5]) for _ in range(r.randint(1, 9))]
        need = r.randint(1, sum(weights))
        for k in range(1, 5):
            j = combination_prefix(weights, need, k)
            shared = [c for size in range(len(weights) + 1) for c in itertools.combinations(range(len(weights)), size) if sum(weights[i] for i in c) >= need]
            enough = [all(sum(i < m for i in c) >= k for c in shared) for m in range(len(weights) + 1)]
            assert j is None or enough[j]
            if k == 1:
                assert j == enough.index(True)
            if j is None:
                assert not enough[-1] or k > 1


def test_words_that_polynomials_confuse(spark):
    words = parity_words(1024)
    assert check(spark, words + [" ".join([*"abcdefghijkl", w, *"mnopqrstuvwx"]) for w in words]) == 0


def test_nulls_clashes_and_empty_tables(spark):
    docs = docs_of(spark, ["a b c d e f", "A b c d e f", None, "x", "a b c d e f"], [None, 7, 8, None, 9]).selectExpr("*", "1 AS component_id")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in near_duplicates(docs).collect())
    assert got == [("7", 2, 7), ("8", 0, 8), ("9", 2, 7), ("None", 1, None), ("None", 2, 7)]
    assert near_duplicates(docs.limit(0)).collect() == []


def test_components_of_a_long_path(spark):
    edges = spark.range(40).selectExpr("id AS a", "id + 1 AS b").union(spark.sql("SELECT 100L, 101L"))
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).collect() == []
