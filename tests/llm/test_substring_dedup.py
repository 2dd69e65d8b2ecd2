import pytest
from pyspark.sql import functions as F

from agentlake.llm import gram_exchange as X
from agentlake.llm.substring_dedup import remove_repeats
from tests.llm.plain import EDGE_TEXTS, docs_of, parity_words, plain_repeats, random_texts


def check(docs, rows, **more):
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]], r[1] is None, (r[1] or "").encode()))
    got = remove_repeats(docs, digest=True, **more).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(
        (str(i), *e) for (i, _), e in zip(order, plain_repeats(order)))


@pytest.mark.parametrize("group_bytes", [1 << 23, 900])
def test_equals_plain_loop(spark, group_bytes):
    texts = random_texts(160, seed=5, words=90) + EDGE_TEXTS + EDGE_TEXTS[-2:]
    ids = [k * k % 977 + 1000 * k for k in range(len(texts) - 2)] + [None, None]
    docs = docs_of(spark, texts, ids)
    layout = X.plan_layout(docs, group_bytes, max(group_bytes, 30_000))
    assert layout.groups > (20 if group_bytes < 1000 else 1)
    check(docs, list(zip(ids, texts)), layout=layout)


def test_words_that_polynomials_confuse(spark):
    texts = [" ".join([*"abcdefghijkl", word, *"mnopqrstuvwx"]) for size in (1024, 4096) for word in parity_words(size)]
    check(docs_of(spark, texts), list(enumerate(texts)))
    assert {r.n_removed for r in remove_repeats(docs_of(spark, texts)).collect()} == {0}


def test_first_of_equal_rows_stays_and_text_is_returned(spark):
    text = " ".join(f"w{k}" for k in range(25))
    docs = docs_of(spark, [text, text + "  tail", text], [4, 2, 4]).selectExpr("*", "0 AS n_removed", "1 AS grp")
    got = sorted((r.doc_id, r.n_removed, r.kept_text) for r in remove_repeats(docs).collect())
    assert got == [(2, 0, text + " tail"), (4, 25, ""), (4, 25, "")]
    assert remove_repeats(docs.limit(0)).collect() == []


@pytest.mark.parametrize("ids", ["a third each null and one id", "clusters", "ends of the range", "one id"])
def test_groups_are_bounded_and_in_order(spark, ids):
    n = 3000
    chosen = {
        "a third each null and one id": [None if k % 3 == 0 else 7 if k % 3 == 1 else k for k in range(n)],
        "clusters": [k if k % 2 else 10**15 + k // 600 * 10**9 + k % 600 for k in range(n - 1)] + [10**18],
        "ends of the range": [(1 << 63) - 1 - k if k % 2 else k - (1 << 63) for k in range(n)],
        "one id": [5] * n,
    }[ids]
    texts = [f"text {k} " + "x" * (k % 90) for k in range(n)]
    docs = docs_of(spark, texts, chosen)
    limit = 3000
    layout = X.plan_layout(docs, limit, 10_000)
    rows = X.in_groups(docs, layout).collect()
    sizes, spans = {}, {}
    for r in rows:
        sizes[r.grp] = sizes.get(r.grp, 0) + len(r.text)
        spans.setdefault(r.grp, []).append((r.doc_id is None, r.doc_id or 0, r.text_hash))
    assert max(sizes.values()) <= 2 * limit + 100 and 0 <= min(sizes) <= max(sizes) < layout.groups
    ordered = [(min(spans[g]), max(spans[g])) for g in sorted(spans)]
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    some = {i for i in chosen if i is not None}
    held = {r.doc_id: set(r.g) for r in docs.where("doc_id IS NOT NULL").select("doc_id", layout.groups_of(F.col("doc_id")).alias("g")).collect()}
    assert set(held) == some and all(r.doc_id is None or r.grp in held[r.doc_id] for r in rows)


def test_repeated_and_missing_ids_over_many_groups(spark):
    texts = random_texts(240, seed=9, words=70)
    ids = [None if k % 3 == 0 else 7 if k % 3 == 1 else k for k in range(240)]
    docs = docs_of(spark, texts, ids)
    layout = X.plan_layout(docs, 900, 5000)
    assert layout.without_id > 3 and layout.groups > 15
    check(docs, list(zip(ids, texts)), layout=layout)


def test_messages_survive_packing():
    import numpy as np

    r = np.random.default_rng(0)
    for bits in (10, 38, 64):
        values = np.unique(r.integers(0, 1 << min(bits, 63), 500, dtype=np.uint64) << np.uint64(bits == 64))
        codes = r.integers(0, 256, len(values)).astype(np.uint8)
        sent = X.messages(3, values, codes, 7, bits)
        parts = [X.unpack(p) for p in sent["payload"].to_pylist()]
        assert np.array_equal(np.concatenate([v for v, _ in parts]), values) and np.array_equal(np.concatenate([c for _, c in parts]), codes)
