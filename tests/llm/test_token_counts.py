import random

from tokenizers import Tokenizer, models, pre_tokenizers

from agentlake.llm.queries import VOCABULARY, tokenizer_path
from agentlake.llm.token_counts import CountingSearch, Vocabulary, count_tokens, load_vocabulary
from tests.llm.plain import EDGE_TEXTS, docs_of, random_texts


def tokenizer(v):
    made = Tokenizer(models.Unigram(list(zip(v.pieces, v.scores)), v.unknown, v.byte_fallback))
    made.pre_tokenizer = pre_tokenizers.Metaspace()
    return made


def compare(v, texts):
    exact, search = tokenizer(v), CountingSearch(v)
    for t in texts:
        ids = exact.encode(t, add_special_tokens=False).ids
        assert search.text(t)[0] == len(ids), t


def test_equals_the_tokenizer():
    r = random.Random(2)
    parts = [*"abcXYZé—中\U0001f600 .\n▁<s>1", "the", "ing", " ", "</s>", "<0x0A>"]
    compare(load_vocabulary(tokenizer_path(VOCABULARY)), ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(2000)] + random_texts(30) + [t for t in EDGE_TEXTS if t])


def test_ties_follow_the_tokenizer():
    r = random.Random(3)
    for fallback in (False, True):
        for _ in range(40):
            pieces = {"<unk>": 0.0, "▁": -1.0}
            pieces.update({"".join(r.choice("ab▁") for _ in range(r.randint(1, 4))): -float(r.randint(1, 3)) for _ in range(8)})
            if fallback:
                pieces.update({f"<0x{b:02X}>": 0.0 for b in range(256)})
            v = Vocabulary(tuple(pieces), tuple(pieces.values()), 0, fallback)
            compare(v, ["".join(r.choice("abcd ") for _ in range(r.randint(0, 20))) for _ in range(60)])


def test_score_is_the_best_of_all_cuts():
    v = Vocabulary(("<unk>", "▁", "a", "b", "ab", "▁a", "bab"), (0.0, -1.5, -1.0, -2.0, -2.5, -2.25, -3.5), 0, False)
    score = dict(zip(v.pieces, v.scores))

    def best(s):
        return 0.0 if not s else max((score[s[:k]] + best(s[k:]) for k in range(1, len(s) + 1) if s[:k] in score), default=-1e9)

    for word in ("a", "ab", "abab", "babab", "aabba"):
        assert CountingSearch(v).text(word)[1] == best("▁" + word)


def test_edges(spark):
    docs = docs_of(spark, [*EDGE_TEXTS, "one"]).selectExpr("*", "1 AS N_Tokens")
    got = count_tokens(docs, tokenizer_path(VOCABULARY))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "best_score"]
    rows = got.orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows[:2]] == [0, 0] and rows[3].n_tokens == rows[-1].n_tokens > 0
    assert count_tokens(docs.limit(0), tokenizer_path(VOCABULARY)).collect() == []
