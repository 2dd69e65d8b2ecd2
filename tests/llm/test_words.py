import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from agentlake.llm.words import ALPHANUMERIC, NOT_SPACE, find_words, slices
from tests.llm.plain import ALPHANUMERIC as ALPHANUMERIC_RE
from tests.llm.plain import FOLD, WORD, parity_words

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB1 \t\n\r\x00é—.,", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_and_hashes_follow_the_patterns(some):
    for table, pattern in ((NOT_SPACE, WORD), (ALPHANUMERIC, ALPHANUMERIC_RE)):
        words = find_words(pa.array(some, pa.large_string()), table, fold=True)
        expected = [pattern.findall((t or "").translate(FOLD)) for t in some]
        raw = words.buffer.tobytes()
        assert [raw[a:b].decode().translate(FOLD) for a, b in zip(words.start, words.end)] == [w for x in expected for w in x]
        assert words.count.tolist() == [len(x) for x in expected]
        folded = [w for x in expected for w in x]
        for made in (words.hashes(), words.fingerprints()):
            hashes = made.tolist()
            assert len(set(hashes)) == len(set(folded)) and len(set(zip(folded, hashes))) == len(set(folded))


def test_fingerprints_tell_words_apart():
    patterns = [w for n in (2, 8, 64, 1024, 4096) for w in parity_words(n)]
    other = ["a" * k for k in range(1, 40)] + ["a" * k for k in (255, 256, 257, 258, 1000)] + ["a" * 7 + "\x00", "a" * 8 + "\x00", "b" * 8 + "a" * 8, "a" * 8 + "b" * 8]
    texts = [*dict.fromkeys(patterns + other)]
    prints = find_words(pa.array(texts, pa.large_string())).fingerprints()
    assert len(set(prints.tolist())) == len(texts)
    padded = find_words(pa.array(["x  " + t + "\t" for t in texts], pa.large_string())).fingerprints()
    assert padded[1::2].tolist() == prints.tolist()
    folded = find_words(pa.array([t.upper() for t in texts], pa.large_string()), fold=True).fingerprints()
    assert folded.tolist() == find_words(pa.array(texts, pa.large_string()), fold=True).fingerprints().tolist()


def test_windows_stay_within_a_text():
    words = find_words(pa.array(["a b c", None, "c a b c"], pa.large_string()))
    at, values = words.windows(words.hashes(), 3)
    assert at.tolist() == [0, 3, 4] and values[0] == values[2] != values[1]
    assert words.windows(words.hashes(), 9)[0].tolist() == []


def test_slices_are_bounded_and_whole():
    batch = pa.record_batch({"text": pa.array(["aaaa", None, "b" * 50, "", "c"])})
    parts = list(slices(batch, limit=6))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert np.concatenate([p.column("text").to_pylist() for p in parts]).tolist() == batch.column("text").to_pylist()
