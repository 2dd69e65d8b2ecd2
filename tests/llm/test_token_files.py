import zlib

import numpy as np
import pytest
import zstandard

from agentlake.llm.queries import END_ID, TOKENIZER, tokenizer_path
from agentlake.llm.storage import new_folder
from agentlake.llm.token_files import TokenFile, WordEncoder, _file_system, read_token_files, token_manifest, write_token_files
from tests.llm.plain import EDGE_TEXTS, docs_of, random_texts

ODD = ["á ́b <|startoftext|>x<|endoftext|> y\x1cz\x85q\xa0w <|ENDOFTEXT|>", "Σας İI it's 're'll 12a b﻿", "!'s a!'s—!x", "日本語 한국어"]
#: Letters whose lower case alone composes with the mark.
ODD += ["H\u0331amza \u1e96amza h\u0331amza HAMZA", "T\u0308e", "W\u030aa", "J\u030carda \u01f0arda JARDA"]


def plain_ids(texts):
    from tokenizers import Tokenizer

    coded = Tokenizer.from_file(tokenizer_path(TOKENIZER)).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*c.ids, END_ID] for c in coded]


def test_words_encode_as_whole_texts():
    texts = ODD + EDGE_TEXTS + random_texts(40)
    ids, counts = WordEncoder(tokenizer_path(TOKENIZER), END_ID).encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == plain_ids(texts)


def test_round_trip(spark):
    texts = ODD + EDGE_TEXTS + random_texts(100, seed=2)
    ids = [(k * 37) % 1000 - 300 for k in range(len(texts) - 2)] + [None, None]
    folder = new_folder(spark, "tokens")
    manifest = write_token_files(docs_of(spark, texts, ids).repartition(5), folder, tokenizer_path(TOKENIZER), END_ID, frame_bytes=700)
    assert manifest.agg({"docs": "sum"}).first()[0] == len(texts)
    hashes = {r.text: r.h for r in docs_of(spark, texts).selectExpr("text", "xxhash64(text) AS h").collect()}
    order = sorted(range(len(texts)), key=lambda k: (ids[k] is not None, ids[k] or 0, hashes[texts[k]], texts[k] or ""))
    expected, start = [], 0
    for k, coded in zip(order, plain_ids([texts[k] for k in order])):
        expected.append((ids[k], start, len(coded), coded))
        start += len(coded)
    got = sorted((r.start, r) for r in read_token_files(spark, folder).collect())
    assert [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for _, r in got] == expected
    wanted = [ids[3], ids[40], 10**9]
    some = read_token_files(spark, folder, only=wanted).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in some] == [e[:2] for e in expected if e[0] in wanted]


def test_file_format_and_damage(spark):
    folder = new_folder(spark, "tokens")
    write_token_files(docs_of(spark, ["a b c " * 500, "d"]).coalesce(1), folder, tokenizer_path(TOKENIZER), END_ID, frame_bytes=400)
    system, base = _file_system(folder)
    name = token_manifest(spark, folder).first().file
    with system.open_input_file(f"{base}/{name}") as source:
        raw = source.read()
        file = TokenFile(source)
        assert len(file.sizes) > 5 and max(file.sizes) <= 400
        whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(raw)
        assert whole == b"".join(file.document(k) for k in range(2)) and zlib.crc32(whole)
    import pyarrow as pa

    broken = bytearray(raw)
    broken[int(file.places[0]) + 12] ^= 1
    damaged = TokenFile(pa.BufferReader(bytes(broken)))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        damaged.document(0)
    with pytest.raises(ValueError):
        TokenFile(pa.BufferReader(b"0" * 40))


def test_files_are_sized_by_their_texts_and_split_ids(spark):
    texts = [f"text {k} " * 20 for k in range(600)]
    ids = [None if k % 3 == 0 else 7 if k % 3 == 1 else k + 1000 if k > 30 else k - 2 for k in range(600)]
    folder = new_folder(spark, "tokens")
    manifest = write_token_files(docs_of(spark, texts, ids).repartition(4), folder, tokenizer_path(TOKENIZER), END_ID, file_bytes=8000).collect()
    assert 8 <= len(manifest) <= 15 + 2 and max(m.docs for m in manifest) < 130
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in read_token_files(spark, folder).collect())
    assert [-1 if d is None else d for _, d, _ in rows] == sorted(-1 if i is None else i for i in ids)
    assert [s for s, _, _ in rows] == [sum(n for _, _, n in rows[:k]) for k in range(600)]
    assert sum(m.first_id == 7 for m in manifest) > 2
    assert read_token_files(spark, folder, only=[7]).count() == 200


def test_many_wanted_documents(spark):
    folder = new_folder(spark, "tokens")
    write_token_files(docs_of(spark, [f"text {k}" for k in range(6000)], range(0, 60_000, 10)).repartition(3), folder, tokenizer_path(TOKENIZER), END_ID, file_bytes=8000)
    wanted = list(range(5, 60_000, 7))
    got = sorted(r.doc_id for r in read_token_files(spark, folder, only=wanted).collect())
    assert got == [k for k in range(0, 60_000, 10) if k in set(wanted)] and len(got) > 500
    assert read_token_files(spark, folder, only=[]).collect() == read_token_files(spark, folder, only=[-5, 10**12]).collect() == []


def test_empty_table(spark):
    folder = new_folder(spark, "tokens")
    assert write_token_files(docs_of(spark, ["a"]).limit(0), folder, tokenizer_path(TOKENIZER), END_ID).collect() == []
    assert read_token_files(spark, folder).collect() == []


def test_a_full_cache_keeps_its_frequent_words(monkeypatch):
    """Where more words come than a worker keeps, ids stay right, the frequent words stay and the others go."""
    monkeypatch.setattr("agentlake.llm.token_files.CACHED_WORDS", 40)
    encoder, often = WordEncoder(tokenizer_path(TOKENIZER), END_ID), [f"often{k}" for k in range(12)]
    for turn in range(30):
        texts = [" ".join([*often, *(f"rare{turn}x{k}é" for k in range(15))]), None, "  "]
        ids, counts = encoder.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == plain_ids(texts)
        assert {w.encode() for w in often} <= set(encoder.numbers) and len(encoder.numbers) <= 40 + 16
        assert len(encoder.numbers) == len(encoder.lengths) - 1 == len(encoder.seen) - 1
    encoder._forget()
    assert set(encoder.numbers) == {w.encode() for w in often}


def test_new_words_go_to_the_model_by_pieces(monkeypatch):
    """Plain words skip the whole tokenizer, with the same ids; a word is looked up once a call."""
    encoder, whole, looked = WordEncoder(tokenizer_path(TOKENIZER), END_ID), [], []
    through, missing = encoder._ids, type(encoder.numbers).__missing__
    monkeypatch.setattr(encoder, "_ids", lambda words: whole.extend(words) or through(words))
    monkeypatch.setattr(type(encoder.numbers), "__missing__", lambda self, word: looked.append(word) or missing(self, word))
    plain = [chr(k) * n + end for k in [*range(33, 127), *range(192, 256)] if chr(k) not in "×÷" for n in (1, 3) for end in ("", "É,", "'S", "12", "!'re")]
    odd = ["x́é", "İx", "a\xa0b", "x÷y", "ﬁn", "µm²", "ªº", "\x01a", "日本"]
    texts = [" ".join(plain), "  " + " \t\n".join(odd) + " ", " ".join(plain + odd), None, "", " \x0b "]
    ids, counts = encoder.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == plain_ids(texts)
    assert sorted(whole) == sorted(odd) and len([w for w in looked if w]) == len(encoder.numbers)
    ids, counts = encoder.encode(["<|endoftext|> Été <|ENDOFTEXT|> b"])
    assert [ids.tolist()] == plain_ids(["<|endoftext|> Été <|ENDOFTEXT|> b"])


def test_other_tokenizers_take_every_word_whole(tmp_path):
    """Only a tokenizer that cuts and spells in a known way is served by pieces."""
    import json

    with open(tokenizer_path(TOKENIZER), "rb") as file:
        settings = json.load(file)
    assert WordEncoder(tokenizer_path(TOKENIZER), END_ID).cut is not None
    for k, (part, step) in enumerate([("normalizer", {"type": "StripAccents"}), ("pre_tokenizer", {"type": "Punctuation", "behavior": "Isolated"})]):
        key = "normalizers" if part == "normalizer" else "pretokenizers"
        other = settings | {part: settings[part] | {key: [*settings[part][key], step]}}
        (tmp_path / f"{k}.json").write_text(json.dumps(other))
        assert WordEncoder(str(tmp_path / f"{k}.json"), END_ID).cut is None


def test_a_caller_may_keep_fewer_words():
    encoder = WordEncoder(tokenizer_path(TOKENIZER), END_ID, 20)
    for turn in range(4):
        ids, counts = encoder.encode(texts := [f"both w{turn}x{k}" for k in range(30)])
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == plain_ids(texts)
        assert len(encoder.numbers) <= 10 + 31
