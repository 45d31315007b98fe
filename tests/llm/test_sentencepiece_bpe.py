import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from cases import clashing, edge_docs, edge_rows

from contentmart.llm import sentencepiece_bpe as S
from contentmart.llm.registry import op12_sentencepiece, piece_model_path, sentencepiece_digests


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


@pytest.fixture(scope="module")
def vocab():
    return S.Vocabulary(piece_model_path())


HARD = [
    "", " ", "  ", "   a", "a   b  ", " " * 40 + "x", " " * 5000, "a\nb\n\n c\t\td\r\n", "\x00\x01", "▁", "▁▁ ▁x▁", "<s></s><unk><0x0A>",
    "aaaaaaaaaaaaaaaaaaaaaaa", "abababababababab" * 9, "ha" * 3000, "\U0001f600\U0001f601é́ ЖЖ漢字かな﻿�", "x" * 9000 + " y", "ٱلْعَرَبِيَّة", "https://a.b/c_d?e=f&g=%20",
    "1234567890" * 300, "==========-----------________", "the the the", "  　 end", "mississippi" * 400,
]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    letters = ["abcdefghij ", "etaoin shrdlu  ", " \n▁a", "0123456789.,- ", "éèüßñ а漢\U0001f600e ", "aA bB_", "=-_*# "]
    return ["".join(rng.choices(rng.choice(letters), k=rng.randrange(1, 90))) for _ in range(n)]


def test_ids_are_the_librarys(vocab, library):
    texts = HARD + random_texts(4000)
    got = [np.frombuffer(i, "<i4").tolist() for i in vocab.encode_all(texts)]
    for t, g, w in zip(texts, got, library.encode(texts), strict=True):
        assert g == w, t[:80]


def test_one_by_one_and_rounds_agree(vocab, monkeypatch):
    texts = HARD + random_texts(500, seed=8)
    want = vocab.encode_all(texts)
    for limit in (1, 5):
        monkeypatch.setattr(S, "LONG", limit)
        vocab.cache = {}
        assert vocab.encode_all(texts) == want
    monkeypatch.setattr(S, "LONG", 10**9)
    short = [t for t in texts if len(t) < 2000]
    vocab.cache = {}
    assert vocab.encode_all(short) == [w for t, w in zip(texts, want, strict=True) if len(t) < 2000]


def test_cache_bound(vocab, monkeypatch):
    texts = random_texts(300, seed=9)
    want = vocab.encode_all(texts)
    monkeypatch.setattr(S, "CACHE_WORDS", 50)
    for t, w in zip(texts, want, strict=True):
        assert vocab.encode_all([t]) == [w]
        assert len(vocab.cache) <= 50


def test_any_ids_decode_as_the_librarys(vocab, library):
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, hi, rng.integers(0, 30)).tolist() for hi in (5, 270, 32000) for _ in range(700)]
    rows += [[], [2], [2, 259], [259, 259], [1, 1, 300], [0, 300], [0xE2 + 3, 0x41 + 3], [0xE2 + 3, 0x96 + 3, 0x81 + 3], [0xED + 3, 0xA0 + 3, 0x80 + 3]]
    offsets = np.cumsum([0] + [len(r) for r in rows])
    got = vocab.decode_all(np.array([i for r in rows for i in r], np.int32), offsets)
    for r, g in zip(rows, got, strict=True):
        assert g == library.decode(r), r


def want_rows(data, library):
    out = []
    for i, t in data:
        ids = library.encode(t or "") + [2]
        out.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids)))))
    return sorted(out, key=repr)


def digests(docs):
    return sorted((tuple(r) for r in sentencepiece_digests(docs).collect()), key=repr)


def test_whole_table(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op12_sentencepiece(spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == want_rows(docs, library)


def test_hard_cases(spark, library):
    data = [(r[0], r[1]) for r in edge_rows()]
    assert digests(clashing(edge_docs(spark))) == want_rows(data, library)


def test_empty_table_and_null_ids(spark):
    assert digests(edge_docs(spark).limit(0)) == []
    frame = spark.createDataFrame([(1, None), (2, []), (3, [264, 2])], "doc_id long, ids array<int>")
    assert [(r.doc_id, r.text) for r in S.decode(frame, piece_model_path()).sort("doc_id").collect()] == [(1, None), (2, ""), (3, "a")]
