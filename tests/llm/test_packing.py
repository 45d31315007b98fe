import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import clashing, edge_docs, edge_rows

from contentmart.llm import packing as P
from contentmart.llm.registry import tokenizer_path

COLS = ("doc_id", "piece", "start", "length", "ids_crc32")


def plain_pieces(data, sequence=4096, end=1):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    out = []
    for i, t, *_ in data:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [end]
        for k, at in enumerate(range(0, len(ids), sequence)):
            part = np.array(ids[at : at + sequence], "<u4")
            out.append((i, k, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def check_packed(got, sequence):
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
    return len(seqs)


@pytest.mark.parametrize("sequence,open_bins,per_task", [(4096, 8192, 16_384), (64, 3, 5), (1, 1, 3)])
def test_pieces_are_the_tokenizers_and_sequences_have_no_gaps(spark, sequence, open_bins, per_task):
    data = [r for r in edge_rows() if sequence > 1 or r[0] != 7]
    df = edge_docs(spark) if sequence > 1 else edge_docs(spark).filter("doc_id is null or doc_id != 7")
    got = P.pack(df, tokenizer_path(), sequence=sequence, open_bins=open_bins, pieces_per_task=per_task).collect()
    assert sorted((tuple(r[c] for c in COLS) for r in got), key=repr) == plain_pieces(data, sequence)
    check_packed(got, sequence)


def test_words_one_by_one_equal_whole_texts(spark):
    """Ids of space-separated words in a row are the ids of the text, special strings included."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["a <|endoftext|> b", "x y ́z", "a b\tc  d \n e", "ΑΣ ΣΑΣ", "İstanbul é ñ", "‍ ​"]
    texts += ["over. a.b. wait... so, é. ab,, x!. <|ENDOFTEXT|> y.", "End. WORD, it's 'S a.b, . , ., it'. we'LL. 3.4, 5.", "É, ß. ﬁ. Ǆ, a."]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    for t, ids in zip(texts, P.encode(texts, tokenizer_path()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_few_sequences(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = P.pack(df, tokenizer_path()).collect()
    least = -(-sum(r.length for r in got) // 4096)
    assert check_packed(got, 4096) <= 1.01 * least + 1


def test_best_fit_takes_the_fullest_bin_that_fits_and_closes_the_fullest():
    b = P.BestFit(10, open_bins=2)
    assert b.place(6) == (0, 0) and b.place(7) == (1, 0)
    assert b.place(3) == (1, 7)  # the bin with 3 free, not the one with 4
    assert b.place(5) == (2, 0)  # fits no open bin
    assert b.place(9) == (3, 0)  # two open already: the fullest, this one, closes at once
    assert b.place(1) == (0, 6) and b.place(5) == (2, 5)
    assert b.n_open <= 2


def test_production_bound_closes_bins_of_a_full_task(spark):
    """Real lengths in arrival order: the bound is at work, and closes only bins with little space left."""
    made = P.pieces(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), tokenizer_path())
    lengths = [r.length for r in made.orderBy("rid", "piece").limit(P.PIECES_PER_TASK).collect()]
    b = P.BestFit(P.SEQUENCE, P.OPEN_BINS)
    used = defaultdict(int)
    for n in lengths:
        k, at = b.place(n)
        assert at == used[k] and at + n <= P.SEQUENCE
        used[k] += n
    assert b.n_closed > 0 and b.n_open <= P.OPEN_BINS
    assert len(used) <= 1.01 * sum(lengths) / P.SEQUENCE + 1


def test_pieces_are_placed_in_arrival_order(spark):
    """One task's bins are those of placing its pieces row by row."""
    got = P.place(spark.createDataFrame([(i, n) for i, n in enumerate([3, 9, 4, 7, 2, 6])], "item long, length long"), 1, 10, 2)
    b = P.BestFit(10, 2)
    want = [b.place(n) for n in (3, 9, 4, 7, 2, 6)]
    assert [(r.bin, r["at"]) for r in got.orderBy("item").collect()] == want


def test_clashing_names_and_empty_table(spark):
    got = P.pack(clashing(edge_docs(spark)), tokenizer_path()).collect()
    assert sorted((tuple(r[c] for c in COLS) for r in got), key=repr) == plain_pieces(edge_rows())
    assert P.pack(edge_docs(spark).limit(0), tokenizer_path()).collect() == []


def test_words_share_texts_of_the_tokenizer():
    """Distinct words of letters, with signs behind them or not, go through the tokenizer many at a time."""
    tokenizer, cache = P._encoder(tokenizer_path())
    kept = dict(cache)
    cache.clear()
    sent = []

    class Counting:
        def encode_batch_fast(self, texts, **how):
            sent.extend(texts)
            return tokenizer.encode_batch_fast(texts, **how)

    names = ["".join(chr(97 + (i * k) % 26) for k in (1, 3, 7, 11)) + "éß"[i % 2] * (i // 26) for i in range(2000)]
    texts = [f"{a} {a}, {a}.&&" for a in names]
    P._WORKER["tokenizer"] = Counting()
    try:
        got = list(P.encode(texts, tokenizer_path()))
    finally:
        P._WORKER["tokenizer"] = tokenizer
        cache.update(kept)
    want = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert got == [np.asarray(e.ids, "<u4").tobytes() for e in want]
    assert len(sent) < 100


@pytest.mark.parametrize("seed", range(3))
def test_ids_are_the_tokenizers(seed):
    rng = np.random.default_rng(seed)
    signs = [*"abcABZ .,!?'\"-_/<|>&$%#()0129\n\t\r\x0b", *"éÉßüøØ÷×İıĲŉǅȺɏʼµªº²ſΣσ中가क़ﬁ", "́", "̸", "Å", " ", "'s", "'re", "foo", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 14, 5000)]
    want = P._encoder(tokenizer_path())[0].encode_batch_fast(texts, add_special_tokens=False)
    assert list(P.encode(texts, tokenizer_path())) == [np.asarray(e.ids, "<u4").tobytes() for e in want]
