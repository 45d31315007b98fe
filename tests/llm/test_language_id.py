import zlib

import numpy as np
from cases import clashing, edge_docs

from contentmart.llm import language_id as L


def table(spark, sf="sf0.01"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in table(spark).collect()}
    got = L.identify(table(spark)).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_mixture_of_two_languages_is_found(spark):
    docs = table(spark).filter("n_chars > 3000").collect()
    one, two = (next(r.text for r in docs if r.lang == x) for x in ("en", "de"))
    langs, logp = L.train(table(spark))
    for share in (0.25, 0.5, 0.75):
        text = one[: int(3000 * share)] + " " + two[: int(3000 * (1 - share))]
        found, _ = L.infer(L.trigram_buckets(text), logp)
        assert {langs[m] for m in found} == {"en", "de"}
        assert abs(found[langs.index("en")] - share) < 0.12


def test_em_raises_the_likelihood_and_shares_sum_to_one():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(50), 3)[None]
    k = rng.integers(1, 9, 50).astype(float)
    runs = [L._em(p, k, r) for r in (1, 3, 10, 50)]
    assert all(a[1][0] <= b[1][0] + 1e-9 for a, b in zip(runs, runs[1:]))  # noqa: B905
    assert np.isclose(runs[-1][0].sum(), 1)


def test_counting_is_the_same_however_rows_are_dealt(spark):
    a = L.train(table(spark, "sf0.001").repartition(7))
    b = L.train(table(spark, "sf0.001").coalesce(1))
    assert a[0] == b[0] and np.array_equal(a[1], b[1])
    rows = table(spark, "sf0.001").select("text", "lang").collect()
    n = {}
    for t, lang in rows:
        n[lang] = n.get(lang, 0) + np.bincount(L.trigram_buckets(t), minlength=L.BUCKETS)
    want = np.stack([n[x] for x in sorted(n)]) + 0.5
    assert np.allclose(a[1], np.log(want / want.sum(axis=1, keepdims=True)))


def test_hard_cases(spark):
    got = {}
    for r in L.identify(clashing(edge_docs(spark))).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == edge_docs(spark).count()
    for i in (1, 2, 3, 8):
        assert got[i][0].lang_pred == "und" and got[i][0].score == 0.0
    assert got[7][0].lang_pred in ("en", "fr", "de")
    assert len(got[5]) == 2 and got[None][0].held_out
    assert L.identify(edge_docs(spark).limit(0)).collect() == []
    unlabelled = L.identify(edge_docs(spark).selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_filter_keeps_clean_documents_and_columns(spark):
    docs = table(spark)
    kept = L.filter_languages(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    left = L.filter_languages(clashing(edge_docs(spark)))
    assert left.columns == clashing(edge_docs(spark)).columns
    ids = [r[0] for r in left.collect()]
    assert not {1, 2, 3, 8} & set(ids) and 7 in ids


def test_noise_is_rejected(spark):
    rng = np.random.default_rng(2)
    noise = " ".join("".join(chr(0x4E00 + c) for c in rng.integers(0, 8000, 6)) for _ in range(300))
    docs = table(spark)
    extra = spark.createDataFrame([(10**9, noise, "en", "x", len(noise))], docs.schema)
    kept = {r.doc_id for r in L.filter_languages(docs.unionByName(extra)).select("doc_id").collect()}
    assert 10**9 not in kept and len(kept) == docs.count()


def test_every_label_is_learned(spark):
    """More than 256 labels, the rarest among them; each has words of its own."""
    rng = np.random.default_rng(4)
    words = [["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(12)] for _ in range(270)]
    rows, doc_id = [], 0
    for lang, own in enumerate(words):
        for _ in range(1 if lang == 269 else 2):
            while zlib.crc32(str(doc_id).encode()) % 5 == 0:
                doc_id += 1
            rows.append((doc_id, " ".join(own), f"l{lang:03d}"))
            doc_id += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in L.identify(docs).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_the_filter_learns_from_held_out_labels_too(spark):
    odd = next(i for i in range(10**6, 10**6 + 100) if zlib.crc32(str(i).encode()) % 5 == 0)
    text = " ".join("\u0e20\u0e32\u0e29\u0e32 \u0e44\u0e17\u0e22 \u0e14\u0e35\u0e21\u0e32\u0e01".split() * 80)
    docs = table(spark, "sf0.001")
    extra = spark.createDataFrame([(odd, text, "th", "x", len(text))], docs.schema)
    kept = {r.doc_id for r in L.filter_languages(docs.unionByName(extra)).select("doc_id").collect()}
    assert odd in kept
