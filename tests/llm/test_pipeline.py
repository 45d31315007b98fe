from cases import CLASHES, clashing, edge_docs, edge_rows, rows
from test_line_dedup import brute as brute_lines
from test_packing import check_packed, plain_pieces
from test_simhash import brute as brute_simhash

import corpus_pipeline as C
from contentmart.llm import language_id, mixing
from contentmart.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_their_own_input(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for (name, stage), nxt in zip(C.STAGES, [*C.STAGES[1:], None], strict=True):
        data = [tuple(r) for r in docs.select(*COLUMNS).collect()]
        out, _ = materialise(stage(spark, docs, sf), f"test-{name}")
        if nxt:
            assert out.columns == COLUMNS
        got = [tuple(r) for r in out.select(*COLUMNS).collect()] if nxt else out.collect()
        if name == "language_id":
            bad = {r.doc_id for r in language_id.identify(docs).collect() if r.lang_pred == "und" or r.fit < language_id.REJECT_BELOW}
            assert sorted(got) == sorted(r for r in data if r[0] not in bad)
        elif name == "line_dedup":
            want = {i: t for i, t, *_ in brute_lines(data)}
            assert {r[0]: r[1] for r in got} == want and all(r[4] == len(r[1]) for r in got)
        elif name == "simhash_near_dedup":
            stay = {c for _, _, c in brute_simhash(data)}
            assert sorted(got) == sorted(r for r in data if r[0] in stay)
        elif name == "source_mixing":
            want = mixing.mix(docs, max_repetition=C.MAX_REPETITION)
            assert sorted(got) == sorted(tuple(r) for r in want.select(*COLUMNS).collect())
            assert set(got) <= set(data)
        else:
            cols = ("doc_id", "piece", "start", "length", "ids_crc32")
            assert rows(out, *cols) == plain_pieces(data)
            check_packed(got, 4096)
        docs = out


def test_run_gives_the_stages_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in C.STAGES:
        docs, _ = materialise(stage(spark, docs, sf), f"test-{name}")
    cols = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert rows(C.run(spark, sf), *cols) == rows(docs, *cols)


def test_hard_cases_pass_through_all_stages(spark):
    # "Text" beside "text" cannot be written as one Parquet table, so it is met by single stages below.
    docs = clashing(edge_docs(spark), [c for c in CLASHES if c != "Text"])
    names = docs.columns
    for name, stage in C.STAGES[:-1]:
        docs, _ = materialise(stage(spark, docs, ""), f"test-{name}")
        assert docs.columns == names
    assert C.STAGES[-1][1](spark, docs, "").count() > 0
    for _, stage in C.STAGES:
        assert stage(spark, clashing(edge_docs(spark)), "").count() > 0
    empty = edge_docs(spark).limit(0)
    for name, stage in C.STAGES:
        empty, _ = materialise(stage(spark, empty, ""), f"test-{name}")
        assert empty.count() == 0
    assert len(edge_rows()) == 16
