import hashlib
import re

import numpy as np
import pytest
from cases import clashing, edge_docs, edge_rows
from pyspark.sql import functions as F

from contentmart.llm import fill_in_middle as FIM

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKED = [(100, "a <P> b"), (101, "x <S"), (102, "> <M"), (103, "<<S <P <M >>"), (104, "é" * 5000 + " \U0001f600\n"), (105, "\x1c a\x85b  ")]


def plain(doc_id, text, unit="word", fim=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text) if unit == "word" else list(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(tokens[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= fim:
        return (doc_id, n, "plain", None, None, text, text)
    if h4 % 100 < spm:
        return (doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}", text)
    return (doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}", text)


def got(df, **kw):
    out = FIM.transform(df, **kw)
    out = out.withColumn("restored", FIM.restore(F.col("output"), F.col("form")))
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("unit", ["word", "char"])
@pytest.mark.parametrize("fim,spm", [(50, 80), (100, 0), (100, 100)])
def test_edge_rows_equal_plain_python(spark, unit, fim, spm):
    data = [(r[0], r[1]) for r in edge_rows()] + MARKED
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    want = sorted((plain(i, t, unit, fim, spm) for i, t in data), key=repr)
    assert got(df, unit=unit, fim_percent=fim, spm_percent=spm) == want


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted((plain(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert got(docs) == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_slices_of_a_batch_give_the_same_rows():
    import pyarrow as pa

    from contentmart.llm.common import text_slices

    data = [(r[0], r[1] or "") for r in edge_rows()]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in data], pa.int64()), pa.array([t for _, t in data])], names=["doc_id", "text"])
    for limit in (1, 40, 1 << 20):
        parts = [FIM.transform_texts(p.column("doc_id").to_pylist(), p.column("text"), 42, "word", 50, 80) for p in text_slices(batch, "text", limit)]
        assert [r["output"] for p in parts for r in p.to_pylist()] == [plain(i, t)[5] for i, t in data]


def test_index_converts_both_ways():
    text = "aé€\U0001f600 b\ncé"
    data = np.frombuffer(text.encode(), np.uint8)
    index = FIM.ExceptionIndex(data)
    chars = np.arange(len(text) + 1)
    at = np.array([len(text[:k].encode()) for k in chars])
    assert index.bytes(chars).tolist() == at.tolist()
    assert index.chars(at).tolist() == chars.tolist()
    assert len(index.at) == 4  # the exceptions, not the characters


def test_clashing_names_and_empty_table(spark):
    want = sorted((plain(r[0], r[1]) for r in edge_rows()), key=repr)
    assert got(clashing(edge_docs(spark))) == want
    assert got(edge_docs(spark).limit(0)) == []
