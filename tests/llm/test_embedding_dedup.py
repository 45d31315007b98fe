import math

import numpy as np
import pytest
from cases import rows, union_find

from contentmart.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"
COLS = ("vec_id", "n_links", "component_id", "kept")


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(data, threshold=0.95):
    """Rows with distinct ids only."""
    good = [(i, np.asarray(np.float32(v), float)) for i, v, _ in data if usable(v)]
    links = []
    for k, (i, a) in enumerate(good):
        for j, b in good[k + 1 :]:
            if len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                links.append((i, j))
    root = union_find([i for i, *_ in data], links)
    n = {i: 0 for i, *_ in data}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return sorted(((i, n[i], root[i], root[i] == i) for i, *_ in data), key=repr)


def sample():
    rng = np.random.default_rng(4)
    out = []
    for k in range(40):
        c = rng.normal(size=16)
        for j in range(5):
            out.append((k * 10 + j, [float(x) for x in c + 0.07 * rng.normal(size=16)], k % 3))
    out += [(900 + i, out[7][1], 1) for i in range(30)]  # copies
    out += [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 16, 0), (1003, [float("nan")] * 16, 0)]
    out += [(1004, [None] + [1.0] * 15, 0), (1005, [float("inf")] + [1.0] * 15, 0), (1006, [1.0, 2.0], 0), (1007, [2.0, 4.0], 0)]
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_matches_brute_force(spark, block):
    df = spark.createDataFrame(sample(), SCHEMA).repartition(3)
    # On data with clear groups nothing is missed.
    assert rows(E.near_duplicates(df, block=block), *COLS) == brute(sample())


def test_recall_and_precision_on_the_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    x = np.array([v for _, v, _ in data], float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = ((x @ x.T) >= 0.95).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in E.near_duplicates(df).collect()}
    mine = np.array([got[i] for i, *_ in data])
    assert (mine <= want).all()
    assert mine.sum() >= 0.99 * want.sum()


def test_recall_of_pairs_planted_just_above_the_threshold(spark):
    """The whole table, with a vector at cosine 0.9505 to 0.96 beside each fourth of it."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding", "label")
    data = [tuple(r) for r in df.collect()]
    rng = np.random.default_rng(12)
    top = max(i for i, *_ in data) + 1
    planted = []
    for k, (_, v, _) in enumerate(r for r in data[::4] if usable(r[1])):
        u = np.asarray(v, float) / np.linalg.norm(v)
        w = rng.normal(size=len(u))
        w -= (w @ u) * u
        c = rng.uniform(0.9505, 0.96)
        near = c * u + math.sqrt(1 - c * c) * w / np.linalg.norm(w)
        planted.append((top + k, [float(z) for z in near.astype(np.float32)], 0))
    data += planted
    x = np.array([v for _, v, _ in data], float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = np.concatenate([((x[at : at + 1024] @ x.T) >= 0.95).sum(axis=1) - 1 for at in range(0, len(x), 1024)])
    both = df.unionByName(spark.createDataFrame(planted, SCHEMA))
    got = {r.vec_id: r.n_links for r in E.near_duplicates(both).collect()}
    mine = np.array([got[i] for i, *_ in data])
    assert want.sum() >= 2 * len(planted)
    assert (mine <= want).all()
    assert mine.sum() >= 0.99 * want.sum()


def test_repeated_rows_null_ids_and_clashing_names(spark):
    from cases import clashing

    v = [1.0] * 8
    df = spark.createDataFrame([(1, v, 0), (1, v, 0), (None, v, 0), (2, None, 0)], SCHEMA)
    want = sorted([(1, 2, 1, True), (1, 2, 1, False), (None, 2, 1, False), (2, 0, 2, True)], key=repr)
    assert rows(E.near_duplicates(clashing(df)), *COLS) == want
    assert E.near_duplicates(df.limit(0)).collect() == []
