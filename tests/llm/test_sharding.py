import zlib

import numpy as np
import pytest
from cases import clashing, edge_docs, edge_rows

from contentmart.llm import sharding as H


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_every_cell_once_by_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    spot = H.hilbert_index(grid, bits)
    assert sorted(spot.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(spot)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(got, n, shards):
    per = {}
    for r in got:
        per.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, per.values())) == n and set(per) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    sizes = [len(per.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("shards,run_bytes", [(8, 1 << 25), (8, 100_000), (3, 20_000), (1, 200_000)])
def test_counts_slots_and_digests(spark, shards, run_bytes):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    rows, path = H.shard(df, shards=shards, run_bytes=run_bytes)
    got = rows.collect()
    check(got, len(texts), shards)
    assert all(r.size == len(r.text.encode()) + 1 and r.text == texts[r.doc_id] for r in got)
    by_rank = sorted(got, key=lambda r: r.rank)
    assert [r.curve for r in by_rank] == sorted(r.curve for r in got)
    assert [r.shard for r in by_rank] == sorted(r.shard for r in got)
    files = spark.read.parquet(path)
    assert files.count() == len(texts)
    spans = H.manifest(rows).collect()
    assert sum(s.last_slot - s.first_slot + 1 for s in spans) == len(texts)


def test_files_can_be_pruned_by_several_dimensions(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows, _ = H.shard(df, run_bytes=500_000)
    spans = H.manifest(rows).collect()
    assert len({s.run for s in spans}) >= 20
    for dim, value in (("dim_lang", "de"), ("size", 20_000), ("doc_id", 9_990)):
        touched = sum(s[f"min_{dim}"] <= value <= s[f"max_{dim}"] for s in spans)
        assert touched < 0.7 * len(spans), (dim, touched, len(spans))


def test_layout_splits_heavy_cells_and_packs_light_ones():
    layout, runs = H.lay_out([(5, 30), (1, 40), (2, 50), (3, 350), (4, 20)], 100)
    assert layout == [(1, 0, 1), (2, 0, 1), (3, 1, 4), (4, 5, 1), (5, 5, 1)] and runs == 6
    assert H.lay_out([], 100) == ([], 1)


@pytest.mark.parametrize("n,cells", [(40, 16), (3, 3), (1, 1)])
def test_strings_are_cut_by_rank_however_they_begin(spark, n, cells):
    names = [f"https://example.org/a/very/long/common/beginning/{i:02d}" for i in range(n)]
    df = spark.createDataFrame([(names[i % n], i) for i in range(800)] + [(None, -1)], "source string, k int").repartition(5)
    got = {(r.source, r.cells[0]) for r in H.quantised(df, ["source"], 4).collect()}
    assert len(got) == n + 1 and len({c for s, c in got if s}) == cells and (None, 0) in got
    order = [c for _, c in sorted((s, c) for s, c in got if s)]
    assert order == sorted(order)


def test_a_hot_string_takes_one_cell_and_the_rest_are_spread(spark):
    rows = [("m" * 50, i) for i in range(500)] + [(f"{'a' if i % 2 else 'z'}{i:04d}", i) for i in range(1000)]
    got = H.quantised(spark.createDataFrame(rows, "source string, k int"), ["source"], 4).collect()
    sizes = {}
    for r in got:
        sizes[r.cells[0]] = sizes.get(r.cells[0], 0) + 1
    assert max(sizes.values()) <= 600 and len(sizes) >= 11


def test_runs_are_of_about_equal_bytes(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows, _ = H.shard(df, run_bytes=1_000_000)
    sizes = [r[1] for r in rows.groupBy("run").agg({"size": "sum"}).collect()]
    assert max(sizes) < 1_300_000 and sum(sizes) / len(sizes) > 400_000


def test_hard_cases(spark):
    rows, _ = H.shard(clashing(edge_docs(spark)), run_bytes=2000)
    got = rows.collect()
    check(got, len(edge_rows()), 8)
    want = sorted((repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows())
    assert sorted((repr(r.doc_id), r.size, zlib.crc32((r.text or "").encode())) for r in got) == want
    empty, _ = H.shard(edge_docs(spark).limit(0))
    assert empty.collect() == []
    same = spark.createDataFrame([(1, "x", "s")] * 50, "doc_id long, text string, source string")
    rows, _ = H.shard(same, run_bytes=10)
    check(rows.collect(), 50, 8)
