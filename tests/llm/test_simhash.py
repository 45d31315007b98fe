import random
from itertools import combinations

import pytest
import xxhash
from cases import DOCS, clashing, edge_docs, edge_rows, low_words, rows, union_find

from contentmart.llm import simhash as S


def naive_print(text, k=4):
    w = low_words(text)
    if not w:
        return 0
    grams = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(data, bits=4):
    fps = [naive_print(t) for _, t, *_ in data]
    links = [(a, b) for a, b in combinations(sorted(set(fps)), 2) if (a ^ b).bit_count() <= bits]
    root = union_find(set(fps), links)
    least = {}
    for (i, *_), f in zip(data, fps, strict=True):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for (i, *_), f in zip(data, fps, strict=True)), key=repr)


COLS = ("doc_id", "fingerprint", "component_id")


def near_family(n, flips, seed=3):
    """Documents whose fingerprints are near each other: shared shingles with few changes."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randrange(flips)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        out.append((100 + i, " ".join(w), "en", "s", 1))
    return out


@pytest.mark.parametrize("long_list", [64, 2])
@pytest.mark.parametrize("bits", [3, 4])
def test_matches_brute_force(spark, bits, long_list):
    data = edge_rows() + near_family(60, 12)
    df = spark.createDataFrame(data, DOCS).repartition(3)
    assert rows(S.near_duplicates(df, max_bits=bits, long_list=long_list), *COLS) == brute(data, bits)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert rows(S.near_duplicates(df), *COLS) == brute(data)


def perturbed(n, seed, spread):
    """Distinct 64-bit words, each a few flipped bits away from one of three centres."""
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(3)]
    out = set()
    while len(out) < n:
        f = rnd.choice(centres)
        for b in rnd.sample(range(64), rnd.randrange(spread)):
            f ^= 1 << b
        out.add(f)
    return sorted(out)


@pytest.mark.parametrize("spread,block", [(4, 2048), (9, 50), (13, 7), (20, 64)])
def test_long_lists_connect_what_is_near_and_nothing_else(spark, spread, block):
    words = perturbed(700, spread, spread)
    near = [(a, b) for a, b in combinations(words, 2) if (a ^ b).bit_count() <= 4]
    want = union_find(words, near)
    signed = {w: w - (1 << 64) if w >> 63 else w for w in words}
    prints = spark.createDataFrame([(f,) for f in signed.values()], "fp long")
    got = [(r.a, r.b) for r in S.links(prints, 4, len(words), long_list=8, block=block).collect()]
    mine = union_find(signed.values(), got)
    assert len({(want[w], mine[signed[w]]) for w in words}) == len(set(want.values())) == len(set(mine.values()))


def test_a_family_of_thousands_gives_few_links(spark):
    words = perturbed(12_000, 5, 8)
    prints = spark.createDataFrame([(w - (1 << 64) if w >> 63 else w,) for w in words], "fp long")
    assert S.links(prints, 4, len(words)).count() < 2 * len(words)


@pytest.mark.parametrize("minimum,width", [(4, 1), (4, 2), (4, 3), (4, 4), (5, 4), (8, 4), (1, 1)])
def test_covering(minimum, width):
    chosen = S.covering(minimum, width)
    assert all(any(set(c) <= set(m) for c in chosen) for m in combinations(range(8), minimum))


def test_keep_one(spark):
    data = edge_rows()
    kept = [r.doc_id for r in S.keep_one(edge_docs(spark)).collect()]
    least = {c for _, _, c in brute(data)}
    assert sorted(kept, key=repr) == sorted(least, key=repr)
    out = S.keep_one(clashing(edge_docs(spark)))
    assert out.count() == len(kept) and out.columns == clashing(edge_docs(spark)).columns


def test_empty_table_and_clashing_names(spark):
    assert S.near_duplicates(edge_docs(spark).limit(0)).collect() == []
    assert rows(S.near_duplicates(clashing(edge_docs(spark))), *COLS) == brute(edge_rows())


def test_bits_out_of_range(spark):
    with pytest.raises(ValueError):
        S.near_duplicates(edge_docs(spark), max_bits=8)
