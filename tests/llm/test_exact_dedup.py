import hashlib

import numpy as np
import pytest
from cases import clashing, edge_docs, edge_rows, rows
from pyspark.sql import functions as F

from contentmart.llm import exact_dedup as X

COLS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(data):
    def norm(t):
        return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")

    groups = {}
    for k, (i, t, *_) in enumerate(data):
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, k, i))
    out = []
    for n, members in groups.items():
        best = min(members, key=lambda m: m[:3])
        first = True
        for m in sorted(members):
            kept = first and m[:3] == best[:3]
            first = first and not kept
            out.append((m[4], best[4], len(members), kept, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_matches_brute_force(spark, batches):
    assert rows(X.dedup(edge_docs(spark), batches=batches), *COLS) == brute(edge_rows())


def test_equal_digests_are_told_apart_by_their_bytes(spark):
    weak = X.dedup(edge_docs(spark), digest=lambda n: F.pmod(F.length(n), F.lit(3)).cast("long"))
    assert rows(weak, *COLS) == brute(edge_rows())


def test_the_screen_decides(spark, monkeypatch):
    """Equal texts of two batches meet through the filters and nothing else; a filter that lets all through is no harm."""
    want = brute(edge_rows())
    monkeypatch.setattr(X, "screen", lambda incoming, filters, ranges: incoming.select("snapshot", "digest"))
    assert rows(X.dedup(edge_docs(spark), batches=3), *COLS) == want
    monkeypatch.setattr(X, "screen", lambda incoming, filters, ranges: incoming.select("snapshot", "digest").limit(0))
    alone = X.dedup(edge_docs(spark), batches=3).collect()
    assert sum(r.kept for r in alone) > sum(w[3] for w in want)
    assert max(r.group_size for r in alone) < max(w[2] for w in want)


def test_clashing_names_and_empty_table(spark):
    assert rows(X.dedup(clashing(edge_docs(spark))), *COLS) == brute(edge_rows())
    assert X.dedup(edge_docs(spark).limit(0)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 40_000])
def test_filter_has_no_false_negatives_and_few_false_positives(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    seed, seg, starts, table = X.build_fuse(keys)
    assert X.in_fuse(keys, seed, seg, starts, table).all()
    other = rng.integers(2**63, 2**64 - 1, 50_000, dtype=np.uint64)
    assert X.in_fuse(other, seed, seg, starts, table).mean() < 0.01
    if n > 10_000:
        assert len(table) < 1.3 * len(keys)
