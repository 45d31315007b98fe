import math
from collections import defaultdict

import pytest
from cases import clashing, edge_docs, edge_rows, low_words

from contentmart.llm import mixing as M


def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("source != 'src1' or doc_id % 3 = 0")


def tokens(rows):
    out = defaultdict(int)
    for r in rows:
        out[r.source] += len(low_words(r.text))
    return out


def weights(tok, a):
    total = sum(tok.values())
    p = {s: math.exp(math.log(n / total) * a) for s, n in tok.items() if n}
    z = sum(p.values())
    return {s: x / z for s, x in p.items()}


@pytest.mark.parametrize("limit", [{"max_repetition": 1.2}, {"target_entropy": 2.98}, {"max_repetition": 1.05}, {}])
def test_weights_meet_the_limit_and_uses_fill_the_budget(spark, limit):
    rows = table(spark).collect()
    tok, budget = tokens(rows), 300_000
    got = M.mix(table(spark), budget=budget, docs_per_block=7, **limit).collect()
    a = got[0].exponent
    w = weights(tok, a)
    entropy = -sum(x * math.log(x) for x in w.values())
    most = max(x * budget / tok[s] for s, x in w.items())
    if "max_repetition" in limit:
        assert most <= limit["max_repetition"] + 1e-6
        if a > 0:  # a smaller exponent would break the limit
            v = weights(tok, max(0, a - 1e-4))
            assert max(x * budget / tok[s] for s, x in v.items()) > limit["max_repetition"]
    if "target_entropy" in limit:
        assert abs(entropy - limit["target_entropy"]) < 1e-4
    size = {r.doc_id: len(low_words(r.text)) for r in rows}
    longest = defaultdict(int)
    for r in rows:
        longest[r.source] = max(longest[r.source], size[r.doc_id])
    used, uses = defaultdict(int), defaultdict(lambda: defaultdict(list))
    for r in got:
        assert r.n_tokens == size[r.doc_id] and abs(r.weight - w[r.source]) < 1e-9
        used[r.source] += r.n_tokens
        uses[r.source][r.doc_id].append(getattr(r, "pass"))
    for s, x in w.items():
        quota = math.floor(x * budget + 0.5)
        assert quota <= used[s] < quota + longest[s] + 1  # the last document may run over
        ids = {r.doc_id for r in rows if r.source == s}
        whole = quota // tok[s]
        for i in ids:  # whole permutations, then a part of one more
            assert sorted(uses[s].get(i, [])) in ([*range(whole)], [*range(whole + 1)])


def test_hard_cases(spark):
    docs = edge_docs(spark)
    got = M.mix(clashing(docs)).collect()
    # Exponent 1 and the corpus's own budget: every document once, those without tokens included
    # where their source has others; the exact rule is one whole pass.
    assert sorted((repr(r.doc_id) for r in got)) == sorted(repr(i) for i, *_ in edge_rows())
    assert M.mix(docs.limit(0)).collect() == []
    again = M.mix(docs, budget=10**6, max_repetition=2.0).collect()
    assert max(getattr(r, "pass") for r in again) >= 1


def test_one_source(spark):
    one = table(spark).filter("source = 'src0'")
    got = M.mix(one, budget=10**5, max_repetition=1.0).collect()
    assert got and {r.weight for r in got} == {1.0}
