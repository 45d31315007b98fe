import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from contentmart.llm import conversation_repair as C
from contentmart.llm.registry import op13_conversation_repair

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(turns):
    """Least (cost, audit) by best-first search over (turn, grammar state); turns are (initial, fault)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and state in ("", "a"):
            return cost, audit
        if len(audit) > 3 * len(turns) + 4:
            continue
        for role in "ua":
            if (state, role) in STEP:
                heapq.heappush(heap, (cost + 3, audit + "I", i, STEP[state, role]))
        if i < len(turns):
            initial, fault = turns[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if fault != "doomed":
                extra = 3 * (fault == "truncated")
                if (state, initial) in STEP:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, STEP[state, initial]))
                for role in "ua":
                    if (state, role) in STEP:
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, STEP[state, role]))


def plain_repair(conv):
    """The digest columns of one conversation, given its (turn, role, text) after damage."""
    conv = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in conv]
    conv.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in conv:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    initials = [r[1][:1] for r in conv]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest([(i, "doomed" if f in ("blank", "duplicate") else f) for i, f in zip(initials, faults)])
    out, rows, due, roles = [], iter(conv), "u", ""
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(rows)[1:]
        if edit == "D":
            continue
        role = role if edit == "K" else {"u": "user", "a": "assistant"}[due]
        out.append(f"{role}:{text}")
        roles += role[0]
        due = "a" if role[0] == "u" else "u"
    assert GRAMMAR.match(roles)
    turns = {t for t, *_ in conv if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate == 0:
            continue
        x = "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x
        out += [(c, t, "user" if fate == 4 else r, x)] * (2 if fate == 3 else 1)
    return out


def plain(rows, damaged=True):
    by = defaultdict(list, {r[0]: [] for r in rows})
    for c, *r in plain_damage(rows) if damaged else rows:
        by[c].append(tuple(r))
    return sorted(((c, *plain_repair(v)) for c, v in by.items()), key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_conversations(n, seed, longest=12):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        roles = rng.choice([["user", "assistant"], ["user", "assistant", "system"], ["assistant", "system", "tool", "user", None, ""]])
        for t in range(rng.randrange(0, longest)):
            text = rng.choice(["Yes.", "No!", "so", "well?", "", " \n", None, f"Item {t}.", f"cut {t}", "a."])
            out.append((c, rng.choice([t, t, t, t * 3, None]), rng.choice(roles), text))
    return out


def test_blocks_equal_search():
    rng = random.Random(1)
    for _ in range(3000):
        turns = [(rng.choice("suauaua?"), rng.choice(["", "", "", "truncated", "doomed"])) for _ in range(rng.randrange(0, 14))]
        codes = [4 * C.LETTERS.index(i) + ["", "truncated", "doomed"].index(f) for i, f in turns]
        want = cheapest(turns)
        for block in (1, 2, 3, 5, 100):
            repair = C.Repair(block)
            for code in codes:
                repair.add(code)
            assert repair.result() == want, (turns, block)


def test_long_conversations_by_blocks_and_whole():
    rng = random.Random(2)
    for n, wild in ((700, 0.1), (400, 0.9)):
        codes = [4 * (rng.randrange(4) if rng.random() < wild else 1 + i % 2) + rng.choice([0, 0, 0, 0, 0, 0, 1, 2]) for i in range(n)]
        found = []
        for block in (n, 64, 37):
            repair = C.Repair(block)
            for code in codes:
                repair.add(code)
            found.append(repair.result())
        assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("block", [2, 1024])
def test_random_conversations(spark, block):
    rows = random_conversations(300, 3)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert collected(C.repair_digests(df, block=block)) == plain(rows, damaged=False)
    assert collected(C.repair_digests(C.damage(df), ids=df, block=block)) == plain(rows)


def test_repaired_turns_have_the_digest(spark):
    rows = random_conversations(100, 4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by = defaultdict(list, {r[0]: [] for r in rows})
    for r in sorted(C.repair(df).collect(), key=lambda r: (r.conv_id, r.position)):
        assert r.position == len(by[r.conv_id])
        by[r.conv_id].append(f"{r.role}:{r.text}")
    want = {r.conv_id: r.repaired_sha256 for r in C.repair_digests(df).collect()}
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in by.items()} == want


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op13_conversation_repair(spark, "/root/testdata/sf0.01")) == plain(rows)


def test_hard_cases(spark):
    long = "word " * 50_000 + "."
    rows = [(1, 0, "user", long), (1, 1, "assistant", None), (None, 0, "user", "Hi."), (None, None, None, "x"), (2, None, "user", "a"), (2, None, "user", "a")]
    rows += [(3, t, "user", "Same.") for t in range(3000)] + [(4, 5, "assistant", "One.")] * 40 + [(5, -3, "Üser", "é."), (5, 9, "s", "\U0001f600!")]
    rows += [(6, 7, "assistant", "B."), (6, 7, "user", "A."), (7, 1, "", "A."), (8, 3, "user", " \x1c "), (8, 4, "user", "\x85.\x0b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    want = plain(rows)
    assert collected(C.repair_digests(C.damage(df), ids=df)) == want
    clashing = df.select("*", *[F.lit(1).alias(c) for c in ("kind", "digest", "Text", "n", "first", "fate", "audit")])
    assert collected(C.repair_digests(C.damage(clashing), ids=clashing)) == want
    empty = df.limit(0)
    assert collected(C.repair_digests(C.damage(empty), ids=empty)) == [] and collected(C.repair(empty)) == []
