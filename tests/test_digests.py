"""Hard deletes by digests of key ranges, against the comparison of all keys."""

import pytest
from pyspark.sql import functions as F

from contentmart.operators import digests
from contentmart.operators.reconcile import hard_delete_removed
from contentmart.session import scratch_path
from contentmart.sources.extract import JdbcSource

SMALL = {"ranges": 8, "fanout": 4, "leaf": 16}


def stored(spark, ids):
    path = scratch_path(spark, "digests")
    ids = spark.createDataFrame([(i, f"t{i}") for i in ids], "article_id long, title string")
    ids.coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def same(spark, target, source, **sizes):
    want = hard_delete_removed(target, "article_id", source, "id")
    got = digests.removed_by_digest(target, "article_id", source, **sizes)
    assert got.schema == target.schema
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    return got


CASES = {
    "few left": (range(5000), [i for i in range(5000) if i not in (0, 77, 4999)]),
    "all left": (range(300), []),
    "none left": (range(1000), range(1000)),
    "new keys beyond and between": (range(0, 2000, 2), [*range(-50, 2200, 2), *range(1, 99, 2)]),
    "swapped in one range": (range(0, 400, 2), [i + (i in (2, 6, 10)) for i in range(0, 400, 2)]),
    "negative keys": (range(-700, 700), [i for i in range(-700, 700) if i % 100]),
    "repeats on either side": ([1, 1, 2, 3, 3, 900], [1, 2, 2, 3]),
    "no key": ([None, 1, 5, None], [1]),
    "only nulls": ([None], [1]),
    "empty target": ([], [1, 2]),
    "far apart": ([-(2**40), 3, 2**40, 2**40 + 1], [3, 2**40]),
    "one key": ([7], [7]),
}


@pytest.mark.parametrize("case", CASES)
def test_same_rows_as_the_comparison_of_keys(spark, case):
    ours, theirs = CASES[case]
    source = spark.createDataFrame([(i,) for i in theirs], "id long").coalesce(2)
    same(spark, stored(spark, ours), source, **({} if case == "few left" else SMALL))


def test_only_ranges_that_differ_are_left(spark):
    target = stored(spark, range(10_000))
    source = spark.range(10_000).filter("id not in (3, 5000)")
    cut = digests.KeyRanges(0, 9_999, **SMALL)
    assert cut.width == 4096
    sides = digests._FrameSide(target, "article_id", 1 << 20), digests._FrameSide(source, "id", 1 << 20)
    numbers = digests.differing_ranges(*sides, cut)
    assert cut.width == 16 and sorted(numbers) == [3 // 16, 5000 // 16]
    plan = same(spark, target, source, **SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_ranges_are_not_cut_finer_when_too_many_differ(spark, monkeypatch):
    monkeypatch.setattr(digests, "RANGES", 2)
    target = stored(spark, range(3000))
    same(spark, target, spark.range(3000).filter(F.col("id") % 50 != 0), **SMALL)


def test_a_database_adds_up_its_own_digests(spark):
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "preferTimestampNTZ": "true"}
    src = JdbcSource("jdbc:derby:memory:contentmart_digests;create=true", properties=props)
    ids = [*range(-300, 3000), *range(1_000_000, 1_000_400), 2**33, 2**33 + 5]
    for kind, keys in (("long", ids), ("int", ids[:-2])):
        rows = [(i,) for i in keys if i not in (-300, 17, 1_000_399)]
        table = f"KEYS_{kind.upper()}"
        spark.createDataFrame(rows, f"id {kind}").write.jdbc(src.url, table, mode="overwrite", properties=props)
        target = stored(spark, keys)
        theirs = digests._JdbcSide(spark, src, table, "id")
        cut = digests.KeyRanges(min(keys), max(keys), **SMALL)
        frame = digests._FrameSide(spark.createDataFrame(rows, "id long"), "id", 1 << 20)
        assert sorted(theirs.digests(cut, cut, None).collect()) == sorted(frame.digests(cut, cut, None).collect())
        got = digests.removed_by_digest(target, "article_id", src, table, "id", **SMALL)
        assert sorted(r.article_id for r in got.collect()) == [-300, 17, 1_000_399]
        pulled = theirs.pull(cut, digests.differing_ranges(digests._FrameSide(target, "article_id", 1 << 20), theirs, cut))
        assert pulled.count() <= 3 * SMALL["leaf"]
