"""One case per MERGE branch, in both physical forms."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contentmart import schemas
from contentmart.operators import facts
from contentmart.operators import merge as M

STRATEGIES = ["broadcast", "shuffle", "auto"]
T0 = dt.datetime(2026, 1, 1, 8, 0)
T1 = dt.datetime(2026, 2, 1, 8, 0)


def fact_target(spark):
    rows = [
        (1, 10, 20260101, 1, T0, T0),
        (2, 10, 20260101, 1, T0, T0),
        (3, 11, 20260101, 1, T0, T0),
    ]
    return spark.createDataFrame(rows, schemas.FACT_REPORTS_ARTICLES)


SOURCE_SCHEMA = (
    "article_id long, author_id long, published_at timestamp_ntz, article_count long, "
    "deleted_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
)


def source_rows():
    return [
        (1, 10, T1, 1, None, T1, T1),  # matched, live -> update, created_at kept
        (2, 10, None, 1, None, T1, T1),  # matched, draft -> delete
        (4, None, T1, 1, None, T1, T1),  # not matched, live, unknown author -> insert
        (5, 12, T1, 1, T1, T1, T1),  # not matched, soft-deleted -> nothing
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_fact_merge_branches(spark, strategy):
    src = spark.createDataFrame(source_rows(), SOURCE_SCHEMA)
    out = {r["article_id"]: r for r in facts.merge_fact(fact_target(spark), src, strategy).collect()}
    assert sorted(out) == [1, 3, 4]
    assert out[1]["published_date_at"] == 20260201
    assert out[1]["created_at"] == T0 and out[1]["updated_at"] == T1
    assert out[3]["updated_at"] == T0
    assert out[4]["author_id"] is None and out[4]["created_at"] == T1


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_action_counts(spark, strategy):
    src = spark.createDataFrame(source_rows(), SOURCE_SCHEMA)
    counts = dict(M.merge_action_counts(fact_target(spark), src, facts.fact_merge_spec(), strategy).collect())
    assert counts == {"update": 1, "delete": 1, "keep": 1, "insert": 1, "skip": 1}


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_cardinality_violation(spark, strategy):
    rows = source_rows() + [(3, 10, T1, 1, None, T1, T1), (3, 11, T1, 1, None, T1, T1)]
    src = spark.createDataFrame(rows, SOURCE_SCHEMA)
    with pytest.raises(PySparkException, match="MERGE_CARDINALITY_VIOLATION"):
        facts.merge_fact(fact_target(spark), src, strategy).collect()


def test_conflicts_listed(spark):
    rows = source_rows() + [(3, 10, T1, 1, None, T1, T1), (3, 11, T1, 1, None, T1, T1), (9, 1, T1, 1, None, T1, T1), (9, 2, T1, 1, None, T1, T1)]
    src = spark.createDataFrame(rows, SOURCE_SCHEMA)
    got = M.merge_conflicts(fact_target(spark), src, facts.fact_merge_spec()).collect()
    assert [(r[0], r[1]) for r in got] == [(3, 2)]  # key 9 repeats but matches nothing


SIMPLE = "k long, v string"


def upsert_spec(cond=None):
    return M.MergeSpec(
        "k",
        "k",
        when_matched=(M.update({"v": M.src("v")}, cond),),
        when_not_matched=(M.insert({"k": M.src("k"), "v": M.src("v")}),),
    )


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_and_repeated_unmatched_keys_are_inserted(spark, strategy):
    target = spark.createDataFrame([(1, "a"), (2, "b")], SIMPLE)
    src = spark.createDataFrame([(None, "n1"), (None, "n2"), (7, "x"), (7, "y"), (2, "B")], SIMPLE)
    got = sorted(M.merge(target, src, upsert_spec(), strategy).collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [tuple(r) for r in got] == [(1, "a"), (2, "B"), (7, "x"), (7, "y"), (None, "n1"), (None, "n2")]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_first_true_clause_wins_and_unmatched_clause_keeps(spark, strategy):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], SIMPLE)
    src = spark.createDataFrame([(1, "del"), (2, "upd"), (3, "none")], SIMPLE)
    spec = M.MergeSpec(
        "k",
        "k",
        when_matched=(
            M.delete(M.src("v") == "del"),
            M.update({"v": F.upper(M.src("v"))}, M.src("v") == "upd"),
            M.update({"v": F.lit("never")}, M.src("v") == "upd"),
        ),
    )
    got = sorted(tuple(r) for r in M.merge(target, src, spec, strategy).collect())
    assert got == [(2, "UPD"), (3, "c")]


def test_empty_source_returns_target(spark):
    target = spark.createDataFrame([(1, "a")], SIMPLE)
    src = spark.createDataFrame([], SIMPLE)
    assert [tuple(r) for r in M.merge(target, src, upsert_spec()).collect()] == [(1, "a")]


def test_forms_agree_on_generated_data(spark):
    target = spark.range(0, 5000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    src = spark.range(2500, 9000, 3).select(F.col("id").alias("k"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("v"))
    spec = upsert_spec(M.src("k") % 2 == 0)
    a = sorted(M.merge(target, src, spec, "broadcast").collect())
    b = sorted(M.merge(target, src, spec, "shuffle").collect())
    assert a == b and len(a) == 5000 + len(range(5002, 9000, 3))


def test_spec_validation(spark):
    target = spark.createDataFrame([(1, "a")], SIMPLE)
    src = spark.createDataFrame([(1, "b")], SIMPLE)
    bad_column = M.MergeSpec("k", "k", when_matched=(M.update({"nope": M.src("v")}),))
    with pytest.raises(ValueError, match="nope"):
        M.merge(target, src, bad_column, "broadcast")
    misplaced = M.MergeSpec("k", "k", when_matched=(M.insert({"k": M.src("k")}),))
    with pytest.raises(ValueError):
        M.merge(target, src, misplaced, "broadcast")
    with pytest.raises(ValueError, match="key"):
        M.merge(target, src, M.MergeSpec("id", "k"), "broadcast")
