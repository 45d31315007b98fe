"""Identity keys, change stamps, reconciliation and constraint checks."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contentmart import schemas
from contentmart.functions.dates import ntz_literal
from contentmart.operators import dims, keys, quality, reconcile
from contentmart.operators import merge as M


def test_identity_matches_row_number_and_survives_a_hot_key(spark):
    # A third of the rows share one natural key: the tie-breaker spreads them.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%05d", F.col("id"))).alias("nk"),
        F.col("id").alias("payload"),
    )
    got = keys.assign_identity(df, ["nk"], start_after=100, partitions=6)
    assert got.count() == 3000
    stats = got.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(stats) == (101, 3100, 3000)
    # Distinct natural keys get ids in natural-key order.
    firsts = got.groupBy("nk").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    w = Window.orderBy("nk")
    ordered = firsts.withColumn("prev_hi", F.lag("hi").over(w)).filter(F.col("prev_hi") >= F.col("lo"))
    assert ordered.count() == 0


def test_high_water(spark):
    empty = spark.createDataFrame([], schemas.SOURCE_AUTHORS)
    assert keys.high_water(empty) == 1
    three = spark.range(1, 4)
    assert keys.high_water(three) == 3


def test_stamped_update_sets_change_time_on_every_update(spark):
    target = spark.createDataFrame([(1, "a", "a@x", None, None)], schemas.DIM_AUTHORS)
    src = spark.createDataFrame([(1, "a", "a@x", None, None), (2, "b", "b@x", None, None)], schemas.SOURCE_AUTHORS)
    spec = keys.stamped(dims.authors_upsert_spec(), "updated_at", ntz_literal("2030-01-01 00:00:00"))
    rows = {r["author_id"]: r for r in M.merge(target, src, spec).collect()}
    assert rows[1]["updated_at"] == dt.datetime(2030, 1, 1)  # even an unchanged row
    assert rows[2]["updated_at"] is None  # inserts keep the given value


def test_cascading_reset(spark):
    a = spark.range(3)
    b = spark.range(5)
    ra, rb = keys.cascading_reset(a, b)
    assert ra.count() == 0 and rb.count() == 0 and ra.schema == a.schema


def test_hard_delete_split_is_a_partition_of_the_target(spark):
    target = spark.range(0, 100).select(F.col("id").alias("article_id"))
    source = spark.range(50, 150).union(spark.range(60, 61)).select(F.col("id").alias("id"))
    kept = reconcile.hard_delete_kept(target, "article_id", source, "id")
    removed = reconcile.hard_delete_removed(target, "article_id", source, "id")
    assert kept.count() == 50 and removed.count() == 50
    assert kept.join(removed, "article_id").count() == 0


def test_cdc_last_change_wins(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "id long, title string, author_id long")
    changes = spark.createDataFrame(
        [
            (1, "a1", 1, 1, "U"),
            (1, "a2", 1, 2, "D"),  # last change deletes
            (2, "b1", 2, 2, "U"),
            (2, "b0", 2, 1, "D"),  # older delete loses
            (4, "d", 4, 1, "U"),  # new key inserted
            (5, "e", 5, 1, "D"),  # delete of unknown key: nothing
        ],
        "id long, title string, author_id long, seq int, op string",
    )
    out = sorted(tuple(r) for r in reconcile.cdc_apply(target, changes, "id", "id", "seq", ["title", "author_id"]).collect())
    assert out == [(2, "b1", 2), (3, "c", 1), (4, "d", 4)]


def test_checks(spark):
    authors = spark.createDataFrame(
        [(1, "A", "a@x", None, None), (1, "B" * 300, "b@x", None, None), (2, "C", "a@x", None, None)],
        schemas.SOURCE_AUTHORS,
    )
    assert [tuple(r) for r in quality.check_unique(authors, "id").collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.check_unique(authors, ["email"]).collect()] == [("a@x", 2)]
    long_rows = quality.check_length(authors, {"name": 255}, key="id").collect()
    assert [(r["id"], r["length"]) for r in long_rows] == [(1, 300)]
    report = {r["column"]: r for r in quality.length_report(authors, {"name": 255, "email": 255}).collect()}
    assert report["name"]["violations"] == 1 and report["email"]["max_length"] == 3
    articles = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "id long, author_id long")
    orphans = quality.check_foreign_key(articles, "author_id", authors, "id")
    assert [r["id"] for r in orphans.collect()] == [11]
    nulls = quality.check_not_null(articles, ["author_id"], key="id")
    assert [tuple(r) for r in nulls.collect()] == [(12, "author_id")]
    good, bad = quality.split_valid(authors, not_null=["name"], limits={"name": 255})
    assert good.count() == 2 and bad.count() == 1


def test_apply_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "article_id long, article_count long")
    out = quality.apply_defaults(df, {"article_count": 1})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1), (2, 5)]
