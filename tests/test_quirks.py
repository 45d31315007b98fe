"""One case per behavioural quirk kept on purpose."""

import datetime as dt

import pytest
import seed
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contentmart import schemas
from contentmart.operators import casts, dims, facts
from contentmart.plans import jobs
from contentmart.session import scratch_path
from contentmart.sources import delimited, staging

FACT = jobs.FACT


def test_q1_authors_travel_whole_in_a_delta_run(spark):
    src = seed.source(spark)
    first = jobs.full_load(spark, src).tables
    renamed = src["authors"].withColumn("name", F.concat(F.col("name"), F.lit(" (new)")))
    # Author change stamps are all before the threshold, yet every author is merged.
    out = jobs.incremental_load(spark, {"authors": renamed, "articles": src["articles"]}, first, since="2026-05-20 00:00:00")
    names = [r[0] for r in out.tables["dim_authors"].select("name").collect()]
    assert len(names) == 10 and all(n.endswith("(new)") for n in names)
    # With a change column the authors follow the threshold too.
    out2 = jobs.incremental_load(
        spark, {"authors": renamed, "articles": src["articles"]}, first, since="2026-05-20 00:00:00", author_ts_col="updated_at"
    )
    assert "dim_authors" in out2.skipped


def test_q3_orphans_dropped_by_full_load_kept_by_incremental(spark):
    src = seed.source(spark)
    authors = src["authors"].filter(F.col("id") != 1)  # articles 1, 11, 21 become orphans
    full = jobs.full_load(spark, {"authors": authors, "articles": src["articles"]}).tables
    assert 1 not in {r[0] for r in full[FACT].select("article_id").collect()}
    empty = jobs.init_warehouse(spark)
    inc = jobs.incremental_load(spark, {"authors": authors, "articles": src["articles"]}, empty, since="2000-01-01 00:00:00").tables
    row = inc[FACT].filter("article_id = 1").first()
    assert row is not None and row["author_id"] is None


def test_q5_update_column_lists_differ(spark):
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
    dim = spark.createDataFrame([(1, "a", "a@x", t0, t0)], schemas.DIM_AUTHORS)
    staged = spark.createDataFrame([(1, "a", "a@x", t1, t1)], schemas.SOURCE_AUTHORS)
    assert dims.merge_dim_authors(dim, staged).first()["created_at"] == t1  # dims overwrite created_at
    fact = spark.createDataFrame([(1, 1, 20260101, 1, t0, t0)], schemas.FACT_REPORTS_ARTICLES)
    src = spark.createDataFrame(
        [(1, 1, t1, 1, None, t1, t1)],
        "article_id long, author_id long, published_at timestamp_ntz, article_count long, deleted_at timestamp_ntz, "
        "created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    row = facts.merge_fact(fact, src).first()
    assert row["created_at"] == t0 and row["updated_at"] == t1  # the fact keeps created_at


def test_q9_header_only_file_loads_zero_rows_and_skips(spark):
    src = seed.source(spark)
    first = jobs.full_load(spark, src).tables
    area = staging.StagingArea(spark)
    staged = area.replace("articles", src["articles"].limit(0))
    assert staged.count() == 0
    out, skipped = jobs.apply_delta(spark, first, None, casts.typed_ids(staged, ("id", "author_id")))
    assert "dim_articles" in skipped and FACT in skipped
    assert out[FACT].count() == 20


def test_q12_bad_id_text_fails_or_is_quarantined(spark):
    df = spark.createDataFrame([("1", "x"), ("abc", "y")], "id string, title string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        casts.typed_ids(df).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:  # the failure does not depend on ANSI mode
        with pytest.raises((PySparkException, Py4JJavaError), match="CAST_INVALID_INPUT"):
            casts.typed_ids(df).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    good, bad = casts.split_bad_ids(df)
    assert [tuple(r) for r in good.collect()] == [(1, "x")]
    assert [tuple(r) for r in bad.collect()] == [("abc", "y")]


def test_q13_ids_group_after_the_cast(spark):
    path = scratch_path(spark, "q13")
    rows = [
        ("1", "t", None, dt.datetime(2026, 5, 1), "1", None, None, None),
        ("01", "t", None, dt.datetime(2026, 5, 1), "1", None, None, None),
    ]
    delimited.write_delimited(spark.createDataFrame(rows, schemas.STAGING_ARTICLES), path)
    staged = casts.typed_ids(delimited.read_delimited(spark, path, schemas.STAGING_ARTICLES), ("id", "author_id"))
    dim = spark.createDataFrame([(1, "a", "a@x", None, None)], schemas.DIM_AUTHORS)
    fact = facts.fact_full_load(staged, dim).collect()
    assert len(fact) == 1 and fact[0]["article_id"] == 1 and fact[0]["article_count"] == 2
