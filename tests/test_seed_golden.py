"""Golden cases on the seed-shaped fixture (expected values derived by hand)."""

import seed
from pyspark.sql import functions as F

from contentmart.operators import calendar
from contentmart.plans import jobs
from contentmart.sources.extract import extract_delta
from contentmart.sources.publish import Warehouse
from contentmart.session import scratch_path

FACT = jobs.FACT


def ids(df, col):
    return sorted(r[0] for r in df.select(col).collect())


def test_full_load_counts(spark):
    result = jobs.full_load(spark, seed.source(spark))
    t = result.tables
    assert t["dim_authors"].count() == 10
    assert t["dim_articles"].count() == 30
    assert ids(t[FACT], "article_id") == list(range(1, 21))
    assert {r[0] for r in t[FACT].select("article_count").distinct().collect()} == {1}
    assert t[FACT].select("published_date_at").distinct().count() == 19


def test_drafts_and_deletes_stay_in_dim_not_in_fact(spark):
    t = jobs.full_load(spark, seed.source(spark)).tables
    dim_ids = set(ids(t["dim_articles"], "article_id"))
    fact_ids = set(ids(t[FACT], "article_id"))
    for i in seed.DRAFTS | seed.DELETED:
        assert i in dim_ids and i not in fact_ids


def test_delta_windows(spark):
    articles = seed.source(spark)["articles"]
    live = F.col("published_at").isNotNull() & F.col("deleted_at").isNull()
    cases = {
        "2026-05-18 00:00:00": (list(range(18, 31)), [18, 19, 20]),
        "2026-05-19 00:00:00": ([19, 20] + list(range(23, 31)), [19, 20]),
        "2026-05-20 09:00:00": ([20, 27, 28, 29, 30], [20]),
    }
    for since, (rows, live_ids) in cases.items():
        d = extract_delta(articles, "updated_at", since)
        assert ids(d, "id") == rows, since
        assert ids(d.filter(live), "id") == live_ids, since


def test_full_then_any_delta_is_idempotent(spark):
    src = seed.source(spark)
    first = jobs.full_load(spark, src).tables
    before = sorted(first[FACT].collect())
    for since in ("2026-05-18 00:00:00", "2026-05-19 00:00:00", "2026-05-20 09:00:00"):
        after = jobs.incremental_load(spark, src, first, since=since).tables
        assert sorted(after[FACT].collect()) == before, since
        assert after["dim_articles"].count() == 30


def test_incremental_with_warehouse_and_staging(spark):
    src = seed.source(spark)
    wh = Warehouse(spark, scratch_path(spark, "seedwh"))
    jobs.full_load(spark, src, warehouse=wh, staging=True)
    before = sorted(wh.read(FACT).collect())
    out = jobs.incremental_load(spark, src, wh, since="2026-05-18 00:00:00", staging=True)
    assert sorted(out.tables[FACT].collect()) == before
    assert out.skipped == []


def test_empty_delta_skips_merges(spark):
    src = seed.source(spark)
    first = jobs.full_load(spark, src).tables
    out = jobs.incremental_load(spark, src, first, since="2027-01-01 00:00:00")
    assert "dim_articles" in out.skipped and FACT in out.skipped
    assert out.tables[FACT].count() == 20


def test_dim_date_default_calendar(spark):
    d = calendar.dim_date(spark)
    assert d.count() == 5479
    row = d.agg(F.min("published_date_at"), F.max("published_date_at")).first()
    assert (row[0], row[1]) == (20160101, 20301231)
    q = d.filter(F.col("published_date_at") == 20240229).first()
    assert (q["day"], q["month"], q["year"], q["quarter"]) == (29, 2, 2024, 1)


def test_init_warehouse_tables(spark):
    wh = Warehouse(spark, scratch_path(spark, "initwh"))
    tables = jobs.init_warehouse(spark, wh)
    assert tables["dim_date"].count() == 5479
    for name in ("dim_authors", "dim_articles", FACT):
        assert tables[name].count() == 0
        assert [f.name for f in tables[name].schema] == [f.name for f in wh.tables[name].schema]


def test_delta_twice_equals_once(spark):
    src = seed.source(spark)
    first = jobs.full_load(spark, src).tables
    # Change a few articles in the source, then apply the same delta twice.
    changed = src["articles"].withColumn(
        "deleted_at", F.when(F.col("id").isin(3, 4), F.col("updated_at")).otherwise(F.col("deleted_at"))
    )
    later = {"authors": src["authors"], "articles": changed}
    once = jobs.incremental_load(spark, later, first, since="2026-05-01 00:00:00").tables
    twice = jobs.incremental_load(spark, later, once, since="2026-05-01 00:00:00").tables
    for name in ("dim_articles", FACT):
        assert sorted(once[name].collect()) == sorted(twice[name].collect()), name
    assert 3 not in ids(once[FACT], "article_id") and once[FACT].count() == 18


def test_incremental_from_empty_equals_full_load(spark):
    # No orphans and no repeated ids: the two fact rules agree (Q3, Q4).
    src = seed.source(spark)
    empty = jobs.init_warehouse(spark)
    inc = jobs.incremental_load(spark, src, empty, since="2000-01-01 00:00:00").tables
    full = jobs.full_load(spark, src).tables
    for name in ("dim_authors", "dim_articles", FACT):
        assert sorted(inc[name].collect()) == sorted(full[name].collect()), name


def test_incremental_with_a_large_delta_takes_the_shuffle_path(spark):
    # Broadcast limit 1 byte: every merge takes the shuffle form and the fact
    # source is materialized once; the result must not change.
    src = seed.source(spark)
    first = jobs.full_load(spark, src).tables
    small = jobs.incremental_load(spark, src, first, since="2026-05-18 00:00:00").tables
    large = jobs.incremental_load(spark, src, first, since="2026-05-18 00:00:00", broadcast_bytes=1).tables
    for name in ("dim_authors", "dim_articles", FACT):
        assert sorted(small[name].collect()) == sorted(large[name].collect()), name


def test_backfill_is_restartable(spark):
    import glob
    import os

    src = seed.source(spark)
    dim = src["authors"].withColumnRenamed("id", "author_id")
    sink = scratch_path(spark, "backfill")
    first = sorted(jobs.backfill_fact(spark, src["articles"], dim, months=1, sink=sink).collect())
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{sink}/data/*/__chunk=*/*.parquet")}
    assert files and len(first) == 20
    again = sorted(jobs.backfill_fact(spark, src["articles"], dim, months=1, sink=sink).collect())
    assert again == first
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{sink}/data/*/__chunk=*/*.parquet")} == files  # nothing rewritten
