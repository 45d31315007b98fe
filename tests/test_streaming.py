"""Streaming incremental load: restartable, replay-safe, equal to the batch path."""

import glob

import pytest
import seed
from pyspark.sql import functions as F

from contentmart.plans import jobs
from contentmart.session import scratch_path
from contentmart.sources import delimited, staging
from contentmart.sources.publish import Warehouse
from contentmart.sources.ranged import RangedWarehouse
from contentmart.streaming.incremental import _apply_batch, run_incremental_stream

FACT = jobs.FACT


def land(spark, landing, df, name):
    """Drop one more delimited file into the landing folder (committed atomically)."""
    delimited.write_delimited(staging.as_staged_text(df, "articles").coalesce(1), landing, mode="append")


@pytest.mark.parametrize("kind", [Warehouse, RangedWarehouse])
def test_stream_batches_survive_a_reload_in_between(spark, kind):
    root = scratch_path(spark, "streamtest")
    wh = kind(spark, f"{root}/wh") if kind is Warehouse else kind(spark, f"{root}/wh", width=8)
    src = seed.source(spark)
    jobs.full_load(spark, src, warehouse=wh)
    arts = src["articles"]
    landing, ckpt = f"{root}/landing", f"{root}/ckpt"

    # Batch 1: article 1 becomes a draft.
    land(spark, landing, arts.filter("id = 1").withColumn("published_at", F.lit(None).cast("timestamp_ntz")), "b1")
    run_incremental_stream(spark, landing, wh, ckpt)
    assert 1 not in {r[0] for r in wh.read(FACT).select("article_id").collect()}

    # A full reload in between takes new version numbers ...
    jobs.full_refresh(spark, src, warehouse=wh)
    assert wh.read(FACT).count() == 20
    # ... and the next batch (article 2 soft-deleted) must still be applied.
    land(spark, landing, arts.filter("id = 2").withColumn("deleted_at", F.col("updated_at")), "b2")
    run_incremental_stream(spark, landing, wh, ckpt)
    fact_ids = {r[0] for r in wh.read(FACT).select("article_id").collect()}
    assert 2 not in fact_ids and 1 in fact_ids and len(fact_ids) == 19


def test_replayed_batch_publishes_nothing(spark):
    root = scratch_path(spark, "replay")
    wh = RangedWarehouse(spark, f"{root}/wh", width=8)
    src = seed.source(spark)
    jobs.full_load(spark, src, warehouse=wh)
    batch = staging.as_staged_text(src["articles"].filter("id in (3, 31)"), "articles")
    apply = _apply_batch(wh, "auto", None, "stream:test")
    apply(batch, 5)
    versions = {n: t.current_version() for n, t in wh.tables.items()}
    apply(batch, 5)  # replay after a failure
    assert versions == {n: t.current_version() for n, t in wh.tables.items()}
    apply(batch, 6)  # a new batch id is applied again (same content: MERGE is idempotent)
    assert wh.tables[FACT].current_version() == versions[FACT] + 1
    assert sorted(wh.read(FACT).collect()) == sorted(jobs.full_load(spark, src).tables[FACT].collect())


def test_new_author_reaches_stream_and_feed(spark):
    """An article by an author the warehouse does not know: batch, stream and change feed agree."""
    root = scratch_path(spark, "newauthor")
    src = seed.source(spark)
    old = {"authors": src["authors"].filter("id != 10"), "articles": src["articles"]}
    new = src["articles"].filter("id = 1").withColumn("author_id", F.lit(10).cast("long"))
    want = sorted(jobs.incremental_load(spark, {"authors": src["authors"], "articles": new}, jobs.full_load(spark, old).tables,
                                        since="2000-01-01 00:00:00").tables[FACT].collect())
    assert any(r["author_id"] == 10 for r in want)
    wh = Warehouse(spark, f"{root}/stream")
    jobs.full_load(spark, old, warehouse=wh)
    land(spark, f"{root}/landing", new, "b1")
    run_incremental_stream(spark, f"{root}/landing", wh, f"{root}/ckpt", authors=src)
    assert sorted(wh.read(FACT).collect()) == want
    feed = new.withColumn("seq", F.lit(1)).withColumn("op", F.lit("U"))
    for kw in ({"authors": src["authors"]}, {"author_changes": src["authors"].withColumn("seq", F.lit(1)).withColumn("op", F.lit("U"))}):
        wh = RangedWarehouse(spark, scratch_path(spark, "feed"), width=8)
        jobs.full_load(spark, old, warehouse=wh)
        assert sorted(jobs.apply_article_changes(spark, feed, wh, **kw)[FACT].collect()) == want


def test_stream_equals_batch(spark):
    root = scratch_path(spark, "streameq")
    src = seed.source(spark)
    changed = src["articles"].filter("id >= 15").withColumn(
        "published_at", F.when(F.col("id") % 2 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("published_at"))
    )
    wh = RangedWarehouse(spark, f"{root}/wh", width=8)
    jobs.full_load(spark, src, warehouse=wh)
    land(spark, f"{root}/landing", changed, "all")
    run_incremental_stream(spark, f"{root}/landing", wh, f"{root}/ckpt")
    batch = jobs.incremental_load(
        spark, {"authors": src["authors"], "articles": changed}, jobs.full_load(spark, src).tables, since="2000-01-01 00:00:00"
    ).tables
    for name in ("dim_articles", FACT):
        assert sorted(wh.read(name).collect()) == sorted(batch[name].collect()), name


def test_clean_source_deletes_processed_files(spark):
    root = scratch_path(spark, "clean")
    wh = Warehouse(spark, f"{root}/wh")
    src = seed.source(spark)
    jobs.full_load(spark, src, warehouse=wh)
    landing = f"{root}/landing"
    for i in range(3):
        land(spark, landing, src["articles"].filter(F.col("id") == i + 1), f"b{i}")
    run_incremental_stream(spark, landing, wh, f"{root}/ckpt", max_files_per_trigger=1, clean_source="delete")
    left = glob.glob(f"{landing}/*.csv")
    assert len(left) <= 1  # one batch late: at most the last batch's file remains
    assert wh.read(FACT).count() == 20


def test_author_stream_merges_the_author_dimension(spark):
    root = scratch_path(spark, "authstream")
    wh = RangedWarehouse(spark, f"{root}/wh", width=8)
    src = seed.source(spark)
    jobs.full_load(spark, src, warehouse=wh)
    renamed = src["authors"].filter("id <= 3").withColumn("name", F.lit("renamed"))
    delimited.write_delimited(staging.as_staged_text(renamed, "authors"), f"{root}/landing")
    run_incremental_stream(spark, f"{root}/landing", wh, f"{root}/ckpt", table="authors")
    names = {r["author_id"]: r["name"] for r in wh.read("dim_authors").collect()}
    assert len(names) == 10 and [names[i] for i in (1, 2, 3)] == ["renamed"] * 3 and names[4] != "renamed"
    assert wh.read(FACT).count() == 20


def test_a_stream_sees_versions_written_by_another_process(spark):
    root = scratch_path(spark, "twowriters")
    src = seed.source(spark)
    stream_wh = RangedWarehouse(spark, f"{root}/wh", width=8)
    jobs.full_load(spark, src, warehouse=stream_wh)
    land(spark, f"{root}/landing", src["articles"].filter("id = 1").withColumn("deleted_at", F.col("updated_at")), "b1")
    run_incremental_stream(spark, f"{root}/landing", stream_wh, f"{root}/ckpt")
    # Another process (its own warehouse object) reloads everything meanwhile.
    jobs.full_refresh(spark, src, warehouse=RangedWarehouse(spark, f"{root}/wh", width=8))
    land(spark, f"{root}/landing", src["articles"].filter("id = 2").withColumn("deleted_at", F.col("updated_at")), "b2")
    run_incremental_stream(spark, f"{root}/landing", stream_wh, f"{root}/ckpt")
    ids = {r[0] for r in RangedWarehouse(spark, f"{root}/wh", width=8).read(FACT).select("article_id").collect()}
    assert 2 not in ids and 1 in ids and len(ids) == 19
