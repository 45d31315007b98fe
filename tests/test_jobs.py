"""Whole runs: one read of each source, declared constraints, audit, backfill reruns."""

import glob
import json

import pytest
import seed
from pyspark.sql import functions as F

from contentmart.operators.audit import RunAudit
from contentmart.operators.quality import ConstraintViolation
from contentmart.plans import jobs
from contentmart.session import ensure_checkpoint_dir, scratch_path
from contentmart.sources.extract import FileSource
from contentmart.sources.publish import Warehouse

FACT = jobs.FACT


def stored(spark, src):
    root = scratch_path(spark, "jobsrc")
    for name, df in src.items():
        df.write.parquet(f"{root}/{name}")
    return FileSource(root)


@pytest.fixture
def vanishing(monkeypatch):
    """Deletes a source folder as soon as the run has written its own copy of it."""
    from contentmart.sources import fs
    from contentmart.sources.staging import RunScratch

    keep, gone = RunScratch.keep, {}

    def keep_and_delete(self, df, name):
        out = keep(self, df, name)
        if name in gone:
            fs.delete(self.spark, gone.pop(name))
        return out

    monkeypatch.setattr(RunScratch, "keep", keep_and_delete)
    return gone


def test_each_source_table_is_read_once(spark, vanishing):
    """Every step after the copy works without the source."""
    src = seed.source(spark)
    wh = Warehouse(spark, scratch_path(spark, "once"))
    for load in (
        lambda source: jobs.full_load(spark, source, warehouse=wh),
        lambda source: jobs.incremental_load(spark, source, wh, since="2000-01-01 00:00:00"),
    ):
        source = stored(spark, src)
        vanishing.update({f"staged-{t}": f"{source.root}/{t}" for t in src})
        load(source)
        assert not vanishing and wh.read(FACT).count() == 20
    feed = scratch_path(spark, "feed")
    src["articles"].withColumn("seq", F.lit(1)).withColumn("op", F.when(F.col("id") < 4, "D").otherwise("U")).write.parquet(feed)
    vanishing["last-articles"] = feed
    jobs.apply_article_changes(spark, spark.read.parquet(feed), wh)
    assert not vanishing and wh.read(FACT).count() == 17
    source = stored(spark, src)
    vanishing.update({f"keys-{t}": f"{source.root}/{t}" for t in src})
    jobs.reconcile_hard_deletes(spark, source, wh)
    assert not vanishing and wh.read("dim_articles").count() == 27


def test_run_folders_are_deleted_after_publish(spark):
    base = ensure_checkpoint_dir(spark)
    wh = Warehouse(spark, scratch_path(spark, "clean"))
    before = set(glob.glob(f"{base}/contentmart-runs/*/*"))
    jobs.full_load(spark, seed.source(spark), warehouse=wh, staging=True)
    jobs.incremental_load(spark, seed.source(spark), wh, since="2000-01-01 00:00:00")
    assert set(glob.glob(f"{base}/contentmart-runs/*/*")) == before


def test_violations_stop_the_run_or_go_to_quarantine(spark):
    src = seed.source(spark)
    articles = src["articles"].withColumn(
        "title", F.when(F.col("id") == 3, F.lit(None)).when(F.col("id") == 4, F.repeat(F.lit("x"), 300)).otherwise(F.col("title"))
    )
    broken = {"authors": src["authors"], "articles": articles}
    wh = Warehouse(spark, scratch_path(spark, "violate"))
    with pytest.raises(ConstraintViolation):
        jobs.full_load(spark, broken, warehouse=wh)
    assert wh.read("dim_articles").count() == 0  # nothing was published
    result = jobs.full_load(spark, broken, warehouse=wh, on_violation="quarantine")
    got = {r["id"]: r["reason"] for r in result.quarantine["articles"].collect()}
    assert got == {"3": "title is null", "4": "title longer than 255"}
    assert wh.read("dim_articles").count() == 28
    with pytest.raises(ConstraintViolation):
        jobs.incremental_load(spark, broken, wh, since="2000-01-01 00:00:00")


def test_audit(spark):
    src = seed.source(spark)
    wh = Warehouse(spark, scratch_path(spark, "audit"))
    full = jobs.full_load(spark, src, warehouse=wh)
    assert full.audit.counts() == {"staging_authors": 10, "staging_articles": 30, "dim_authors": 10, "dim_articles": 30, FACT: 20}
    inc = jobs.incremental_load(spark, src, wh, since="2026-05-19 00:00:00")
    assert inc.audit.counts() == {"staging_authors": 10, "staging_articles": 10}
    assert jobs.full_load(spark, src).audit.counts() == {"staging_authors": 10, "staging_articles": 30}
    audit = RunAudit()
    audit.track(src["authors"], "unwritten")
    with pytest.raises(RuntimeError):
        audit.counts()


def test_fact_scan_of_a_load_has_both_filters(spark):
    """The staged copy that the fact is computed from is filtered in its scan."""
    result = jobs.full_load(spark, seed.source(spark))
    plan = result.tables[FACT]._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "deleted_at" in line)
    assert "IsNotNull(published_at)" in scan and "IsNull(deleted_at)" in scan


def test_backfill_reruns(spark):
    src = seed.source(spark)
    late = src["articles"].filter("id = 2")
    articles = src["articles"].filter("id != 2")
    spread = articles.withColumn("published_at", F.col("published_at") + F.make_ym_interval(F.lit(0), F.col("id").cast("int")))
    dim = src["authors"].withColumnRenamed("id", "author_id")
    sink = scratch_path(spark, "backfill")
    want = sorted(jobs.backfill_fact(spark, spread, dim).collect())
    assert sorted(jobs.backfill_fact(spark, spread, dim, months=6, sink=sink).collect()) == want
    assert sorted(jobs.backfill_fact(spark, spread, dim, months=12, sink=sink).collect()) == want
    before = json.load(open(sorted(glob.glob(f"{sink}/_pointer/*.json"))[-1]))
    assert sorted(jobs.backfill_fact(spark, spread, dim, months=12, sink=sink).collect()) == want
    assert json.load(open(sorted(glob.glob(f"{sink}/_pointer/*.json"))[-1])) == before  # nothing to do
    more = spread.unionByName(late)
    assert len(jobs.backfill_fact(spark, more, dim, months=12, sink=sink).collect()) == len(want) + 1
    after = json.load(open(sorted(glob.glob(f"{sink}/_pointer/*.json"))[-1]))
    assert sum(before["parts"][k] == after["parts"].get(k) for k in before["parts"]) >= len(before["parts"]) - 1
    assert sum(after["parts"][k] != before["parts"].get(k) for k in after["parts"]) == 1
