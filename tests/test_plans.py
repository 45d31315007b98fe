"""Plan shape: pushdown, pruning, broadcast only under a checked size, no target shuffle."""

import pytest
from conftest import SF_SMALL

from contentmart import fixtures as fx
from contentmart import registry
from contentmart.operators import dims, facts
from contentmart.session import scratch_path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_delta_filter_reaches_the_parquet_scan(spark):
    df = registry.QUERIES["extract_delta"](spark, SF_SMALL)
    p = plan(df)
    assert "PushedFilters" in p and "GreaterThanOrEqual(o_orderdate" in p


def test_fact_scan_is_pruned_and_author_keys_broadcast(spark):
    p = plan(registry.QUERIES["fact_full_load"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    # orders has 6 columns; the fact reads four of them.
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in p


def test_author_keys_not_broadcast_over_the_limit(spark):
    a = fx.articles(spark, SF_SMALL)
    d = dims.dim_authors(fx.authors(spark, SF_SMALL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(facts.fact_full_load(a, d, broadcast_bytes=16))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p


@pytest.mark.parametrize("strategy,expect_smj", [("broadcast", False), ("shuffle", True)])
def test_merge_forms_over_a_stored_target(spark, strategy, expect_smj):
    path = scratch_path(spark, "plan-target")
    registry.QUERIES["fact_full_load"](spark, SF_SMALL).write.parquet(path)
    target = spark.read.parquet(path)
    source = registry.QUERIES["fact_delta_source"](spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only explicit hints may broadcast
    try:
        p = plan(facts.merge_fact(target, source, strategy, broadcast_bytes=10 << 20))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("SortMergeJoin" in p) == expect_smj
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    if not expect_smj:
        # The stored target is streamed through broadcast joins, never shuffled.
        target_scans = [line for line in p.splitlines() if "FileScan parquet" in line and "plan-target" in line]
        assert target_scans
        assert "Exchange hashpartitioning(__t_article_id" not in p


def test_a_bucketed_target_is_not_shuffled(spark):
    from contentmart import schemas
    from contentmart.operators import merge as M
    from contentmart.sources.publish import BucketedTable

    root = scratch_path(spark, "plan-bucketed")
    registry.QUERIES["fact_delta_source"](spark, SF_SMALL).write.parquet(f"{root}/delta")
    delta = spark.read.parquet(f"{root}/delta")
    table = BucketedTable(spark, f"{root}/fact", schemas.FACT_REPORTS_ARTICLES, "article_id", buckets=6)
    table.publish(registry.QUERIES["fact_full_load"](spark, SF_SMALL))
    merged = M.merge(table.read(), delta, facts.fact_merge_spec(), staged=True, buckets=6)
    merged.write.format("noop").mode("overwrite").save()
    p = plan(merged)
    join = p[p.index("SortMergeJoin") :].splitlines()
    target = next(i for i, line in enumerate(join) if "Bucketed: true" in line)
    source = next(i for i, line in enumerate(join) if "Exchange" in line)
    assert target < source and "repartition" in join[source].lower()  # the first exchange is the source's own
    want = sorted(facts.merge_fact(table.read(), delta, "shuffle").collect(), key=repr)
    again = BucketedTable(spark, f"{root}/fact", table.schema, "article_id")
    again.merge(delta, facts.fact_merge_spec(), tag="s#1")
    again.merge(delta, facts.fact_merge_spec(), tag="s#1")
    assert sorted(again.read().collect(), key=repr) == want and again.buckets == 6 and again.current_version() == 2


def test_no_cross_joins_anywhere(spark):
    skip = {"stream_incremental", "audit_counts", "full_load_fact", "incremental_load_fact", "full_refresh_idempotent", "backfill_chunked"}
    for name, q in registry.QUERIES.items():
        if name in skip:
            continue
        p = plan(q(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_live_filter_reaches_a_stored_articles_scan(spark):
    import seed

    path = scratch_path(spark, "stored-articles")
    seed.source(spark)["articles"].write.parquet(path)
    arts = spark.read.parquet(path)
    dim = seed.source(spark)["authors"].withColumnRenamed("id", "author_id")
    p = plan(facts.fact_full_load(arts, dim))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "stored-articles" in line][0]
    assert "IsNotNull(published_at)" in scan and "IsNull(deleted_at)" in scan
    assert "title" not in scan.split("ReadSchema")[1] and "content" not in scan.split("ReadSchema")[1]


def test_buckets_follow_the_size_of_table_and_source(spark, monkeypatch):
    """A bucket is a small part of a task's memory, also after merges that make the table many times larger."""
    import seed

    from contentmart import schemas
    from contentmart.operators import facts
    from contentmart.operators import merge as M
    from contentmart.operators.sizing import measure
    from contentmart.sources.publish import BucketedTable
    from contentmart.sources.staging import RunScratch

    src = seed.source(spark)
    fact = facts.fact_full_load(src["articles"], src["authors"].withColumnRenamed("id", "author_id"))
    assert 16 * BucketedTable.BUCKET_BYTES <= 1 << 30
    table = BucketedTable(spark, scratch_path(spark, "rebucketed"), schemas.FACT_REPORTS_ARTICLES, "article_id")
    monkeypatch.setattr(BucketedTable, "BUCKET_BYTES", measure(fact).bytes)
    table.publish(fact)
    assert table.buckets == 1
    more = spark.range(1000, 1400).selectExpr("id as article_id", "1L as author_id", "timestamp_ntz'2026-01-01' as published_at",
        "1L as article_count", "cast(null as timestamp_ntz) as deleted_at", "timestamp_ntz'2026-01-01' as created_at",
        "timestamp_ntz'2026-01-01' as updated_at")
    more = RunScratch(spark).keep(more, "more")
    want = sorted(M.merge(table.read(), more, facts.fact_merge_spec(), staged=True).collect(), key=repr)
    table.merge(more, facts.fact_merge_spec())
    assert sorted(table.read().collect(), key=repr) == want and len(want) == 420 and table.buckets > 10
    buckets = table.buckets
    table.merge(more, facts.fact_merge_spec())
    assert sorted(table.read().collect(), key=repr) == want and table.buckets == buckets
