"""A key holding a third of the rows: results stay exact and AQE splits the hot partition."""

import pytest
from pyspark.sql import functions as F

from contentmart.operators import facts
from contentmart.operators import merge as M

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df) -> tuple[list, str]:
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_author_is_split_and_exact(skew_session):
    spark = skew_session
    n = 30000
    ts = F.expr("timestamp_ntz'2020-01-01 00:00:00'")
    arts = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000 + 2).alias("author_id"),
        (ts + F.make_dt_interval(F.col("id") % 1000)).alias("published_at"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
    )
    dim = spark.range(1, 6000).select(F.col("id").alias("author_id"))
    rows, plan = final_plan(facts.fact_full_load(arts, dim, broadcast_bytes=-1))
    assert len(rows) == n and {r["article_count"] for r in rows} == {1}
    assert sum(1 for r in rows if r["author_id"] == 1) == n // 3
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_unmatched_source_key_in_shuffle_merge(skew_session):
    spark = skew_session
    target = spark.range(0, 20000).select(F.col("id").alias("k"), F.lit("t").alias("v"))
    src = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id") + 10000).alias("k"), F.lit("s").alias("v")
    )
    spec = M.MergeSpec("k", "k", when_matched=(M.update({"v": M.src("v")}),), when_not_matched=(M.insert({"k": M.src("k"), "v": M.src("v")}),))
    rows, plan = final_plan(M.merge(target, src, spec, "shuffle", hot_rows=1000))
    keys = [-7 if i % 3 == 0 else i + 10000 for i in range(30000)]
    inserted = sum(1 for k in keys if not 0 <= k < 20000)
    assert len(rows) == 20000 + inserted
    assert sum(1 for r in rows if r["k"] == -7) == 10000  # every copy of the hot unmatched key
    assert sum(1 for r in rows if r["v"] == "s" and 0 <= r["k"] < 20000) == sum(1 for k in keys if 0 <= k < 20000)
    # The one join of target and source is keyed on (key, salt): the hot key's rows are spread over tasks.
    full = [line for line in plan.splitlines() if "SortMergeJoin" in line and "FullOuter" in line]
    assert full and all("__ss" in line for line in full)


def test_hot_author_in_the_delta_source_is_split_and_exact(skew_session):
    spark = skew_session
    n = 30000
    ts = F.expr("timestamp_ntz'2020-01-01 00:00:00'")
    arts = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000 + 2).alias("author_id"),
        ts.alias("published_at"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
    )
    dim = spark.range(1, 4000).select(F.col("id").alias("author_id"))  # authors >= 4000 are orphans
    rows, plan = final_plan(facts.fact_delta_source(arts, dim, broadcast_bytes=-1))
    assert len(rows) == n
    assert sum(1 for r in rows if r["author_id"] == 1) == n // 3
    assert sum(1 for r in rows if r["author_id"] is None) == sum(1 for i in range(n) if i % 3 and i % 5000 + 2 >= 4000)
    assert "SortMergeJoin(skew=true)" in plan
