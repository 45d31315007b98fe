"""Key-range tables: a MERGE rewrites only the ranges the source touches."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from contentmart.operators import merge as M
from contentmart.session import scratch_path
from contentmart.sources.ranged import KeyRangeTable

SCHEMA = "k long, v string"


def spec():
    return M.MergeSpec(
        "k",
        "k",
        when_matched=(M.delete(M.src("v") == "gone"), M.update({"v": M.src("v")})),
        when_not_matched=(M.insert({"k": M.src("k"), "v": M.src("v")}),),
    )


def test_merge_rewrites_only_touched_ranges(spark):
    schema = StructType([StructField("k", LongType()), StructField("v", StringType())])
    table = KeyRangeTable(spark, scratch_path(spark, "ranged"), schema, "k", width=100)
    base = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    assert table.publish(base) == 1
    before = table.ranges()
    assert sorted(before) == list(range(10))

    # Touch ranges 2 (update), 5 (delete all of it) and 12 (new): nothing else moves.
    src = spark.createDataFrame(
        [(250, "new")] + [(k, "gone") for k in range(500, 600)] + [(1234, "ins"), (None, "nullkey")], SCHEMA
    )
    assert table.merge(src, spec(), tag="b1") == 2
    after = table.ranges()
    for r in (0, 1, 3, 4, 6, 7, 8, 9):
        assert after[r] == before[r]
    assert after[2] != before[2] and 5 not in after and 12 in after and -1 in after

    rows = {(r["k"], r["v"]) for r in table.read().collect()}
    assert (250, "new") in rows and (1234, "ins") in rows and (None, "nullkey") in rows
    assert not any(500 <= (k or -1) < 600 for k, _ in rows)
    assert len(rows) == 1000 - 100 + 2

    # A replayed batch writes nothing.
    assert table.merge(src, spec(), tag="b1") == 2
    fresh = KeyRangeTable(spark, table.root, schema, "k", width=100)
    assert fresh.current_version() == 2 and fresh.read().count() == 902


def test_hard_delete_reconciliation_rewrites_only_affected_ranges(spark):
    import seed

    from contentmart.plans import jobs
    from contentmart.sources.ranged import RangedWarehouse

    src = seed.source(spark)
    wh = RangedWarehouse(spark, scratch_path(spark, "recon"), width=10)
    jobs.full_load(spark, src, warehouse=wh)
    before = wh.tables[jobs.FACT].ranges()
    now = {"authors": src["authors"], "articles": src["articles"].filter(~F.col("id").isin(5, 7))}
    tables = jobs.reconcile_hard_deletes(spark, now, wh)
    assert {r[0] for r in tables[jobs.FACT].select("article_id").collect()} == set(range(1, 21)) - {5, 7}
    assert tables["dim_articles"].count() == 28 and tables["dim_authors"].count() == 10
    after = wh.tables[jobs.FACT].ranges()
    assert after[0] != before[0]  # ids 5 and 7 live in range 0
    assert after[1] == before[1] and after[2] == before[2]


def table_of(spark, name, **kw):
    schema = StructType([StructField("k", LongType()), StructField("v", StringType())])
    return KeyRangeTable(spark, scratch_path(spark, name), schema, "k", **kw)


def test_vacuum_keeps_the_content_and_spares_young_folders(spark):
    table = table_of(spark, "vac", width=100)
    table.publish(spark.range(0, 500).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    for i, r in enumerate((1, 2, 3)):
        table.merge(spark.createDataFrame([(r * 100 + 5, f"v{i}")], SCHEMA), spec())
    latest = sorted(table.read().collect())
    assert table.vacuum() == []  # a running writer may own what is a few seconds old
    assert len(table.vacuum(grace_seconds=0)) == 3  # the ranges that were written again
    assert sorted(table.read().collect()) == latest
    fresh = KeyRangeTable(spark, table.root, table.schema, "k")
    assert sorted(fresh.read().collect()) == latest and fresh.current_version() == 4


def test_a_replay_after_vacuum_changes_nothing(spark):
    table = table_of(spark, "replay", width=100)
    table.publish(spark.range(0, 10).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    batch = spark.createDataFrame([(5, "OLD")], SCHEMA)
    table.merge(batch, spec(), tag="stream:x#5")
    for i in range(3):
        table.merge(spark.createDataFrame([(5, "NEW")], SCHEMA), spec())
    table.vacuum(grace_seconds=0)
    fresh = KeyRangeTable(spark, table.root, table.schema, "k")
    fresh.merge(batch, spec(), tag="stream:x#5")
    fresh.merge(batch, spec(), tag="stream:x#4")  # an older batch of the stream
    assert [r.v for r in fresh.read().filter("k = 5").collect()] == ["NEW"]


def test_a_crashed_attempt_is_never_read(spark):
    """The folder of an attempt that wrote rows and then died before its pointer."""
    table = table_of(spark, "crash", width=10)
    table.publish(spark.createDataFrame([(1, "x")], SCHEMA))
    point, KeyRangeTable._point = KeyRangeTable._point, lambda *a, **k: (_ for _ in ()).throw(OSError("lost"))
    try:
        for attempt in (lambda: table.publish(spark.createDataFrame([(1, "y"), (25, "gone")], SCHEMA)),
                        lambda: table.merge(spark.createDataFrame([(35, "gone")], SCHEMA), spec())):
            try:
                attempt()
            except OSError:
                pass
    finally:
        KeyRangeTable._point = point
    table.merge(spark.createDataFrame([(1, "y")], SCHEMA), spec())
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "y")]
    table.vacuum(grace_seconds=0)
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "y")]


def test_of_two_writers_one_wins_and_the_other_is_told(spark):
    import pytest

    from contentmart.sources.publish import PublishConflict

    one = table_of(spark, "two", width=10)
    one.publish(spark.createDataFrame([(1, "x")], SCHEMA))
    two = KeyRangeTable(spark, one.root, one.schema, "k", width=10)
    two.refresh()
    one.merge(spark.createDataFrame([(2, "first")], SCHEMA), spec())
    with pytest.raises(PublishConflict):
        two.merge(spark.createDataFrame([(3, "second")], SCHEMA), spec())
    reader = KeyRangeTable(spark, one.root, one.schema, "k", width=10)
    assert sorted(tuple(r) for r in reader.read().collect()) == [(1, "x"), (2, "first")]
    two.merge(spark.createDataFrame([(3, "second")], SCHEMA), spec())  # run again from the new content
    assert sorted(tuple(r) for r in two.read().collect()) == [(1, "x"), (2, "first"), (3, "second")]


def test_width_follows_the_bytes_of_a_row(spark):
    rows = spark.range(0, 1000).select(F.col("id").alias("k"))
    thin, wide = table_of(spark, "thin", range_bytes=20_000), table_of(spark, "wide", range_bytes=20_000)
    thin.publish(rows.withColumn("v", F.lit("x")))
    wide.publish(rows.withColumn("v", F.repeat(F.lit("x"), 1000)))
    assert thin.width > 20 * wide.width and len(wide.ranges()) > 10 * len(thin.ranges())


def test_snapshot_vacuum(spark):
    from contentmart import schemas
    from contentmart.sources.publish import SnapshotTable

    t = SnapshotTable(spark, scratch_path(spark, "snapvac"), schemas.DIM_AUTHORS)
    for _ in range(4):
        t.publish(spark.createDataFrame([(1, "a", "a@x", None, None)], schemas.DIM_AUTHORS))
    assert len(t.vacuum(grace_seconds=0)) == 3 and t.read().count() == 1
