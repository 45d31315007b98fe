"""Delimited hand-off, staging, snapshots and JDBC extract (embedded Derby, no server)."""

import datetime as dt
import os

import pytest
import seed
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contentmart import schemas
from contentmart.session import scratch_path
from contentmart.sources import delimited, extract, fs, staging
from contentmart.sources.publish import SnapshotTable, insert_columns

T = dt.datetime(2026, 5, 1, 8, 0, 0, 123456)


def test_delimited_round_trip_keeps_awkward_text(spark):
    rows = [
        ("1", "pipe | inside", 'quote " inside', T, "7", T, T, None),
        ("2", "line\nbreak", None, None, "7", T, T, T),
        ("3", "plain", "", T, "8", None, None, None),
    ]
    df = spark.createDataFrame(rows, schemas.STAGING_ARTICLES)
    path = scratch_path(spark, "delim")
    delimited.write_delimited(df, path)
    back = sorted(tuple(r) for r in delimited.read_delimited(spark, path, schemas.STAGING_ARTICLES).collect())
    want = sorted(tuple(r) for r in rows)
    # An empty text and NULL travel as the same empty field (both come back NULL).
    want = [tuple(None if v == "" else v for v in r) for r in want]
    assert back == want


def test_text_comes_back_as_it_was(spark):
    texts = [" lead", "trail ", "\ttab\t", "a\nb", "a\\nb", "\\", "\\\\n\n\\", "q\"|\"", "\r\n", "n\\r\r", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for escape in (True, False):
        path = scratch_path(spark, "delimtext")
        delimited.write_delimited(df, path, escape_lines=escape)
        back = {r.id: r.text for r in delimited.read_delimited(spark, path, df.schema, escape_lines=escape).collect()}
        assert [back[i] for i in range(len(texts))] == texts


def test_delimited_accepts_plain_seconds_and_fails_fast_on_bad_rows(spark):
    path = scratch_path(spark, "delimtxt")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as fh:
        fh.write("id|name|email|created_at|updated_at\n")
        fh.write("1|A|a@x|2026-05-01 08:00:00|2026-05-01 08:00:00.5\n")
    got = delimited.read_delimited(spark, path, schemas.STAGING_AUTHORS).collect()
    assert got[0]["created_at"] == dt.datetime(2026, 5, 1, 8, 0)
    assert got[0]["updated_at"] == dt.datetime(2026, 5, 1, 8, 0, 0, 500000)
    with open(os.path.join(path, "b.csv"), "w") as fh:
        fh.write("id|name|email|created_at|updated_at\n")
        fh.write("2|B|b@x|not a time|2026-05-01 08:00:00\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        delimited.read_delimited(spark, path, schemas.STAGING_AUTHORS).collect()


def test_missing_landing_is_an_error(spark):
    area = staging.StagingArea(spark)
    with pytest.raises(FileNotFoundError):
        area.stage("authors")


def test_staging_replace_and_purge(spark):
    src = seed.source(spark)
    area = staging.StagingArea(spark)
    first = area.replace("articles", src["articles"])
    assert first.count() == 30
    assert not fs.exists(spark, area.landing("articles"))  # purged once loaded
    second = area.replace("articles", src["articles"].filter(F.col("id") > 25))
    assert sorted(r[0] for r in second.select("id").collect()) == ["26", "27", "28", "29", "30"]
    assert second.schema == schemas.STAGING_ARTICLES or [f.name for f in second.schema] == [f.name for f in schemas.STAGING_ARTICLES]


def test_snapshot_versions_and_idempotent_publish(spark):
    table = SnapshotTable(spark, scratch_path(spark, "snap"), schemas.DIM_AUTHORS)
    assert table.current_version() == 0 and table.read().count() == 0
    src = seed.source(spark)["authors"]
    dim = src.select(F.col("id").alias("author_id"), "name", "email", "created_at", "updated_at")
    assert table.publish(dim) == 1
    # New content computed from the current one (never overwrites what it reads).
    assert table.publish(table.read().filter(F.col("author_id") <= 5), tag="batch-7") == 2
    assert table.read().count() == 5
    assert table.publish(dim, tag="batch-7") == 2  # replayed publish: nothing written
    assert table.read().count() == 5
    assert table.publish(dim) == 3  # an untagged reload still goes through


def test_insert_with_named_column_list(spark):
    df = spark.createDataFrame([(5, "x@y", "X")], "a long, b string, c string")
    out = insert_columns(df, ["author_id", "email", "name"], schemas.DIM_AUTHORS)
    assert [f.name for f in out.schema] == ["author_id", "name", "email", "created_at", "updated_at"]
    assert tuple(out.first()) == (5, "X", "x@y", None, None)


def test_resolve_since():
    start = dt.datetime(2026, 5, 20, 9, 0, 0)
    assert extract.resolve_since(start) == "2026-05-20 09:00:00"
    assert extract.resolve_since(None, now=start) == "2026-05-19 09:00:00"


def test_values_rows(spark):
    df = extract.values_rows(spark, seed.author_rows()[:2], schemas.SOURCE_AUTHORS)
    assert df.count() == 2 and df.schema == schemas.SOURCE_AUTHORS


@pytest.fixture(scope="module")
def derby(spark):
    url = "jdbc:derby:memory:contentmart_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "preferTimestampNTZ": "true"}
    src = seed.source(spark)
    for name, df in src.items():
        df.write.jdbc(url, name.upper(), mode="overwrite", properties=props)
    return extract.JdbcSource(url, props, partition_column="id", partitions=4)


def test_jdbc_partitioned_full_extract(spark, derby):
    df = extract.extract_full(spark, derby, "ARTICLES")
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 30
    assert dict(df.dtypes)["updated_at"] == "timestamp_ntz"


def test_jdbc_slices_follow_the_rows(spark, derby):
    """Nine tenths of the ids in the last tenth of their range, rows without a key, a change window."""
    ids = [i * 100 for i in range(100)] + list(range(9900, 10_800))
    stamp = dt.datetime(2026, 1, 1)
    rows = [(i, stamp + dt.timedelta(days=i % 10)) for i in ids] + [(None, stamp)] * 3
    spark.createDataFrame(rows, "id long, updated_at timestamp_ntz").write.jdbc(derby.url, "DENSE", mode="overwrite", properties=derby.properties)
    got = extract.extract_full(spark, derby, "DENSE")
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 2 * min(sizes)
    assert sorted(r.id for r in got.filter("id is not null").collect()) == sorted(ids) and got.count() == len(rows)
    late = extract.extract_changes(spark, derby, "DENSE", "updated_at", "2026-01-06 00:00:00", "2026-01-08 00:00:00")
    want = [i for i in ids if 5 <= i % 10 < 7]
    sizes = [r["count"] for r in late.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(r.id for r in late.collect()) == sorted(want) and len(sizes) == 4 and max(sizes) <= 2 * min(sizes)


def test_slice_cuts_of_any_distribution():
    import bisect
    import random

    rng = random.Random(2)
    for _ in range(60):
        wide = rng.choice([1, 50, 10**6, 10**15])
        keys = sorted({rng.randrange(-wide, wide) for _ in range(400)} | {wide * 50 + i for i in range(rng.randrange(1, 3000))})

        def count(ranges, keys=keys):
            found = {}
            for low, high, width in ranges:
                for k in keys[bisect.bisect_left(keys, low) : bisect.bisect_left(keys, high)]:
                    at = low + (k - low) // width * width
                    found[at, width] = found.get((at, width), 0) + 1
            return sorted((at, width, n) for (at, width), n in found.items())

        cuts = extract.slice_cuts(count, keys[0], keys[-1], 8)
        edges = [0, *[bisect.bisect_left(keys, c) for c in cuts], len(keys)]
        sizes = [b - a for a, b in zip(edges, edges[1:], strict=False)]
        assert len(keys) < 64 or (len(sizes) == 8 and max(sizes) <= 2 * min(sizes)), sizes


def test_jdbc_months(spark, derby):
    got = extract.extract_months(spark, derby, "ARTICLES", "published_at", dt.date(2026, 4, 20), dt.date(2026, 5, 8), months=1)
    assert got.rdd.getNumPartitions() == 2
    want = [r[0] for r in seed.article_rows() if r[3] and dt.datetime(2026, 4, 20) <= r[3] < dt.datetime(2026, 5, 8)]
    assert sorted(r.id for r in got.collect()) == want


def test_backfill_asks_the_source_for_its_months(spark, derby):
    from contentmart.plans.jobs import _in_chunks

    rows = extract.extract_full(spark, derby, "ARTICLES").filter(_in_chunks([2026 * 12 + 3, 2026 * 12 + 4], 1))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "*GreaterThanOrEqual(published_at,2026-04-01T00:00), *LessThan(" in plan  # both marked as applied by the source
    assert rows.count() == 25


def test_jdbc_delta_pushdown(spark, derby):
    df = extract.extract_full(spark, derby, "ARTICLES")
    delta = extract.extract_delta(df, "updated_at", "2026-05-19 00:00:00")
    assert delta.count() == 10
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual" in plan


def test_file_source_extract(spark):
    root = scratch_path(spark, "filesrc")
    src = seed.source(spark)
    for name, df in src.items():
        df.write.parquet(f"{root}/{name}")
    fsrc = extract.FileSource(root, "parquet", schemas=dict(schemas.SOURCE))
    arts = extract.extract_full(spark, fsrc, "articles")
    assert arts.columns == [f.name for f in schemas.SOURCE_ARTICLES] and arts.count() == 30
    delta = extract.extract_delta(arts, "updated_at", "2026-05-20 09:00:00")
    assert sorted(r[0] for r in delta.select("id").collect()) == [20, 27, 28, 29, 30]
