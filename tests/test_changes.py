"""Change feeds in any order, uniqueness at load, one publish a run."""

import datetime as dt

import pytest
import seed
from pyspark.sql import functions as F

from contentmart import schemas
from contentmart.operators import quality
from contentmart.operators.quality import ConstraintViolation
from contentmart.plans import jobs
from contentmart.session import scratch_path
from contentmart.sources.publish import PublishConflict, Warehouse
from contentmart.sources.ranged import RangedWarehouse
from contentmart.sources.staging import RunScratch
from contentmart.streaming.changes import run_change_stream, write_changes

FACT = jobs.FACT
NULLABLE = schemas.StructType([schemas.StructField(f.name, f.dataType, True) for f in schemas.SOURCE_ARTICLES.fields])
KINDS = [lambda spark, root: Warehouse(spark, root), lambda spark, root: RangedWarehouse(spark, root, width=8)]


def loaded(spark, kind=KINDS[0], name="changes"):
    wh = kind(spark, scratch_path(spark, name))
    jobs.full_load(spark, seed.source(spark), warehouse=wh)
    return wh


def change(spark, *rows):
    """(id, seq, op, title) as article changes with full images."""
    at = dt.datetime(2026, 6, 1)
    created = {r[0]: r[5] for r in seed.article_rows()}  # a row's creation never changes
    full = [(i, title, "body", at, 1, created.get(i, at), at, None, seq, op) for i, seq, op, title in rows]
    schema = schemas.StructType([*NULLABLE.fields, schemas.StructField("seq", schemas.LongType()), schemas.StructField("op", schemas.StringType())])
    return spark.createDataFrame(full, schema)


def titles(wh):
    return {r.article_id: r.title for r in wh.read("dim_articles").collect()}


@pytest.mark.parametrize("kind", KINDS)
def test_late_changes_are_passed_over(spark, kind):
    wh = loaded(spark, kind)
    jobs.apply_article_changes(spark, change(spark, (1, 9, "U", "new"), (2, 10, "D", "gone"), (50, 4, "I", "fifty")), wh)
    jobs.apply_article_changes(spark, change(spark, (1, 3, "U", "old"), (2, 3, "U", "back"), (50, 4, "U", "again"), (51, 1, "I", "other")), wh)
    got = titles(wh)
    assert got[1] == "new" and 2 not in got and got[50] == "fifty" and got[51] == "other"
    assert 2 not in {r.article_id for r in wh.read(FACT).collect()}
    jobs.apply_article_changes(spark, change(spark, (2, 11, "I", "reborn"), (1, 10, "D", "")), wh)
    assert titles(wh)[2] == "reborn" and 1 not in titles(wh)
    state = {r.id: (r.seq, r.deleted) for r in wh.read("applied_articles").collect()}
    assert state == {1: (10, True), 2: (11, False), 50: (4, False), 51: (1, False)}


def test_feeds_in_any_order_without_a_warehouse(spark):
    feeds = [change(spark, (1, 2, "U", "b"), (3, 7, "D", "")), change(spark, (1, 1, "U", "a"), (3, 6, "U", "c")), change(spark, (1, 3, "U", "z"))]
    want = None
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        tables = jobs.full_load(spark, seed.source(spark)).tables
        for i in order:
            tables = jobs.apply_article_changes(spark, feeds[i], tables)
        got = sorted(tables["dim_articles"].collect())
        assert want is None or got == want
        want = got


def test_author_feed_keeps_its_order_too(spark):
    wh = loaded(spark)
    author = seed.source(spark)["authors"].filter("id = 1")
    none = change(spark, (1, 1, "U", "x")).limit(0)

    def feed(seq, name, op="U"):
        return author.withColumn("name", F.lit(name)).withColumn("seq", F.lit(seq)).withColumn("op", F.lit(op))

    for seq, name, op in ((5, "five", "U"), (2, "two", "U"), (9, "nine", "D"), (6, "six", "U")):
        jobs.apply_article_changes(spark, none, wh, author_changes=feed(seq, name, op))
        names = {r.author_id: r.name for r in wh.read("dim_authors").collect()}
        assert names.get(1) == ("five" if seq < 9 and op == "U" and seq != 6 else None)


def test_broken_changes_stop_the_run_or_go_to_quarantine(spark):
    wh = loaded(spark)
    feed = change(spark, (1, 5, "U", None), (2, 5, "U", "x" * 300), (3, 5, "U", "fine"), (4, None, "U", "no number"), (None, 5, "D", "no key"))
    with pytest.raises(Exception, match="title is null"):
        jobs.apply_article_changes(spark, feed, wh)
    assert titles(wh)[3] == "Post number 3"
    jobs.apply_article_changes(spark, feed, wh, on_violation="quarantine")
    assert titles(wh)[3] == "fine" and titles(wh)[1] == "Post number 1"
    assert {r.id for r in wh.read("applied_articles").collect()} == {3}
    counts = {r.stage: r.rows for r in wh.read("load_audit").filter("job = 'apply_article_changes'").collect()}
    assert counts == {"changes_articles": 5, "quarantine_articles": 4, "applied_articles": 1}


@pytest.mark.parametrize("kind", KINDS)
def test_a_run_that_stops_between_tables_leaves_the_warehouse_whole(spark, kind, monkeypatch):
    wh = loaded(spark, kind)
    reader = kind(spark, wh.root)
    before = {n: sorted(wh.read(n).collect(), key=repr) for n in (*wh.tables, "load_audit")}
    src = seed.source(spark)
    changed = {"authors": src["authors"].withColumn("name", F.lit("other")), "articles": src["articles"].filter("id > 3")}
    from contentmart.operators import facts

    def stop(*args, **kw):
        reader.refresh()  # both dimensions are written by now
        assert {n: sorted(reader.read(n).collect(), key=repr) for n in before} == before
        raise OSError("lost")

    for fn, run in (
        ("fact_full_load", lambda: jobs.full_load(spark, changed, warehouse=wh)),
        ("fact_delta_source", lambda: jobs.incremental_load(spark, changed, wh, since="2000-01-01 00:00:00")),
        ("fact_delta_source", lambda: jobs.apply_article_changes(spark, change(spark, (1, 1, "D", ""), (2, 1, "U", "x")), wh)),
    ):
        with monkeypatch.context() as m:
            m.setattr(facts, fn, stop)
            with pytest.raises(OSError):
                run()
        for each in (wh, kind(spark, wh.root)):
            assert {n: sorted(each.read(n).collect(), key=repr) for n in before} == before
    jobs.full_load(spark, changed, warehouse=wh)
    reader.refresh()
    assert reader.read("dim_articles").count() == 27 and reader.read(FACT).count() == 17
    assert {r.name for r in reader.read("dim_authors").collect()} == {"other"}


def test_of_two_runs_one_publishes_all_its_tables(spark):
    one = loaded(spark)
    two = Warehouse(spark, one.root)
    src = seed.source(spark)
    with pytest.raises(PublishConflict):
        with two.run():
            two.publish("dim_authors", two.read("dim_authors").limit(1))
            jobs.full_load(spark, {"authors": src["authors"], "articles": src["articles"].filter("id < 9")}, warehouse=one)
    two.refresh()
    assert two.read("dim_authors").count() == 10 and two.read(FACT).count() == 8
    assert two.vacuum(grace_seconds=0) and two.read("dim_articles").count() == 8


def test_tables_published_one_by_one_are_taken_over(spark):
    from contentmart.sources.publish import SnapshotTable

    root = scratch_path(spark, "old")
    SnapshotTable(spark, f"{root}/dim_authors", schemas.DIM_AUTHORS).publish(seed.source(spark)["authors"].withColumnRenamed("id", "author_id"))
    wh = Warehouse(spark, root)
    assert wh.read("dim_authors").count() == 10 and wh.read(FACT).count() == 0
    jobs.full_load(spark, seed.source(spark), warehouse=wh)
    assert Warehouse(spark, root).read(FACT).count() == 20


def test_repeated_ids_and_emails_at_load(spark):
    src = seed.source(spark)
    twin = src["authors"].filter("id = 1").withColumn("name", F.lit("twin")).withColumn("updated_at", F.lit(dt.datetime(2026, 9, 1)).cast("timestamp_ntz"))
    alias = src["authors"].filter("id = 2").withColumn("id", F.lit(77).cast("long"))  # a tie on everything but the id
    broken = {"authors": src["authors"].unionByName(twin).unionByName(alias), "articles": src["articles"].unionByName(src["articles"].filter("id = 5"))}
    wh = Warehouse(spark, scratch_path(spark, "twice"))
    with pytest.raises(ConstraintViolation, match="id is not unique"):
        jobs.full_load(spark, broken, warehouse=wh)
    assert wh.read("dim_authors").count() == 0
    result = jobs.full_load(spark, broken, warehouse=wh, on_violation="quarantine")
    bad = sorted((r.id, r.name, r.reason) for r in result.quarantine["authors"].collect())
    assert bad == [("1", "Writer 01", "id is not unique"), ("2", "Writer 02", "email is not unique")]
    assert {r.author_id: r.name for r in wh.read("dim_authors").collect()}[1] == "twin"
    assert [(r.id, r.reason) for r in result.quarantine["articles"].collect()] == [("5", "id is not unique")]
    assert [r.article_count for r in wh.read(FACT).filter("article_id = 5").collect()] == [1]


def test_author_id_is_required(spark):
    src = seed.source(spark)
    rows = spark.createDataFrame([(i, t, c, p, None if i == 4 else a, *rest) for i, t, c, p, a, *rest in seed.article_rows()], NULLABLE)
    broken = {"authors": src["authors"], "articles": rows}
    with pytest.raises(ConstraintViolation, match="author_id is null"):
        jobs.full_load(spark, broken)
    result = jobs.full_load(spark, broken, warehouse=Warehouse(spark, scratch_path(spark, "noauthor")), on_violation="quarantine")
    assert [(r.id, r.reason) for r in result.quarantine["articles"].collect()] == [("4", "author_id is null")]
    assert result.tables["dim_articles"].count() == 29


def test_emails_held_in_the_dimension(spark):
    """A chain: 20 takes 1's e-mail, 1 takes 2's, 2 is not in the batch; so 1 keeps its own and 20 must go."""
    wh = loaded(spark)
    a = {r.id: r for r in seed.source(spark)["authors"].collect()}
    now = dt.datetime(2026, 9, 1)
    rows = [(20, "n20", a[1].email, now, now), (1, "n1", a[2].email, now, now), (3, "n3", a[4].email, now, now), (4, "n4", "free@example.org", now, now)]
    later = {"authors": spark.createDataFrame(rows, schemas.SOURCE_AUTHORS), "articles": seed.source(spark)["articles"].limit(0)}
    with pytest.raises(ConstraintViolation, match="email is held"):
        jobs.incremental_load(spark, later, wh, since="2000-01-01 00:00:00")
    result = jobs.incremental_load(spark, later, wh, since="2000-01-01 00:00:00", on_violation="quarantine")
    assert sorted(r.id for r in result.quarantine["authors"].collect()) == ["1", "20"]
    emails = {r.author_id: r.email for r in wh.read("dim_authors").collect()}
    assert emails[1] == a[1].email and emails[3] == a[4].email and emails[4] == "free@example.org" and 20 not in emails
    assert len(set(emails.values())) == len(emails) == 10


@pytest.mark.parametrize("limit", [None, -1])
def test_held_values_with_and_without_broadcast(spark, limit):
    scratch = RunScratch(spark)
    batch = spark.createDataFrame([(i, f"e{i % 7}") for i in range(100, 140)], "id long, email string")
    target = spark.createDataFrame([(i, f"e{i}") for i in range(5)] + [(9, None)], "author_id long, email string")
    good, bad = quality.split_held(batch, "id", "email", target, "author_id", scratch.keep, limit)
    assert {r.email for r in good.collect()} == {"e5", "e6"} and good.count() + bad.count() == 40


def test_change_stream_equals_one_ordered_feed(spark):
    import random

    rng = random.Random(5)
    rows = [(rng.randrange(1, 41), seq, rng.choice("UUD"), f"title {seq}\nline \\n |") for seq in range(1, 161)]
    want = jobs.apply_article_changes(spark, change(spark, *rows), jobs.full_load(spark, seed.source(spark)).tables)
    rng.shuffle(rows)
    root = scratch_path(spark, "changestream")
    wh = KINDS[1](spark, f"{root}/wh")
    jobs.full_load(spark, seed.source(spark), warehouse=wh)
    for part in (rows[:80], rows[80:]):  # the second run starts from the first one's checkpoint
        for at in range(0, len(part), 40):
            write_changes(change(spark, *part[at : at + 40]).coalesce(1), f"{root}/landing")
        run_change_stream(spark, f"{root}/landing", wh, f"{root}/checkpoint", max_files_per_trigger=1)
    for name in ("dim_articles", FACT):
        assert sorted(wh.read(name).collect(), key=repr) == sorted(want[name].collect(), key=repr), name
    read = {r.stage: r["sum(rows)"] for r in wh.read("load_audit").filter("job = 'apply_article_changes'").groupBy("stage").sum("rows").collect()}
    assert read["changes_articles"] < 160 and read["applied_articles"] == read["changes_articles"]  # the state spared the rest


def test_change_stream_without_its_state(spark):
    """A new checkpoint reads all files again: the warehouse's own record passes over what it has."""
    root = scratch_path(spark, "replayall")
    wh = loaded(spark, name="replayallwh")
    write_changes(change(spark, (1, 9, "U", "nine"), (2, 9, "D", "")).coalesce(1), f"{root}/landing")
    write_changes(change(spark, (1, 4, "U", "four"), (2, 4, "U", "four")).coalesce(1), f"{root}/landing")
    for n in range(2):
        run_change_stream(spark, f"{root}/landing", wh, f"{root}/checkpoint{n}", max_files_per_trigger=1)
        assert titles(wh)[1] == "nine" and 2 not in titles(wh)


def test_landed_files_with_escaped_lines_are_split(spark):
    from contentmart.sources import delimited, staging
    from contentmart.streaming.incremental import landing_stream, run_incremental_stream

    root = scratch_path(spark, "escaped")
    wh = loaded(spark, name="escapedwh")
    rows = seed.source(spark)["articles"].filter("id < 4").withColumn("title", F.lit("a\nb \\n |c"))
    delimited.write_delimited(staging.as_staged_text(rows, "articles"), f"{root}/landing", escape_lines=True)
    run_incremental_stream(spark, f"{root}/landing", wh, f"{root}/checkpoint", escape_lines=True)
    assert {titles(wh)[i] for i in (1, 2, 3)} == {"a\nb \\n |c"}
    assert landing_stream(spark, f"{root}/landing", escape_lines=True).isStreaming


class _State:
    """The state of a group of keys, outside of a stream."""

    def __init__(self):
        self.value, self.now, self.timeout, self.hasTimedOut = None, 0, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def getCurrentProcessingTimeMs(self):
        return self.now

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_keys_share_a_group_of_the_state():
    """Each key of a group keeps its own newest change and its own expiry."""
    import pandas as pd

    from contentmart.streaming.changes import _newest

    state, run = _State(), _newest(retention_ms=100)

    def batch(now, *parts):
        state.now = now
        frames = [pd.DataFrame([(k, s, t, k or "") for k, s, t in p], columns=["id", "seq", "title", "__key"], dtype=object) for p in parts]
        return sorted((r.id or "", r.seq or "", r.title) for f in run((7,), iter(frames), state) for r in f.itertuples())

    got = batch(10, [("a", "2", "a2"), ("b", "9", "b9"), ("a", "10", "a10")], [("c", None, "odd"), ("a", "3", "a3"), ("a", "10", "again"), (None, "1", "no key")])
    assert got == [("", "1", "no key"), ("a", "10", "a10"), ("b", "9", "b9"), ("c", "", "odd")]
    assert batch(60, [("a", "10", "same"), ("b", "8", "late"), ("c", "1", "c1"), ("b", str(2**60 + 1), "far")]) == [("b", str(2**60 + 1), "far"), ("c", "1", "c1")]
    assert batch(70, [("b", str(2**60), "one less")]) == [] and state.timeout == 90  # a late change leaves the expiry
    assert batch(111, [("a", "1", "after its expiry"), ("c", "1", "held")]) == [("a", "1", "after its expiry")]
    state.hasTimedOut = True
    assert batch(400) == [] and not state.exists


def test_a_batch_of_many_keys_makes_a_call_for_each_group(spark):
    """One call and one entry of the state for each of the groups, however many keys a batch has."""
    from contentmart.streaming.changes import CHANGES, GROUPS, STREAM_CONF, newest_changes
    from contentmart.streaming.incremental import landing_stream

    root = scratch_path(spark, "manykeys")
    rows = spark.range(20_000).selectExpr("id", "'t' as title", "'c' as content", "cast(null as timestamp_ntz) as published_at",
        "id as author_id", "timestamp_ntz'2026-01-01' as created_at", "timestamp_ntz'2026-01-01' as updated_at",
        "cast(null as timestamp_ntz) as deleted_at", "1L as seq", "'U' as op")
    write_changes(rows, f"{root}/landing")
    kept, seen = newest_changes(landing_stream(spark, f"{root}/landing", escape_lines=True, schema=CHANGES)), []
    query = kept.writeStream.outputMode("update").foreachBatch(lambda df, n: seen.append(df.select("id").distinct().count()))
    query = query.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    for k, v in STREAM_CONF.items():
        spark.conf.set(k, v)
    try:
        query = query.start()
    finally:
        for k in STREAM_CONF:
            spark.conf.unset(k)
    assert query.awaitTermination(60)
    assert seen == [20_000]
    held = sum(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators)
    assert 0 < held <= GROUPS * int(spark.conf.get("spark.sql.shuffle.partitions"))
