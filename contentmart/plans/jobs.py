"""User-level load jobs composed from the operators.

* ``init_warehouse``   — empty typed tables plus the calendar dimension;
* ``full_load``        — extract all -> stage -> reload dims -> reload fact;
* ``incremental_load`` — extract delta -> stage -> MERGE dims -> MERGE fact;
* ``full_refresh``     — a full load over a populated warehouse;
* ``reconcile_hard_deletes``, ``apply_article_changes`` — rows that left the source, change feeds;
* ``backfill_fact``    — the full-load fact in date chunks (restartable).

Every run reads each source table once: the extract, and whatever several steps derive from it, is
written to the run's own folder on shared storage, and all steps read that copy, so they see one state
of a source that keeps moving.  With a ``Warehouse`` the folder is deleted at the end; without one the
returned frames read it, and it stays with the checkpoints.

A run publishes all its tables in one step when it ends.  One that fails, at whatever table, leaves the
warehouse as it was, and readers never see tables of two runs.  Its row counts go to ``load_audit`` in
the same step.

Rows that break a declared constraint (NOT NULL, text length, unique keys and columns, also against the
rows that a dimension holds already) stop the run, or go to a quarantine folder with
``on_violation="quarantine"``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart import schemas
from contentmart.functions.predicates import is_live
from contentmart.operators import dims, facts
from contentmart.operators import merge as M
from contentmart.operators.audit import RunAudit
from contentmart.operators.calendar import DIM_DATE_END, DIM_DATE_START, dim_date
from contentmart.operators.casts import split_bad_ids, typed_ids
from contentmart.operators.quality import ConstraintViolation, split_held, split_unique, split_valid
from contentmart.operators.digests import removed_by_digest
from contentmart.operators.reconcile import applied_spec, cdc_spec, hard_delete_removed, last_change, newer_changes
from contentmart.plans.parallel import at_once
from contentmart.sources import fs
from contentmart.sources.extract import extract_changes, extract_full
from contentmart.sources.publish import BaseWarehouse, PublishedTable, Warehouse
from contentmart.sources.ranged import RangedWarehouse
from contentmart.sources.staging import STAGED_IDS, RunScratch, StagingArea, as_staged_text

FACT = "fact_reports_articles"
NAMES = ("dim_authors", "dim_articles", FACT)


@dataclass
class LoadResult:
    tables: dict[str, DataFrame]
    audit: RunAudit = field(default_factory=RunAudit)
    skipped: list[str] = field(default_factory=list)
    quarantine: dict[str, DataFrame] = field(default_factory=dict)


def init_warehouse(
    spark: SparkSession,
    warehouse: Warehouse | RangedWarehouse | None = None,
    start: str = DIM_DATE_START,
    end: str = DIM_DATE_END,
) -> dict[str, DataFrame]:
    tables = {name: spark.createDataFrame([], schema) for name, schema in schemas.WAREHOUSE.items()}
    tables["dim_date"] = dim_date(spark, start, end)
    if warehouse is not None:
        with warehouse.run():
            for name, df in tables.items():
                warehouse.publish(name, df)
        tables = {name: warehouse.read(name) for name in tables}
    return tables


class _Run:
    """What one run stages, checks and counts; as a context, its one publish."""

    def __init__(self, spark: SparkSession, job: str, store, staging: StagingArea | bool | None, on_violation: str, tag=None):
        if on_violation not in ("fail", "quarantine"):
            raise ValueError(f"unknown reaction to violations {on_violation!r}")
        self.spark, self.job, self.store, self.on_violation, self.tag = spark, job, store, on_violation, tag
        self.id = uuid.uuid4().hex
        self.scratch = RunScratch(spark)
        self.area = StagingArea(spark) if staging is True else (staging or None)
        self.own_area = staging is True
        self.result = LoadResult({})

    def __enter__(self) -> _Run:
        if self.store is not None:
            self._publishing = self.store.run()
            self._publishing.__enter__()  # sees what another process may have published
        return self

    def __exit__(self, kind, error, trace) -> None:
        if self.store is None:
            return
        try:
            if kind is None:
                self._note_counts()
        except BaseException as lost:
            self._publishing.__exit__(type(lost), lost, lost.__traceback__)
            raise
        else:
            self._publishing.__exit__(kind, error, trace)
        finally:
            self.scratch.close()
            if self.own_area:
                self.area.close()

    def _note_counts(self) -> None:
        now = dt.datetime.now()
        rows = [(self.id, self.job, stage, rows, now) for stage, rows in sorted(self.result.audit.counts().items())]
        if rows:
            self.store.publish("load_audit", self.spark.createDataFrame(rows, schemas.LOAD_AUDIT).coalesce(1), self.tag)

    def tables(self, current) -> dict[str, DataFrame]:
        if self.store is not None:
            return {n: self.store.read(n) for n in (*NAMES, *schemas.APPLIED)}
        empty = {n: self.spark.createDataFrame([], schema) for n, schema in schemas.APPLIED.items()}
        return {**empty, **current}

    def _keep_for(self, table: str):
        return lambda df, name: self.scratch.keep(df, f"{table}-{name}")

    def refuse(self, table: str, bad: DataFrame | None) -> None:
        """Stop the run because of ``bad`` rows (with a reason each), or put them in quarantine."""
        if bad is None or bad.isEmpty():
            return
        if self.on_violation == "fail":
            found = {r["reason"]: r["count"] for r in bad.groupBy("reason").count().collect()}  # by rule
            raise ConstraintViolation(f"{table}: {found}")
        root = self.store.root.rstrip("/") if self.store is not None else self.scratch.root
        path = f"{root}/_quarantine/{table}/{uuid.uuid4().hex}"
        stage = f"quarantine_{table}"
        self.result.audit.add(bad, stage, lambda out: out.write.parquet(path))
        found = self.spark.read.schema(bad.schema).parquet(path)
        earlier = self.result.quarantine.get(table)
        self.result.quarantine[table] = found if earlier is None else earlier.unionByName(found)

    def stage(self, table: str, df: DataFrame, held: DataFrame | None = None) -> DataFrame:
        """The extract, written once (through the delimited hand-off if there is one), typed and checked.

        ``held``: the dimension that the rows are merged into; for authors, its e-mails count as well.
        """
        audit, stage = self.result.audit, f"staging_{table}"
        if self.area is not None:
            staged = self.area.replace(table, audit.track(df, stage))
        else:
            staged = self.scratch.keep(audit.track(as_staged_text(df, table), stage), f"staged-{table}")
        audit.ran(stage)
        not_null, limits = schemas.DECLARED[table]
        ids = STAGED_IDS[table]

        def as_text(bad: DataFrame | None) -> DataFrame | None:
            return None if bad is None else bad.withColumns({c: F.col(c).cast("string") for c in ids})

        if self.on_violation == "fail":
            good, bad = split_valid(typed_ids(staged, ids), not_null, limits)
            self.refuse(table, bad)
        else:
            typed, odd = split_bad_ids(staged, ids)
            good, bad = split_valid(typed, not_null, limits)
            self.refuse(table, as_text(bad).unionByName(odd.withColumn("reason", F.lit("an id is not a number"))))
        good, bad = self.unique(table, good, held)
        self.refuse(table, as_text(bad))
        return good

    def unique(self, table: str, good: DataFrame, held: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
        """``good`` by the table's unique columns, within itself and against the rows of ``held``."""
        good, bad = split_unique(good, list(schemas.UNIQUE[table]), "updated_at", self._keep_for(table))
        if held is not None and "email" in schemas.UNIQUE[table]:
            good, more = split_held(good, "id", "email", held, "author_id", self._keep_for(table))
            bad = more if bad is None else bad if more is None else bad.unionByName(more)
        return good, bad

    def changes(self, table: str, feed: DataFrame, tables: dict[str, DataFrame], seq: str, op: str, delete_code: str, limit=None) -> DataFrame:
        """The changes of a feed that count: the last per key, valid, and newer than what was applied before."""
        audit, keep = self.result.audit, self._keep_for(table)
        latest = audit.add(feed, f"changes_{table}", lambda out: self.scratch.keep(last_change(out, "id", seq), f"last-{table}"))
        not_null, limits = schemas.DECLARED[table]
        gone = F.col(op).eqNullSafe(delete_code)
        deletes, no_delete = split_valid(latest.filter(gone), ["id", seq])
        upserts, no_upsert = split_valid(latest.filter(~gone), [*not_null, seq, op], limits)
        self.refuse(table, no_delete.unionByName(no_upsert))
        newer = newer_changes(deletes.unionByName(upserts), tables[f"applied_{table}"], "id", seq, limit)
        if "email" in schemas.UNIQUE[table]:
            newer = newer.withColumn("email", F.when(~gone, F.col("email")))  # a deleted row holds none
        newer = keep(newer, "newer")
        good, bad = self.unique(table, newer, tables["dim_authors"] if table == "authors" else None)
        self.refuse(table, bad)
        return audit.add(good, f"applied_{table}", lambda out: keep(out, "accepted"))

    def counted(self, name: str, df: DataFrame) -> None:
        """Publish ``df`` and note its rows."""
        self.store.publish(name, df, watch=lambda out: self.result.audit.track(out, name))
        self.result.audit.ran(name)


def full_load(
    spark: SparkSession,
    source,
    warehouse: Warehouse | RangedWarehouse | None = None,
    staging: StagingArea | bool | None = None,
    broadcast_bytes: int | None = None,
    on_violation: str = "fail",
) -> LoadResult:
    run = _Run(spark, "full_load", warehouse, staging, on_violation)
    with run:
        authors, articles = at_once(
            spark,
            lambda: run.stage("authors", extract_full(spark, source, "authors")),
            lambda: run.stage("articles", extract_full(spark, source, "articles")),
        )
        out = {"dim_authors": dims.dim_authors(authors), "dim_articles": dims.dim_articles(articles)}
        dim_rows = None
        if warehouse is not None:
            at_once(spark, *[lambda n=name, df=df: run.counted(n, df) for name, df in out.items()])
            out = {name: warehouse.read(name) for name in out}
            dim_rows = run.result.audit.count("dim_authors")
        out[FACT] = facts.fact_full_load(articles, out["dim_authors"], broadcast_bytes, dim_rows)
        if warehouse is not None:
            run.counted(FACT, out[FACT])
            out[FACT] = warehouse.read(FACT)
    run.result.tables = out
    return run.result


def full_refresh(spark: SparkSession, source, warehouse: Warehouse | None = None, **kw) -> LoadResult:
    """Periodic full refresh: the result never depends on the old content."""
    return full_load(spark, source, warehouse, **kw)


def incremental_load(
    spark: SparkSession,
    source,
    current: dict[str, DataFrame] | Warehouse | RangedWarehouse,
    since: str | dt.datetime,
    until: str | dt.datetime | None = None,
    staging: StagingArea | bool | None = None,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    author_ts_col: str | None = None,
    on_violation: str = "fail",
) -> LoadResult:
    """One delta run.  Authors travel whole unless ``author_ts_col`` is given.

    ``current`` is either in-memory tables (returns new DataFrames), a
    ``Warehouse`` of snapshots (publishes whole new versions) or a
    ``RangedWarehouse`` (rewrites only the key ranges the delta touches).
    """
    run = _Run(spark, "incremental_load", _store(current), staging, on_violation)
    with run:
        tables = run.tables(current)
        authors, articles = at_once(
            spark,
            lambda: run.stage("authors", extract_changes(spark, source, "authors", author_ts_col, since, until), tables["dim_authors"]),
            lambda: run.stage("articles", extract_changes(spark, source, "articles", "updated_at", since, until)),
        )
        tables, skipped = _apply(run, current, tables, authors, articles, strategy, broadcast_bytes)
    run.result.tables, run.result.skipped = tables, skipped
    return run.result


def _store(current) -> BaseWarehouse | None:
    return current if isinstance(current, BaseWarehouse) else None


def _merge_into(current, tables: dict[str, DataFrame], strategy: str, broadcast_bytes: int | None, tag: str | None):
    """A function that merges a staged source into one table and returns the new content."""
    store = _store(current)

    def merge(name: str, staged: DataFrame, spec: M.MergeSpec, bound=None, part: str = "") -> DataFrame:
        own = None if tag is None else _part_tag(tag, part)
        if isinstance(store, RangedWarehouse):
            store.merge(name, staged, spec, strategy=strategy, broadcast_bytes=broadcast_bytes, source_bound=bound, tag=own)
            return store.read(name)
        if store is not None and store.of(name).applied(own):
            return store.read(name)
        merged = M.merge(tables[name], staged, spec, strategy, broadcast_bytes, bound, staged=True)
        if store is None:
            return merged
        store.publish(name, merged, own)
        return store.read(name)

    return merge


def _part_tag(tag: str, part: str) -> str:
    """A batch's tag for one of several merges into a table: a stream of its own, the same batch number."""
    stream, sep, batch = tag.rpartition("#")
    return f"{stream or batch}{part}{sep}{batch if stream else ''}" if part else tag


def apply_delta(
    spark: SparkSession,
    current: dict[str, DataFrame] | Warehouse | RangedWarehouse,
    authors: DataFrame | None,
    articles: DataFrame,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    tag: str | None = None,
    on_violation: str = "fail",
) -> tuple[dict[str, DataFrame], list[str]]:
    """Stage source rows of a delta and MERGE them into the warehouse.

    Order as in the reference: both dims (at once), then the fact, whose source
    joins the *merged* author dimension.  Empty batches skip their merges.  With a
    ``tag`` each table records the batch, and a replay of it publishes nothing.
    """
    run = _Run(spark, "apply_delta", _store(current), None, on_violation, tag)
    with run:
        tables = run.tables(current)
        staged = None if authors is None else run.stage("authors", authors, tables["dim_authors"])
        return _apply(run, current, tables, staged, run.stage("articles", articles), strategy, broadcast_bytes, tag)


def _apply(run: _Run, current, tables, authors, articles, strategy, broadcast_bytes, tag=None):
    """``apply_delta`` for rows that are staged already."""
    merge = _merge_into(current, tables, strategy, broadcast_bytes, tag)
    skipped: list[str] = []

    def merge_authors() -> None:
        if authors is None or authors.isEmpty():
            skipped.append("dim_authors")
        else:
            tables["dim_authors"] = merge("dim_authors", authors, dims.authors_upsert_spec())

    def merge_articles():
        bound = facts.delta_source_bound(articles)
        if not bound.empty:
            tables["dim_articles"] = merge("dim_articles", articles, dims.articles_upsert_spec())
        return bound

    _, bound = at_once(run.spark, merge_authors, merge_articles)
    if bound.empty:
        return tables, [*skipped, "dim_articles", FACT]
    delta_source = run.scratch.keep(facts.fact_delta_source(articles, tables["dim_authors"], broadcast_bytes), "fact-source")
    tables[FACT] = merge(FACT, delta_source, facts.fact_merge_spec(), bound)
    return tables, skipped


def delete_spec(key: str) -> M.MergeSpec:
    """MERGE that deletes every matched target row (source = keys to remove)."""
    return M.MergeSpec(target_key=key, source_key=key, when_matched=(M.delete(),))


def reconcile_hard_deletes(
    spark: SparkSession,
    source,
    current: dict[str, DataFrame] | Warehouse | RangedWarehouse,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    by_digest: bool = False,
) -> dict[str, DataFrame]:
    """Remove warehouse rows whose key no longer exists in the source.

    Only the key columns of the source are read (pruned into the JDBC query
    or the file scan), once.  The removed keys of each table — target keys with no
    source key, found with distinct keys on both sides — are written once and become
    the source of a delete-only MERGE, so a key-range warehouse rewrites only the
    ranges that lose rows.

    ``by_digest``: the keys stay at the source; it is asked for digests of key ranges, and for keys only
    where these differ from the dimension's.  The fact then loses the rows of the removed articles: every
    article of the fact is in the dimension, which the same runs load.
    """
    run = _Run(spark, "reconcile_hard_deletes", _store(current), None, "fail")
    with run:
        tables = run.tables(current)
        merge = _merge_into(current, tables, strategy, broadcast_bytes, None)
        audit = run.result.audit
        keys = {} if by_digest else {
            table: run.scratch.keep(
                extract_full(spark, source, table).select(F.col("id").cast("bigint").alias("id")), f"keys-{table}"
            )
            for table in ("authors", "articles")
        }
        plan = [("dim_authors", "author_id", "authors"), ("dim_articles", "article_id", "articles"), (FACT, "article_id", "articles")]
        for name, key, src in plan:
            held = tables[name].select(key)
            if by_digest and name == FACT:  # ``removed`` holds the articles that left the dimension
                removed = held.join(removed, key, "left_semi").distinct()
            elif by_digest:
                removed = removed_by_digest(held, key, source, src, broadcast_bytes=broadcast_bytes).distinct()
            else:
                removed = hard_delete_removed(held, key, keys[src], "id").distinct()
            removed = audit.add(removed, f"removed_{name}", lambda out, n=name: run.scratch.keep(out, f"removed-{n}"))
            tables[name] = merge(name, removed, delete_spec(key))
    return tables


def apply_article_changes(
    spark: SparkSession,
    changes: DataFrame,
    current: dict[str, DataFrame] | Warehouse | RangedWarehouse,
    seq: str = "seq",
    op: str = "op",
    delete_code: str = "D",
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    tag: str | None = None,
    authors: DataFrame | None = None,
    author_changes: DataFrame | None = None,
    on_violation: str = "fail",
) -> dict[str, DataFrame]:
    """Apply a change feed of article rows (full images plus ``op``, ``seq``).

    The last change per article wins, whether the others come in the same feed or came in an earlier
    one: ``applied_articles`` holds the newest ``seq`` applied to each key, deleted keys included, and
    changes that are not newer are passed over, so feeds may arrive late, twice or in any order.  (A
    change without ``seq`` or key breaks a constraint.  Other loads leave that table alone.)

    The last change per article (``max_by``, partially aggregated) is written once; each table takes one
    MERGE that deletes and upserts.  The author dimension comes first, as in every load: ``authors`` is
    the whole author table, ``author_changes`` a feed of author rows; without either a new article's
    author must already be in the warehouse.
    """
    run = _Run(spark, "apply_article_changes", _store(current), None, on_violation, tag)
    with run:
        tables = run.tables(current)
        merge = _merge_into(current, tables, strategy, broadcast_bytes, tag)

        def note(table: str, accepted: DataFrame) -> None:
            name = f"applied_{table}"
            tables[name] = merge(name, accepted.select("id", seq, op), applied_spec("id", seq, op, delete_code))

        if authors is not None:
            staged = run.stage("authors", authors, tables["dim_authors"])
            tables["dim_authors"] = merge("dim_authors", staged, dims.authors_upsert_spec())
        if author_changes is not None:
            accepted = run.changes("authors", author_changes, tables, seq, op, delete_code, broadcast_bytes)
            if not accepted.isEmpty():
                spec = cdc_spec("author_id", "id", dims.AUTHOR_COPIED, op, delete_code)
                tables["dim_authors"] = merge("dim_authors", accepted, spec, part=":changes")
                note("authors", accepted)
        accepted = run.changes("articles", changes, tables, seq, op, delete_code, broadcast_bytes)
        if not accepted.isEmpty():
            spec = cdc_spec("article_id", "id", dims.ARTICLE_COPIED, op, delete_code)
            tables["dim_articles"] = merge("dim_articles", accepted, spec)
            # A deleted article is, for the fact, one that is not published any more.
            gone = F.col(op) == F.lit(delete_code)
            state = accepted.withColumn("published_at", F.when(~gone, F.col("published_at"))).drop(op, seq)
            source = run.scratch.keep(facts.fact_delta_source(state, tables["dim_authors"], broadcast_bytes), "fact-source")
            tables[FACT] = merge(FACT, source, facts.fact_merge_spec())
            note("articles", accepted)
    return tables


CHUNK = "__chunk"


def chunk_bounds(number: int, months: int) -> tuple[dt.date, dt.date]:
    """[lo, hi) of a chunk: chunks are counted from year 0, so an older row never moves the others."""
    lo, hi = (divmod(n * months, 12) for n in (number, number + 1))
    return dt.date(lo[0], lo[1] + 1, 1), dt.date(hi[0], hi[1] + 1, 1)


def _in_chunks(numbers, months: int):
    """Whether ``published_at`` lies in one of the chunks, as ranges that a scan or a source can apply."""
    spans: list[list[int]] = []
    for n in sorted(numbers):
        if spans and spans[-1][1] == n:
            spans[-1][1] = n + 1
        else:
            spans.append([n, n + 1])
    at, day = F.col("published_at"), lambda d: F.lit(dt.datetime(d.year, d.month, d.day)).cast("timestamp_ntz")
    each = [(at >= day(chunk_bounds(a, months)[0])) & (at < day(chunk_bounds(b, months)[0])) for a, b in spans]
    return reduce(lambda x, y: x | y, each)


def backfill_fact(
    spark: SparkSession,
    articles: DataFrame,
    dim_authors: DataFrame,
    months: int = 12,
    sink: str | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Full-load fact in chunks of ``published_at`` months.

    Chunks partition the fact's groups (each group has one ``published_at``), so the union equals the
    unchunked fact.  With ``sink`` the chunks are parts of a published table there.  A chunk is known by
    its bounds and a fingerprint of what it is made from (its live articles and the author keys): a rerun
    writes the chunks that are missing or whose input changed, all in one job, and lists no others; their
    months are ranges of ``published_at``, which the scan or the source applies.
    """
    if sink is None:
        return facts.fact_full_load(articles, dim_authors, broadcast_bytes)
    number = F.floor((F.year("published_at") * 12 + F.month("published_at") - 1) / F.lit(months)).cast("int")
    live = articles.filter(is_live()).withColumn(CHUNK, number)

    def print_of(*cols: str):
        return F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).cast("string"), F.count(F.lit(1))

    author_print = [str(x) for x in dim_authors.agg(*print_of("author_id")).first()]
    used = ("id", "author_id", "published_at", "created_at", "updated_at")
    prints = {}
    for r in live.groupBy(CHUNK).agg(*print_of(*used)).collect():  # one row per chunk
        lo, hi = chunk_bounds(r[0], months)
        prints[f"{lo:%Y%m%d}-{hi:%Y%m%d}"] = (r[0], [str(r[1]), str(r[2]), *author_print])
    table = PublishedTable(spark, sink, schemas.FACT_REPORTS_ARTICLES)
    done, old = table.refresh().get("prints", {}), table.state()["parts"]
    todo = {name: k for name, (k, p) in prints.items() if done.get(name) != p}
    parts = {name: old[name] for name in prints if name not in todo}
    if todo or set(old) != set(prints):
        if todo:
            out = table._folder()
            wanted = live.filter(_in_chunks(todo.values(), months))
            fact = facts.fact_full_load(wanted.drop(CHUNK), dim_authors, broadcast_bytes)
            # The fact keeps the day of publication, which tells the chunk.
            day = F.col("published_date_at")
            month = F.floor(day / 10000) * 12 + F.floor(day / 100) % 100 - 1
            fact = fact.withColumn(CHUNK, F.floor(month / F.lit(months)).cast("int"))
            fact.hint("rebalance", CHUNK).write.partitionBy(CHUNK).parquet(out)
            made = set(fs.list_names(spark, out))
            parts |= {name: f"{out}/{CHUNK}={k}" for name, k in todo.items() if f"{CHUNK}={k}" in made}
        table._point(parts, None, prints={name: p for name, (_, p) in prints.items()})
    return table.read()
