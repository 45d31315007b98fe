"""Published tables: parquet folders and pointers.

A publish writes its rows to a folder of its own, then puts up the next pointer, a small file that
lists the folders the table now consists of.  The pointer is created only where its number is free:
of two writers one wins and the other gets ``PublishConflict``, and nothing that a crashed or beaten
attempt wrote is ever listed.  Readers see the newest pointer; the pointer also carries the last batch
that each stream applied, so a replayed batch is recognised however old the last vacuum is.

The tables of a warehouse share one pointer (``Catalog``).  A run publishes its tables inside
``catalog.run()``: the pointer that names all of them is put up once, when the run ends.  A run that
stops between two tables leaves the warehouse as it was, and no reader sees tables of two runs.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contentmart.operators import merge as M
from contentmart.operators.sizing import measure
from contentmart.sources import fs

#: Unlisted folders younger than this may belong to a running writer; ``vacuum`` leaves them.
GRACE_SECONDS = 24 * 3600


class PublishConflict(RuntimeError):
    """Another writer published first; run the step again from the new content."""


def split_tag(tag: str) -> tuple[str, int]:
    """``stream#batch`` -> (stream, batch); any other tag is a stream with the one batch 0."""
    stream, sep, batch = tag.rpartition("#")
    if sep and batch.isdigit():
        return stream, int(batch)
    return tag, 0


def _newest(spark: SparkSession, folder: str) -> dict | None:
    names = [n for n in fs.list_names(spark, folder) if n.endswith(".json") and n[:-5].isdigit()]
    return json.loads(fs.read_text(spark, f"{folder}/{max(names)}")) if names else None


def _put_up(spark: SparkSession, folder: str, state: dict) -> None:
    """Create the pointer of the state's version; ``FileExistsError`` if another writer has."""
    fs.create_text(spark, f"{folder}/{state['version']:08d}.json", json.dumps(state))


def _drop_older(spark: SparkSession, folder: str, version: int, oldest_ms: float) -> None:
    for name in fs.list_names(spark, folder):
        path = f"{folder}/{name}"
        if name != f"{version:08d}.json" and fs.modified_ms(spark, path) <= oldest_ms:
            fs.delete(spark, path)


class Catalog:
    """The pointer that the tables of one warehouse share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._state: dict | None = None
        self._pending: dict[str, dict] | None = None

    @property
    def _pointers(self) -> str:
        return f"{self.root}/_pointer"

    def refresh(self) -> dict:
        """Read the newest pointer; inside a run, what the run began with stays."""
        if self._pending is None or self._state is None:
            self._state = _newest(self.spark, self._pointers) or {"version": 0, "tables": self._own_pointers()}
        return self._state

    def _own_pointers(self) -> dict[str, dict]:
        """What tables say that were published one by one, before they had a pointer in common."""
        names = fs.list_names(self.spark, self.root)
        found = {n: _newest(self.spark, f"{self.root}/{n}/_pointer") for n in names if not n.startswith("_")}
        return {n: state for n, state in found.items() if state}

    def table(self, name: str) -> dict | None:
        """A table's state, as the run that is under way has left it."""
        if self._pending and name in self._pending:
            return self._pending[name]
        return (self._state or self.refresh())["tables"].get(name)

    def put(self, name: str, state: dict) -> None:
        """Take over a table's new state: published with the run, or at once outside of one."""
        if self._pending is not None:
            self._pending[name] = state
            return
        self._state = self._state or self.refresh()
        self._publish({name: state})

    @contextmanager
    def run(self):
        """Publish what is put meanwhile in one step at the end, or nothing if the run fails.

        A run inside another is part of it.
        """
        if self._pending is not None:
            yield self
            return
        self.refresh()
        self._pending = {}
        try:
            yield self
            made, self._pending = self._pending, None
            if made:
                self._publish(made)
        finally:
            self._pending = None

    def _publish(self, made: dict[str, dict]) -> None:
        new = {"version": self._state["version"] + 1, "tables": {**self._state["tables"], **made}}
        try:
            _put_up(self.spark, self._pointers, new)
        except FileExistsError:
            self.refresh()
            raise PublishConflict(f"{self.root}: version {new['version']} was published by another run") from None
        self._state = new

    def vacuum(self, grace_seconds: float) -> None:
        version = self.refresh()["version"]
        _drop_older(self.spark, self._pointers, version, (time.time() - grace_seconds) * 1000)


class PublishedTable:
    """What the snapshot and the key-range tables share: folders, pointer, applied batches.

    With a ``catalog`` the table's state is part of the warehouse's pointer, under ``name``.
    """

    catalog: Catalog | None = None
    name = ""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema

    def of(self, catalog: Catalog, name: str):
        """This table as one of a warehouse."""
        self.catalog, self.name = catalog, name
        return self

    @property
    def _pointers(self) -> str:
        return f"{self.root}/_pointer"

    def refresh(self) -> dict:
        """Read the newest pointer (one small file)."""
        if self.catalog is not None:
            self.catalog.refresh()
            return self.state()
        self._state = _newest(self.spark, self._pointers) or self._nothing()
        return self._state

    @staticmethod
    def _nothing() -> dict:
        return {"version": 0, "parts": {}, "applied": {}}

    def state(self) -> dict:
        if self.catalog is not None:
            return self.catalog.table(self.name) or self._nothing()
        return getattr(self, "_state", None) or self.refresh()

    def current_version(self) -> int:
        return int(self.state()["version"])

    def applied(self, tag: str | None) -> bool:
        """Whether the batch, or a later one of its stream, is already in the table."""
        if tag is None:
            return False
        stream, batch = split_tag(tag)
        return batch <= self.state()["applied"].get(stream, -1)

    def _folder(self) -> str:
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def _point(self, parts: dict[str, str], tag: str | None, **extra) -> int:
        """Put up the next pointer, or raise ``PublishConflict`` if its number is taken."""
        old = self.state()
        applied = dict(old["applied"])
        if tag is not None:
            stream, batch = split_tag(tag)
            applied[stream] = max(batch, applied.get(stream, -1))
        new = {**old, **extra, "version": old["version"] + 1, "parts": parts, "applied": applied}
        if self.catalog is not None:
            self.catalog.put(self.name, new)
            return new["version"]
        try:
            _put_up(self.spark, self._pointers, new)
        except FileExistsError:
            self.refresh()
            raise PublishConflict(f"{self.root}: version {new['version']} was published by another writer") from None
        self._state = new
        return new["version"]

    def _shaped(self, df: DataFrame) -> DataFrame:
        if self.schema is None:
            return df
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            if self.schema is None:
                raise FileNotFoundError(f"nothing is published under {self.root}")
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return self._shaped(reader.parquet(*paths))

    def read(self) -> DataFrame:
        return self._read(sorted(self.state()["parts"].values()))

    def vacuum(self, grace_seconds: float = GRACE_SECONDS) -> list[str]:
        """Delete folders that the current pointer does not list, and older pointers.

        Neither is part of the table; what a reader or writer may still be using is spared by its age.
        """
        self.refresh()
        listed = set(self.state()["parts"].values())
        oldest = (time.time() - grace_seconds) * 1000
        removed = []
        for name in fs.list_names(self.spark, f"{self.root}/data"):
            attempt = f"{self.root}/data/{name}"
            inside = [p for p in listed if p == attempt or p.startswith(attempt + "/")]
            if fs.modified_ms(self.spark, attempt) > oldest:
                continue
            if not inside:
                fs.delete(self.spark, attempt)
                removed.append(attempt)
                continue
            for part in fs.list_names(self.spark, attempt):
                path = f"{attempt}/{part}"
                if "=" in part and path not in listed:
                    fs.delete(self.spark, path)
                    removed.append(path)
        if self.catalog is None:
            _drop_older(self.spark, self._pointers, self.current_version(), oldest)
        return removed


class SnapshotTable(PublishedTable):
    """A table that every publish replaces whole.

    ``sort_by``: rows are dealt to files by ranges of these columns, so that file statistics prune
    filters on them.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType | None = None, sort_by: list[str] | None = None):
        super().__init__(spark, root, schema)
        self.sort_by = sort_by or []

    def publish(self, df: DataFrame, tag: str | None = None, columns: list[str] | None = None, watch=None) -> int:
        """Replace the content by ``df`` (optionally with a named column list); a batch applied
        before (``tag``) is not written again.  ``watch`` wraps the frame that is written, so that
        what it observes is what was written."""
        if self.applied(tag):
            return self.current_version()
        out = insert_columns(df, columns, self.schema) if columns is not None else self._shaped(df)
        if self.sort_by:
            out = out.repartitionByRange(*self.sort_by).sortWithinPartitions(*self.sort_by)
        path = self._folder()
        (watch(out) if watch else out).write.parquet(path)
        return self._point({"all": path}, tag)


class AppendTable(PublishedTable):
    """A table that every publish adds a part to; many small parts become one."""

    PARTS = 64

    def publish(self, df: DataFrame, tag: str | None = None, watch=None) -> int:
        if self.applied(tag):
            return self.current_version()
        parts = dict(self.state()["parts"])
        out = self._shaped(df)
        if len(parts) >= self.PARTS:
            out, parts = self.read().unionByName(out).coalesce(1), {}
        path = self._folder()
        (watch(out) if watch else out).write.parquet(path)
        return self._point({**parts, os.path.basename(path): path}, tag)


class BucketedTable(PublishedTable):
    """A table stored in buckets of its merge key, so that a merge does not shuffle it.

    The bucket layout is Spark's own; each session declares the published folder as a table of its
    catalog.  The merge's result is partitioned as the buckets are, so writing it moves no rows either.

    One task merges a bucket and sorts it, its source rows and their result, so a bucket is a small part
    of a task's memory.  Buckets that table and source have outgrown are dealt anew by the merge.
    """

    #: Bytes aimed at for one bucket, before compression.
    BUCKET_BYTES = 64 << 20
    #: Buckets at most, the limit that Spark sets itself.
    MAX_BUCKETS = 100_000
    #: How many times the aim a bucket and its source rows may grow to before buckets are dealt anew.
    SLACK = 4

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, buckets: int | None = None):
        super().__init__(spark, root, schema)
        self.key, self.asked_buckets = key, buckets

    @property
    def buckets(self) -> int | None:
        """Buckets of the content: what was asked for, else measured by the first publish, then kept until
        a merge finds them outgrown."""
        return self.state().get("buckets")

    def _buckets_for(self, size: int) -> int:
        return min(self.MAX_BUCKETS, max(1, -(-size // self.BUCKET_BYTES)))

    def _declared(self, path: str) -> str:
        return f"contentmart_{os.path.basename(path)}"

    def read(self) -> DataFrame:
        parts = self.state()["parts"]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        name, path = self._declared(parts["all"]), parts["all"]
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(
                f"CREATE TABLE `{name}` ({columns}) USING parquet "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(name)

    def publish(self, df: DataFrame, tag: str | None = None, watch=None) -> int:
        if self.applied(tag):
            return self.current_version()
        buckets = self.buckets or self.asked_buckets or self._buckets_for(measure(df).bytes)
        rows = self._shaped(df).repartition(buckets, self.key)
        return self._store(watch(rows) if watch else rows, buckets, tag)

    def _store(self, rows: DataFrame, buckets: int, tag: str | None) -> int:
        path = self._folder()
        writer = rows.write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key)
        writer.option("path", path).saveAsTable(self._declared(path))
        return self._point({"all": path}, tag, buckets=buckets)

    def merge(self, source: DataFrame, spec: M.MergeSpec, tag: str | None = None) -> int:
        """MERGE a staged ``source`` (it is read more than once) into the table."""
        if self.applied(tag):
            return self.current_version()
        if spec.target_key != self.key:
            raise ValueError(f"table is bucketed on {self.key}, merge matches on {spec.target_key}")
        target, buckets = self.read(), self.buckets
        size = measure(source)
        if buckets and not self.asked_buckets:
            wanted = self._buckets_for(measure(target).bytes + size.bytes)
            if wanted > self.SLACK * buckets:
                merged = M.merge(target, source, spec, source_bound=size, staged=True)
                return self._store(self._shaped(merged).repartition(wanted, self.key), wanted, tag)
        merged = M.merge(target, source, spec, source_bound=size, staged=True, buckets=buckets)
        return self._store(self._shaped(merged), buckets, tag) if buckets else self.publish(merged, tag)


def insert_columns(df: DataFrame, columns: list[str], schema: StructType | None) -> DataFrame:
    """INSERT INTO t (c1, c2, ...) SELECT ...: bind by the named list, NULL for the rest."""
    if len(columns) != len(df.columns):
        raise ValueError("column list and select list differ in length")
    named = df.toDF(*columns)
    if schema is None:
        return named
    return named.select(
        *[
            (F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_layout(spark: SparkSession, root: str) -> dict | None:
    """The layout a warehouse was created with (``_layout.json``), if any."""
    path = f"{root.rstrip('/')}/_layout.json"
    if not fs.exists(spark, path):
        return None
    return json.loads(fs.read_text(spark, path))


def record_layout(spark: SparkSession, root: str, layout: dict) -> dict:
    """Write the layout on first use; afterwards the recorded one wins."""
    current = read_layout(spark, root)
    if current is None:
        try:
            fs.create_text(spark, f"{root.rstrip('/')}/_layout.json", json.dumps(layout))
            return layout
        except FileExistsError:
            current = read_layout(spark, root)
    if current.get("layout") != layout.get("layout"):
        raise ValueError(f"{root} is a {current.get('layout')} warehouse")
    return current


class BaseWarehouse:
    """Tables that are published together: one pointer names the folders of all of them.

    ``tables`` are those of the star schema; ``books`` hold what the load jobs keep for themselves (the
    newest change applied per key, the counts of every run).
    """

    def _open(self, spark: SparkSession, root: str, tables: dict[str, PublishedTable], books: dict[str, PublishedTable]) -> None:
        self.spark, self.root = spark, root
        self.catalog = Catalog(spark, root)
        self.tables = {name: t.of(self.catalog, name) for name, t in tables.items()}
        self.books = {name: t.of(self.catalog, name) for name, t in books.items()}
        self.books["load_audit"] = self._table(AppendTable, "load_audit").of(self.catalog, "load_audit")

    def _table(self, kind, name: str, *args) -> PublishedTable:
        from contentmart import schemas

        return kind(self.spark, os.path.join(self.root, name), {**schemas.WAREHOUSE, **schemas.BOOKS}[name], *args)

    def of(self, name: str) -> PublishedTable:
        return self.tables[name] if name in self.tables else self.books[name]

    def read(self, name: str) -> DataFrame:
        return self.of(name).read()

    def publish(self, name: str, df: DataFrame, tag: str | None = None, **kw) -> int:
        return self.of(name).publish(df, tag, **kw)

    def run(self):
        """What is published inside is seen at once when the run ends, or never."""
        return self.catalog.run()

    def vacuum(self, grace_seconds: float = GRACE_SECONDS) -> list[str]:
        removed = [p for t in [*self.tables.values(), *self.books.values()] for p in t.vacuum(grace_seconds)]
        self.catalog.vacuum(grace_seconds)
        return removed

    def refresh(self) -> None:
        """Re-read the pointer (picks up what other processes published)."""
        self.catalog.refresh()


class Warehouse(BaseWarehouse):
    """The four warehouse tables as snapshot tables under one root."""

    # Reports filter the fact by date.
    SORT = {"fact_reports_articles": ["published_date_at", "article_id"]}

    def __init__(self, spark: SparkSession, root: str):
        from contentmart import schemas

        self.spark, self.root = spark, root
        record_layout(spark, root, {"layout": "snapshot"})
        tables = {name: self._table(SnapshotTable, name, self.SORT.get(name)) for name in schemas.WAREHOUSE}
        self._open(spark, root, tables, {name: self._table(SnapshotTable, name) for name in schemas.APPLIED})


def register_views(warehouse, prefix: str = "") -> list[str]:
    """CREATE OR REPLACE TEMP VIEW for each warehouse table (current content).

    Works for both layouts; reports can then be plain ``spark.sql`` over
    ``{prefix}dim_authors``, ``{prefix}fact_reports_articles`` and so on.
    """
    names = []
    for name in warehouse.tables:
        warehouse.read(name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
