"""Key-range tables: an incremental MERGE rewrites only the ranges it touches.

Rows live in ranges of the merge key, ``range = floor(key / width)`` (NULL keys in range -1), one folder
each; the table's pointer lists the current folder of every range.  Article and author ids grow over
time, so an hourly delta (new articles plus edits of recent ones) touches a handful of ranges, not the
whole table: the rewrite cost follows the delta.  The width is set per table from the bytes of its
first content, so that a range of wide rows is no larger than one of narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contentmart.operators import merge as M
from contentmart.operators.sizing import Size, row_bytes
from contentmart.sources import fs
from contentmart.sources.publish import BaseWarehouse, PublishedTable, SnapshotTable, record_layout

RANGE = "__range"
#: Bytes aimed at for one range, before compression.
RANGE_BYTES = 4 << 30


def key_range(key: Column | str, width: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.floor(k / F.lit(width)).cast("long"), F.lit(-1).cast("long"))


def width_for(df: DataFrame, key: str, range_bytes: int = RANGE_BYTES) -> int | None:
    """Keys in a range of about ``range_bytes``, from one aggregation over ``df``; None if it is empty."""
    total, low, high = df.agg(F.sum(row_bytes(df)), F.min(key), F.max(key)).first()
    if low is None:
        return None
    per_key = max(1.0, total / (high - low + 1))
    return max(1, int(range_bytes / per_key))


class KeyRangeTable(PublishedTable):
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        key: str,
        width: int | None = None,
        sort_by: list[str] | None = None,
        range_bytes: int = RANGE_BYTES,
    ):
        super().__init__(spark, root, schema)
        self.key = key
        self.asked_width = width
        self.range_bytes = range_bytes
        # Rows are ordered by these inside each file, so parquet min/max
        # statistics let filters on them skip row groups within a range.
        self.sort_by = sort_by or [key]

    @property
    def width(self) -> int | None:
        """The table's width once it has content: what was asked for, else measured, then kept."""
        return self.state().get("width")

    def _decide(self, df: DataFrame) -> int | None:
        return self.width or self.asked_width or width_for(df, self.key, self.range_bytes)

    def ranges(self) -> dict[int, str]:
        """range -> folder of its current content (one entry per range)."""
        return {int(r): path for r, path in self.state()["parts"].items()}

    def read_ranges(self, wanted: list[int]) -> DataFrame:
        current = self.ranges()
        return self._read(sorted(current[r] for r in wanted if r in current))

    def _write(self, df: DataFrame, width: int, watch=None) -> dict[int, str]:
        """Write ``df`` to a fresh folder; the range folders that this write made."""
        out = self._folder()
        # Rebalance: AQE splits a hot range over several writers and packs small ones.
        # The writer needs rows grouped by range; the clustering sort extends that order.
        ready = (
            self._shaped(df)
            .withColumn(RANGE, key_range(self.key, width))
            .hint("rebalance", RANGE)
            .sortWithinPartitions(RANGE, *self.sort_by)
        )
        (watch(ready) if watch else ready).write.partitionBy(RANGE).parquet(out)
        names = [n for n in fs.list_names(self.spark, out) if n.startswith(f"{RANGE}=")]
        return {int(n.split("=", 1)[1]): f"{out}/{n}" for n in names}

    def _list(self, parts: dict[int, str], tag: str | None, width: int | None) -> int:
        return self._point({str(r): p for r, p in sorted(parts.items())}, tag, width=width)

    def publish(self, df: DataFrame, tag: str | None = None, watch=None) -> int:
        """Replace the whole content (full load / refresh); ``watch`` as for snapshots."""
        if self.applied(tag):
            return self.current_version()
        width = self._decide(df)
        if not width:  # no rows, so no width yet
            if watch:
                watch(df).foreach(lambda row: None)
            return self._list({}, tag, None)
        return self._list(self._write(df, width, watch), tag, width)

    def touched_ranges(self, source: DataFrame, source_key: str) -> list[int] | None:
        """Distinct ranges of the source keys (at most one value per range); None before there are ranges."""
        if not self.width:
            return None
        return sorted(int(r[0]) for r in source.select(key_range(source_key, self.width)).distinct().collect())

    def merge(
        self,
        source: DataFrame,
        spec: M.MergeSpec,
        strategy: str = "auto",
        broadcast_bytes: int | None = None,
        source_bound: Size | None = None,
        tag: str | None = None,
    ) -> int:
        """MERGE ``source`` into the table, rewriting only the touched ranges.

        Inserted rows must carry the source key as their target key (true of
        every upsert, CDC and fact merge here), so they land in touched ranges.
        ``source`` is read more than once: hand in a staged frame.
        """
        if self.applied(tag):
            return self.current_version()
        if spec.target_key != self.key:
            raise ValueError(f"table is ranged on {self.key}, merge matches on {spec.target_key}")
        touched = self.touched_ranges(source, spec.source_key)
        if touched is None:  # nothing published yet: the merge makes the first content
            merged = M.merge(self.read(), source, spec, strategy, broadcast_bytes, source_bound, staged=True)
            return self.publish(merged, tag)
        if not touched:
            return self.current_version()
        merged = M.merge(self.read_ranges(touched), source, spec, strategy, broadcast_bytes, source_bound, staged=True)
        written = self._write(merged, self.width)
        stray = sorted(set(written) - set(touched))
        if stray:
            raise ValueError(f"merge wrote rows outside the touched key ranges: {stray[:10]}")
        kept = {r: p for r, p in self.ranges().items() if r not in touched}
        return self._list({**kept, **written}, tag, self.width)


class RangedWarehouse(BaseWarehouse):
    """The warehouse tables as key-range tables (the calendar as a snapshot).

    ``width`` (keys per range) is for tests and special cases; without it each table measures its own.
    """

    KEYS = {"dim_authors": "author_id", "dim_articles": "article_id", "fact_reports_articles": "article_id"}
    # The fact is clustered by date inside each key range (date-range reports prune row groups).
    SORT = {"fact_reports_articles": ["published_date_at", "article_id"]}

    def __init__(self, spark: SparkSession, root: str, width: int | None = None, range_bytes: int = RANGE_BYTES):
        from contentmart import schemas

        self.spark, self.root = spark, root
        width = record_layout(spark, root, {"layout": "ranged", "width": width}).get("width", width)
        tables = {
            name: self._table(KeyRangeTable, name, key, width, self.SORT.get(name), range_bytes)
            for name, key in self.KEYS.items()
        }
        tables["dim_date"] = self._table(SnapshotTable, "dim_date")
        books = {name: self._table(KeyRangeTable, name, "id", width, None, range_bytes) for name in schemas.APPLIED}
        self._open(spark, root, tables, books)

    def merge(self, name: str, source: DataFrame, spec: M.MergeSpec, **kw) -> int:
        return self.of(name).merge(source, spec, **kw)
