"""Extract: whole tables or change windows, from JDBC, files or frames.

A JDBC read is split on the numeric key into ``partitions`` slices of about
equal rows, so each executor pulls its own share (no whole table through one
worker, and none that gets a dense range of ids to itself): the source counts
its keys in ranges, ranges with many keys are counted again in finer ones, and
the slices are cut at those counts.  The change predicate is a plain column
filter that Spark pushes into the JDBC query and into parquet row-group
statistics.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contentmart.functions.predicates import changed_since

THRESHOLD_FORMAT = "%Y-%m-%d %H:%M:%S"  # fixed text layout of the change threshold


@dataclass(frozen=True)
class JdbcSource:
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    partition_column: str = "id"
    partitions: int = 8  # slices of a read
    fetch_size: int = 10_000  # rows a driver may hold of one slice at a time


@dataclass(frozen=True)
class FileSource:
    """parquet / orc / json / csv folder per table: ``{root}/{table}``."""

    root: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, StructType] = field(default_factory=dict)


#: Ranges counted at once for each slice; a range is cut no finer than a quarter of a slice needs.
RANGES_PER_SLICE = 8


def key_counts(spark: SparkSession, src: JdbcSource, table: str, ranges: list[tuple[int, int, int]], where: str = "") -> list[tuple[int, int, int]]:
    """(low, width, rows) of the key ranges that hold rows, counted by the source.

    ``ranges`` are (low, high, width): keys from low to high, counted in steps of width.  The source
    returns one row a step, and nothing of the table itself.
    """
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(src.url)
    key = dialect.quoteIdentifier(src.partition_column)
    asked = [
        f"SELECT {low} AS lo, {width} AS wd, ({key} - {low}) / {width} AS step FROM {table} "
        f"WHERE {key} >= {low} AND {key} < {high}{where}"
        for low, high, width in ranges
    ]
    counted = f"(SELECT lo, wd, step, COUNT(*) AS n FROM ({' UNION ALL '.join(asked)}) a GROUP BY lo, wd, step) h"
    rows = spark.read.jdbc(src.url, counted, properties=src.properties).collect()
    return sorted((int(r[0]) + int(r[1]) * int(r[2]), int(r[1]), int(r[3])) for r in rows)


def slice_cuts(count, low: int, high: int, slices: int) -> list[int]:
    """Keys at which [low, high] is cut into ``slices`` parts of about equal rows.

    ``count(ranges)`` counts as ``key_counts`` does.  A range with more than a quarter of a slice's rows
    is counted again in finer steps until none is left or single keys are reached, so no part is more
    than a quarter of a slice off its share.
    """
    steps = slices * RANGES_PER_SLICE
    found = count([(low, high + 1, max(1, -(-(high + 1 - low) // steps)))])
    total = sum(n for *_, n in found)
    fair = total / slices
    while True:
        coarse = [(lo, lo + width, max(1, -(-width // RANGES_PER_SLICE))) for lo, width, n in found if width > 1 and n > fair / 4]
        if not coarse:
            break
        fine: list[tuple[int, int, int]] = []
        for at in range(0, len(coarse), 64):  # a statement of bounded length
            fine += count(coarse[at : at + 64])
        again = {lo for lo, *_ in coarse}
        found = sorted([f for f in found if f[0] not in again or f[1] == 1] + fine)
    cuts, before = [], 0
    for lo, width, n in found:
        before += n
        if before >= fair * (len(cuts) + 1) and len(cuts) < slices - 1:
            cuts.append(lo + width)
    return [c for c in dict.fromkeys(cuts) if c <= high]


def _jdbc(spark: SparkSession, src: JdbcSource, table: str, ts_col: str | None = None, since=None, until=None) -> DataFrame:
    """``table`` in key slices, each pulled by its own task.

    With a change window the slices are those of the changed rows: a delta of recent ids would
    otherwise fall into the last slice alone.  The outer slices are open, and the first holds rows
    without a key, so rows that arrive meanwhile are in one of them.
    """
    props = {"fetchsize": str(src.fetch_size), **src.properties}
    rows = spark.read.jdbc(src.url, table, properties=props)
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(src.url).quoteIdentifier
    where = ""
    if ts_col is not None and since is not None:
        rows = rows.filter(changed_since(ts_col, since, until))
        where = f" AND {quote(ts_col)} >= '{since}'" + (f" AND {quote(ts_col)} < '{until}'" if until is not None else "")
    col = src.partition_column
    lo, hi = rows.agg(F.min(f"`{col}`"), F.max(f"`{col}`")).first()  # pushed into the database
    if lo is None or src.partitions <= 1:
        return spark.read.jdbc(src.url, table, properties=props)
    cuts = slice_cuts(lambda r: key_counts(spark, src, table, r, where), int(lo), int(hi), src.partitions)
    key = quote(col)
    if not cuts:
        return spark.read.jdbc(src.url, table, properties=props)
    slices = [f"{key} < {cuts[0]} OR {key} IS NULL"]
    slices += [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return spark.read.jdbc(src.url, table, predicates=[*slices, f"{key} >= {cuts[-1]}"], properties=props)


def extract_months(spark: SparkSession, src: JdbcSource, table: str, ts_col: str, start: dt.date, end: dt.date, months: int = 1) -> DataFrame:
    """Rows with ``ts_col`` in [start, end), one slice for each ``months`` months, picked by the source."""
    bounds, at = [], start
    while at < end:
        number = at.year * 12 + at.month - 1 + months
        after = min(end, dt.date(number // 12, number % 12 + 1, 1))
        bounds.append((at, after))
        at = after
    if not bounds:
        raise ValueError(f"no month between {start} and {end}")
    col = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(src.url).quoteIdentifier(ts_col)
    slices = [f"{col} >= '{a} 00:00:00' AND {col} < '{b} 00:00:00'" for a, b in bounds]
    props = {"fetchsize": str(src.fetch_size), **src.properties}
    return spark.read.jdbc(src.url, table, predicates=slices, properties=props)


def extract_changes(spark: SparkSession, source, table: str, ts_col: str | None, since, until=None) -> DataFrame:
    """The changed rows of ``table`` (all of them without ``ts_col`` or ``since``)."""
    if isinstance(source, JdbcSource):
        return extract_delta(_jdbc(spark, source, table, ts_col, since, until), ts_col, since, until)
    return extract_delta(extract_full(spark, source, table), ts_col, since, until)


def extract_full(spark: SparkSession, source, table: str) -> DataFrame:
    """Every row and every column of ``table`` (declared column order)."""
    if isinstance(source, DataFrame):
        return source.select("*")
    if isinstance(source, dict):
        return source[table].select("*")
    if isinstance(source, JdbcSource):
        return _jdbc(spark, source, table)
    if isinstance(source, FileSource):
        reader = spark.read.format(source.format).options(**source.options)
        if table in source.schemas:
            reader = reader.schema(source.schemas[table])
        return reader.load(f"{source.root.rstrip('/')}/{table}")
    raise TypeError(f"unsupported source {type(source).__name__}")


def extract_delta(
    df: DataFrame,
    ts_col: str | None,
    since: str | dt.datetime | None,
    until: str | dt.datetime | None = None,
) -> DataFrame:
    """Rows with ``ts_col >= since`` (and ``< until`` if given).

    ``ts_col=None`` pulls the table whole (how the authors table travels in
    the delta run).
    """
    if ts_col is None or since is None:
        return df
    return df.filter(changed_since(ts_col, since, until))


def resolve_since(interval_start: dt.datetime | None, now: dt.datetime | None = None) -> str:
    """The change threshold as text: the scheduled interval start, else now - 1 day."""
    if interval_start is not None:
        return interval_start.strftime(THRESHOLD_FORMAT)
    moment = now if now is not None else dt.datetime.now()
    return (moment - dt.timedelta(days=1)).strftime(THRESHOLD_FORMAT)


def since_one_day_before_latest(df: DataFrame, ts_col: str) -> str | None:
    """Deterministic fallback: one day before the newest change (one scalar)."""
    latest = df.agg(F.max(ts_col)).first()[0]
    return None if latest is None else resolve_since(None, now=latest)


def values_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A literal-row source (multi-row VALUES)."""
    return spark.createDataFrame(rows, schema)


def parameterised_delta(spark: SparkSession, view: str, ts_col: str, since: str) -> DataFrame:
    """``SELECT * FROM view WHERE ts_col >= :since`` with a bound parameter."""
    return spark.sql(
        f"SELECT * FROM {view} WHERE {ts_col} >= CAST(:since AS TIMESTAMP_NTZ)",
        args={"since": since},
    )
