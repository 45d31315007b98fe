"""The warehouse's tables as tables of Spark's own catalog, for loads and reports written in SQL.

``CREATE TABLE … USING parquet`` with what the DDL declares: text lengths, which Spark then checks on
every insert, and column defaults, which an INSERT with a column list fills in.  The fact is partitioned
by year: a reload of some years leaves the others alone, and a report that joins the calendar reads the
years it needs only.

A reload that fails leaves the table as it was: the whole table is written to a new folder and takes the
name when it is complete, years are written aside and moved at the job's commit.  The old files go at once,
so readers that must finish on old content use the ``Warehouse``.  NOT NULL and keys are checked before the
load, as for the other layouts (``operators.quality``): Spark's file tables do not check them.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType

from contentmart import schemas
from contentmart.sources import fs

FACT = "fact_reports_articles"
#: Column that the fact is partitioned by: the year of its date key, derived by the loads below.
FACT_YEAR = "published_year"


def _column(name: str, type_text: str, default: str | None) -> str:
    return f"`{name}` {type_text}" + (f" DEFAULT {default}" if default is not None else "")


def create_table(spark: SparkSession, identifier: str, table: str, root: str) -> str:
    """Create the empty warehouse table ``table`` as ``identifier``, its files in a new folder under ``root``."""
    limits, defaults = schemas.VARCHAR_LIMITS.get(table, {}), schemas.COLUMN_DEFAULTS.get(table, {})
    columns = []
    for f in schemas.WAREHOUSE[table].fields:
        text = isinstance(f.dataType, StringType) and f.name in limits
        columns.append(_column(f.name, f"VARCHAR({limits[f.name]})" if text else f.dataType.simpleString(), defaults.get(f.name)))
    partitioned = ""
    if table == FACT:
        columns.append(f"`{FACT_YEAR}` INT")
        partitioned = f" PARTITIONED BY (`{FACT_YEAR}`)"
    location = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {identifier} ({', '.join(columns)}) USING parquet{partitioned} LOCATION '{location}'")
    return identifier


def location_of(spark: SparkSession, identifier: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {identifier}").filter("col_name = 'Location'").collect()
    return rows[-1]["data_type"].rstrip("/")


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def year_of(date_key: str) -> str:
    """SQL for the year of a YYYYMMDD key."""
    return f"CAST({date_key} DIV 10000 AS INT)"


def reload_table(
    spark: SparkSession, identifier: str, table: str, view: str, columns: list[str] | None = None, years_only: bool = False
) -> None:
    """Replace the catalog table by the rows of a view, bound by name.

    ``columns`` are those the view gives (all without it); the others get their declared default, or
    NULL.  ``years_only`` replaces just the years of the fact that the view has rows for.
    """
    if years_only and table != FACT:
        raise ValueError(f"{table} is not partitioned")
    names = columns if columns is not None else schemas.column_names(schemas.WAREHOUSE[table])
    listed = [f"`{c}`" for c in names]
    given, order = list(listed), ""
    if table == FACT:
        if "published_date_at" not in names:
            raise ValueError("the fact's year comes from published_date_at")
        listed.append(f"`{FACT_YEAR}`")
        given.append(year_of("published_date_at"))
        # A year's rows come together, in pieces of the advised size: few files, and no task with a whole hot year.
        order = f"/*+ REBALANCE(`{FACT_YEAR}`) */ "
    named = ", ".join(f"{g} AS {c}" for g, c in zip(given, listed, strict=True))
    insert = f"({', '.join(listed)}) SELECT {order}* FROM (SELECT {named} FROM {view})"
    if years_only:
        with _overwrite_mode(spark, "dynamic"):
            spark.sql(f"INSERT OVERWRITE TABLE {identifier} {insert}")
        return
    old = location_of(spark, identifier)
    fresh = create_table(spark, f"{identifier}_{uuid.uuid4().hex}", table, os.path.dirname(old))
    try:
        spark.sql(f"INSERT INTO {fresh} {insert}")
    except BaseException:
        left = location_of(spark, fresh)
        spark.sql(f"DROP TABLE {fresh}")
        fs.delete(spark, left)
        raise
    spark.sql(f"DROP TABLE {identifier}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {identifier}")
    fs.delete(spark, old)
