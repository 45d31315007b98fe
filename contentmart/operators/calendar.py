"""Calendar generator and the date dimension.

Days come from ``spark.range`` (split across tasks, one row per day) plus
``date_add`` — no recursion, no single-row ``sequence`` array.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart.functions.dates import date_key, day_parts

# Fixed bounds of the reference's calendar (inclusive).
DIM_DATE_START = "2016-01-01"
DIM_DATE_END = "2030-12-31"


def _as_date(value: str | dt.date | dt.datetime) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def calendar(spark: SparkSession, start: str | dt.date, end: str | dt.date, partitions: int | None = None) -> DataFrame:
    """One row per day, ``date`` from ``start`` to ``end`` inclusive."""
    first, last = _as_date(start), _as_date(end)
    days = (last - first).days + 1
    if days <= 0:
        return spark.range(0).select(F.lit(first).alias("date"))
    n = partitions or max(1, min(spark.sparkContext.defaultParallelism, days // 4096 + 1))
    return spark.range(0, days, 1, n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))


def dim_date_from(days: DataFrame) -> DataFrame:
    parts = day_parts("date")
    return days.select(
        date_key("date").alias("published_date_at"),
        F.col("date"),
        parts["day"].alias("day"),
        parts["month"].alias("month"),
        parts["year"].alias("year"),
        parts["quarter"].alias("quarter"),
    )


def dim_date(spark: SparkSession, start: str | dt.date = DIM_DATE_START, end: str | dt.date = DIM_DATE_END) -> DataFrame:
    """key YYYYMMDD, date, day, month, year, quarter for every day in range."""
    return dim_date_from(calendar(spark, start, end))


def covering_bounds(df: DataFrame, ts_col: str) -> tuple[dt.date, dt.date] | None:
    """(first, last) day of a timestamp column — one aggregate, two scalars."""
    row = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    if row["lo"] is None:
        return None
    return _as_date(row["lo"]), _as_date(row["hi"])
