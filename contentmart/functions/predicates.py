"""Row predicates of the article life-cycle and change windows.

draft        = published_at IS NULL
soft-deleted = deleted_at IS NOT NULL
live         = neither of the two
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from contentmart.functions.dates import ntz_literal


def is_live(published: str = "published_at", deleted: str = "deleted_at") -> Column:
    return F.col(published).isNotNull() & F.col(deleted).isNull()


def is_removable(published: str = "published_at", deleted: str = "deleted_at") -> Column:
    """Exact complement of ``is_live`` (both sides are two-valued)."""
    return F.col(published).isNull() | F.col(deleted).isNotNull()


def _bound(value: str | dt.datetime | Column) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return ntz_literal(value)


def changed_since(
    ts_col: str,
    since: str | dt.datetime | Column,
    until: str | dt.datetime | Column | None = None,
) -> Column:
    """``ts_col >= since`` (inclusive) and, if given, ``ts_col < until``.

    Literal bounds keep the predicate pushable into parquet and JDBC scans.
    """
    cond = F.col(ts_col) >= _bound(since)
    if until is not None:
        cond = cond & (F.col(ts_col) < _bound(until))
    return cond
