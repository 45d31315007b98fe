"""Date and time column functions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text layouts of the reference.
KEY_LAYOUT = "yyyyMMdd"  # TO_CHAR(x, 'YYYYMMDD'); lower-case y/d in Spark patterns
THRESHOLD_LAYOUT = "yyyy-MM-dd HH:mm:ss"  # strftime('%Y-%m-%d %H:%M:%S')


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yyyymmdd_text(c: Column | str) -> Column:
    """TO_CHAR(ts, 'YYYYMMDD') as text."""
    return F.date_format(_col(c), KEY_LAYOUT)


def date_key(c: Column | str) -> Column:
    """TO_NUMBER(TO_CHAR(ts, 'YYYYMMDD')) as BIGINT.

    Computed arithmetically (year*10000 + month*100 + day) so it never leaves
    whole-stage codegen for a string round trip; equal to the text form for
    years 1..9999.
    """
    x = _col(c)
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("bigint")


def threshold_text(c: Column | str) -> Column:
    """Timestamp as 'yyyy-MM-dd HH:mm:ss' text."""
    return F.date_format(_col(c), THRESHOLD_LAYOUT)


def ntz_literal(text: str) -> Column:
    """A zone-less timestamp literal (independent of the session zone)."""
    return F.lit(text).cast("timestamp_ntz")


def now_ntz() -> Column:
    """CURRENT_TIMESTAMP as a zone-less value."""
    return F.localtimestamp()


def days_before(c: Column | str, days: int) -> Column:
    """ts - INTERVAL n DAY, keeping the zone-less type."""
    return _col(c) - F.make_dt_interval(F.lit(days))


def day_parts(c: Column | str) -> dict[str, Column]:
    """DAY, MONTH, YEAR, QUARTER as INT columns."""
    x = _col(c)
    return {
        "day": F.dayofmonth(x).cast("int"),
        "month": F.month(x).cast("int"),
        "year": F.year(x).cast("int"),
        "quarter": F.quarter(x).cast("int"),
    }
