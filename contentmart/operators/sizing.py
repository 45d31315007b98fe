"""Measured size bounds, and the broadcast decisions that rest on them.

A side is broadcast only after one aggregation pass has *measured* it: row
count plus the bytes its values occupy.  Anything above the limit goes the
shuffle way (sort-merge join; AQE may still convert it at run time, and splits
skewed partitions).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Per-row overhead of an UnsafeRow plus a hash-table slot, in bytes.
ROW_OVERHEAD = 24
_FIXED = {
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.BooleanType: 1,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}
_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    @property
    def empty(self) -> bool:
        return self.rows == 0


def _value_bytes(field: T.StructField):
    c = F.col(f"`{field.name}`")
    dt = field.dataType
    for kind, width in _FIXED.items():
        if isinstance(dt, kind):
            return F.lit(width)
    if isinstance(dt, T.DecimalType):
        return F.lit(16)
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16


def row_bytes(df: DataFrame) -> Column:
    """Payload bytes of one row of ``df``."""
    width = F.lit(ROW_OVERHEAD)
    for field in df.schema.fields:
        width = width + _value_bytes(field)
    return width.cast("long")


def measure(df: DataFrame) -> Size:
    """Rows and payload bytes of ``df`` in one aggregation (partial per task)."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return Size(int(row["rows"]), int(row["bytes"] or 0))


def parse_bytes(text: str | None) -> int:
    if text is None:
        return -1
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    value, unit = int(m.group(1)), m.group(2).lower()
    return value * _UNITS.get(unit, 1) if value >= 0 else -1


LIMIT_KEY = "spark.contentmart.broadcastBytes"


def broadcast_limit(spark: SparkSession, override: int | None = None) -> int:
    """Bytes a measured side may have to be broadcast; -1 means never.

    Order: the explicit argument, then ``spark.contentmart.broadcastBytes``,
    then Spark's ``spark.sql.autoBroadcastJoinThreshold``.  The own setting
    lets Catalyst's estimate-based broadcasts be switched off while the
    measured ones stay on.
    """
    if override is not None:
        return override
    own = spark.conf.get(LIMIT_KEY, None)
    if own:
        return parse_bytes(own)
    return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def fits(size: Size, limit: int) -> bool:
    return limit >= 0 and size.bytes <= limit


def key_table_bytes(rows: int, key_cols: int = 1, value_cols: int = 1) -> int:
    """Upper bound for a table of ``rows`` fixed-width (long) columns."""
    return rows * (ROW_OVERHEAD + 8 * (key_cols + value_cols))


def maybe_broadcast(df: DataFrame, size_bytes: int, limit: int) -> DataFrame:
    """Hint ``broadcast`` only for a measured side under the limit."""
    return F.broadcast(df) if 0 <= size_bytes <= limit else df
