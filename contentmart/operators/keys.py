"""Identity keys and change stamps.

``assign_identity`` numbers rows 1..n after the current high-water mark
without a single-partition window: rows are range-partitioned on the natural
order (plus a hash tie-breaker so one repeated natural key can still spread
over several tasks), written once to the checkpoint store so every pass sees
the same partitions, counted per partition (one small row per partition), and
offset by the running total of the partitions before.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.functions.dates import now_ntz
from contentmart.operators import merge as M


def high_water(df: DataFrame, id_col: str = "id") -> int:
    """COALESCE(MAX(id), 1): the identity reseed value."""
    return int(df.agg(F.coalesce(F.max(id_col), F.lit(1)).alias("hw")).first()["hw"])


def high_water_frame(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.agg(F.coalesce(F.max(id_col), F.lit(1)).cast("bigint").alias("high_water"))


def assign_identity(
    df: DataFrame,
    order_by: list[str],
    start_after: int = 0,
    id_col: str = "id",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = start_after + 1, 2, ... in ``order_by`` order."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    ranged = (
        df.withColumn("__tie", tie)
        .repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order_by], F.col("__tie"))
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order_by], F.col("__tie"))
        .withColumn("__p", F.spark_partition_id())
        .withColumn("__i", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = sorted((r["__p"], r["n"]) for r in ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for p, cnt in counts:
        offsets.append((p, total))
        total += cnt
    # One row per partition: a proven bound, so it is broadcast.
    table = spark.createDataFrame(offsets or [(0, 0)], "__p int, __off long")
    within = F.col("__i") - F.shiftleft(F.col("__p").cast("long"), 33)
    numbered = ranged.join(F.broadcast(table), "__p").withColumn(
        id_col, (F.lit(start_after) + F.col("__off") + within + 1).cast("bigint")
    )
    return numbered.drop("__p", "__i", "__tie", "__off")


def stamped(spec: M.MergeSpec, column: str = "updated_at", now: Column | None = None) -> M.MergeSpec:
    """Every UPDATE also sets ``column`` to now (BEFORE UPDATE row trigger)."""
    stamp = now_ntz() if now is None else now
    clauses = tuple(
        replace(c, values={**c.values, column: stamp}) if c.kind == "update" else c for c in spec.when_matched
    )
    return replace(spec, when_matched=clauses)


def cascading_reset(parent: DataFrame, *children: DataFrame) -> tuple[DataFrame, ...]:
    """TRUNCATE parent and dependents, RESTART IDENTITY: empty frames, next id 1."""
    return tuple(d.limit(0) for d in (parent, *children))


def reset_tables(parent, *children) -> int:
    """``cascading_reset`` of published tables: each gets empty content, dependents first.

    Returns the high-water mark that ids restart after (0: the next row is 1).
    """
    empty = cascading_reset(*[t.read() for t in (parent, *children)])
    for table, rows in reversed(list(zip((parent, *children), empty, strict=True))):
        table.publish(rows)
    return 0
