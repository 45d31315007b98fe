"""Key and constraint checks as DataFrames of violations.

Each ``check_*`` returns the violating rows (never a Python list), so a check
over a very large table stays distributed.  ``split_valid`` splits good rows
from those that break a declared rule; the load jobs fail on the latter or put
them in quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.operators.sizing import broadcast_limit, key_table_bytes, maybe_broadcast
from contentmart.session import ensure_checkpoint_dir


def check_unique(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """Key values held by more than one row: (*keys, rows).

    Partial aggregation runs before the shuffle, so a key held by a third of
    the table is one row per task by the time it moves.
    """
    cols = [keys] if isinstance(keys, str) else list(keys)
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def check_not_null(df: DataFrame, columns: list[str], key: str | None = None) -> DataFrame:
    """One row per (row, column) that is NULL: (key?, column) — one pass over ``df``."""
    flags = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    picked = [F.col(key)] if key else []
    return (
        df.select(*picked, F.array_compact(flags).alias("__nulls"))
        .filter(F.size("__nulls") > 0)
        .select(*picked, F.explode("__nulls").alias("column"))
    )


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str, broadcast_bytes: int | None = None) -> DataFrame:
    """Distinct non-NULL child keys with no parent: (fk, rows).

    Keys are reduced by partial aggregation before any shuffle, so a key held
    by a third of the child rows is one row per task.  The parent side is a
    dimension: its distinct keys are counted and broadcast when that count
    fits, which keeps the anti join map-side (Catalyst may place it below the
    aggregation).
    """
    child_keys = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("rows"))
    parent_keys = parent.select(F.col(pk).alias("__pk")).filter(F.col("__pk").isNotNull()).distinct()
    limit = broadcast_limit(child.sparkSession, broadcast_bytes)
    if limit >= 0:
        parent_keys = maybe_broadcast(parent_keys, key_table_bytes(parent.select(pk).count(), 1, 0), limit)
    return child_keys.join(parent_keys, F.col(fk) == F.col("__pk"), "left_anti")


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str, broadcast_bytes: int | None = None) -> DataFrame:
    """Child rows whose non-NULL ``fk`` has no parent row.

    The orphan keys are found on distinct keys (``orphan_keys``), counted, and
    broadcast when that count fits, so the child rows are picked out without a
    shuffle and a hot child key never lands in one task.
    """
    orphans = orphan_keys(child, fk, parent, pk, broadcast_bytes).select(F.col(fk).alias("__ok"))
    limit = broadcast_limit(child.sparkSession, broadcast_bytes)
    if limit >= 0:
        # Found once: the checkpoint is both counted and joined.
        ensure_checkpoint_dir(child.sparkSession)
        orphans = orphans.checkpoint(eager=True)
        orphans = maybe_broadcast(orphans, key_table_bytes(orphans.count(), 1, 0), limit)
    return child.join(orphans, F.col(fk) == F.col("__ok"), "left_semi")


def check_length(df: DataFrame, limits: dict[str, int], key: str | None = None) -> DataFrame:
    """Rows whose text is longer than its declared limit: (key?, column, length, limit) — one pass."""
    picked = [F.col(key)] if key else []
    entries = F.array(
        *[
            F.when(
                F.char_length(F.col(c)) > limit,
                F.struct(F.lit(c).alias("column"), F.char_length(F.col(c)).alias("length"), F.lit(limit).alias("limit")),
            )
            for c, limit in limits.items()
        ]
    )
    return (
        df.select(*picked, F.array_compact(entries).alias("__long"))
        .filter(F.size("__long") > 0)
        .select(*picked, F.explode("__long").alias("__e"))
        .select(*picked, "__e.column", "__e.length", "__e.limit")
    )


def length_report(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Per declared column: longest value, limit and number of violations (one pass)."""
    aggs = []
    for c, limit in limits.items():
        length = F.char_length(F.col(c))
        aggs += [
            F.max(length).alias(f"{c}__max"),
            F.count(F.when(length > limit, 1)).alias(f"{c}__bad"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__max").cast("int").alias("max_length"),
            F.lit(limit).alias("limit"),
            F.col(f"{c}__bad").alias("violations"),
        )
        for c, limit in limits.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def apply_defaults(df: DataFrame, defaults: dict[str, Column | object], schema=None) -> DataFrame:
    """Fill missing columns and NULLs with declared defaults (column DEFAULT)."""
    out = df
    for c, value in defaults.items():
        lit = value if isinstance(value, Column) else F.lit(value)
        out = out.withColumn(c, F.coalesce(F.col(c), lit)) if c in out.columns else out.withColumn(c, lit)
    if schema is not None:
        out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return out


def split_unique(df: DataFrame, keys: list[str], newest: str, keep) -> tuple[DataFrame, DataFrame | None]:
    """(good, quarantine): of rows that share the value of a key one stays; None where all are unique.

    The newest row stays; ties go to the greater of the other columns, in their order, NULL lowest.
    ``keep(frame, name)`` stores a frame that is read several times.  The repeated values are found by
    partial aggregation and stored, so that only their rows are looked at again and a hot value is
    split in the joins; the winner is an aggregate as well, never a window over a hot value.
    """
    bad = None
    for key in keys:
        repeated = keep(check_unique(df, key).select(key), f"repeated-{key}")
        if repeated.isEmpty():
            continue
        rows = df.join(repeated, key, "left_semi").select(*df.columns)
        rows = keep(rows.withColumn("__row", F.monotonically_increasing_id()), f"rows-{key}")
        order = F.struct(newest, *[c for c in df.columns if c != newest], "__row")
        first = keep(rows.groupBy(key).agg(F.max(order)["__row"].alias("__row")).select("__row"), f"first-{key}")
        lost = rows.join(first, "__row", "left_anti").drop("__row").withColumn("reason", F.lit(f"{key} is not unique"))
        bad = lost if bad is None else bad.unionByName(lost)
        won = rows.join(first, "__row", "left_semi").select(*df.columns)
        df = keep(df.join(repeated, key, "left_anti").select(*df.columns).unionByName(won), f"unique-{key}")
    return df, bad


def split_held(
    df: DataFrame, key: str, column: str, target: DataFrame, target_key: str, keep, broadcast_bytes: int | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(good, quarantine): rows whose ``column`` has a value that a target row of another key holds.

    A target row that the batch replaces does not count, unless its replacement goes to quarantine, so
    the check is repeated until nothing more goes.  The batch's values are counted and broadcast when
    that count fits, and the target is streamed past them; beyond the limit it is a semi join, where
    Spark filters the target by a Bloom filter of the smaller side before it is shuffled.
    """
    limit = broadcast_limit(df.sparkSession, broadcast_bytes)
    wanted = df.select(F.col(column).alias("__wanted")).distinct()
    if limit >= 0:
        size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(column))).first()
        wanted = maybe_broadcast(wanted, key_table_bytes(size[0], 1, 0) + (size[1] or 0), limit)
    held = target.join(wanted, F.col(column) == F.col("__wanted"), "left_semi")
    held = keep(held.select(F.col(target_key).alias("__holder"), F.col(column).alias("__held")), f"held-{column}")
    good, bad, turn = df, None, 0
    while not held.isEmpty():
        stays = held.join(good.select(key), F.col("__holder") == F.col(key), "left_anti")
        clash = good.join(stays, (F.col(column) == F.col("__held")) & (F.col(key) != F.col("__holder")), "left_semi")
        clash = keep(clash.select(*df.columns), f"clash-{column}-{turn}")
        if clash.isEmpty():
            break
        lost = clash.withColumn("reason", F.lit(f"{column} is held by another row"))
        bad = lost if bad is None else bad.unionByName(lost)
        good = keep(good.join(clash.select(key), key, "left_anti").select(*df.columns), f"free-{column}-{turn}")
        turn += 1
    return good, bad


class ConstraintViolation(RuntimeError):
    """Rows of a load break a declared constraint; nothing was published."""


def split_valid(df: DataFrame, not_null: list[str] = (), limits: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) by row-local rules; a ``reason`` column on quarantine.

    Lengths are counted in characters, as the declared limits are.
    """
    reasons = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in not_null]
    for c, limit in (limits or {}).items():
        reasons.append(F.when(F.char_length(F.col(c)) > limit, F.lit(f"{c} longer than {limit}")))
    if not reasons:
        return df, df.limit(0).withColumn("reason", F.lit(None).cast("string"))
    reason = F.concat_ws("; ", *reasons)
    tagged = df.withColumn("reason", reason)
    good = tagged.filter(F.col("reason") == "").drop("reason")
    bad = tagged.filter(F.col("reason") != "")
    return good, bad
