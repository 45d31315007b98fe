"""Keeping the warehouse in step with a source that hard-deletes rows.

* key comparison: target rows whose key left the source are removed;
* change data: ordered I/U/D change rows, the last change per key wins, also across feeds: the newest
  change applied to each key is kept, deleted keys included, and older changes are passed over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentmart.operators import merge as M
from contentmart.operators.sizing import broadcast_limit, key_table_bytes, maybe_broadcast


def _source_keys(source: DataFrame, key: str) -> DataFrame:
    # Distinct first: partial aggregation collapses a repeated key before the shuffle.
    return source.select(F.col(key).alias("__k")).filter(F.col("__k").isNotNull()).distinct()


def hard_delete_kept(target: DataFrame, target_key: str, source: DataFrame, source_key: str) -> DataFrame:
    """Target rows whose key still exists in the source."""
    keys = _source_keys(source, source_key)
    return target.join(keys, F.col(target_key) == F.col("__k"), "left_semi")


def hard_delete_removed(target: DataFrame, target_key: str, source: DataFrame, source_key: str) -> DataFrame:
    """Target rows whose key left the source (what reconciliation deletes)."""
    keys = _source_keys(source, source_key)
    return target.join(keys, F.col(target_key) == F.col("__k"), "left_anti")


def last_change(changes: DataFrame, key: str, seq: str) -> DataFrame:
    """The newest change row per key (``seq`` must be unique per key).

    ``max_by`` over a struct aggregates partially, so a key with very many
    changes is reduced inside each task before the shuffle.
    """
    payload = [c for c in changes.columns if c != key]
    latest = changes.groupBy(key).agg(F.max_by(F.struct(*payload), F.col(seq)).alias("__last"))
    return latest.select(key, *[F.col(f"__last.`{c}`").alias(c) for c in payload])


def newer_changes(
    latest: DataFrame, applied: DataFrame, key: str, seq: str, broadcast_bytes: int | None = None
) -> DataFrame:
    """The rows of ``latest`` (one per key, stored) that are newer than what was applied to their key.

    ``applied`` has id and seq, one row for each key that ever changed.  Only its rows with a key of the
    feed matter: the feed's keys are counted and broadcast when that count fits, so ``applied`` is
    streamed past them, never shuffled.
    """
    keys = latest.select(F.col(key).alias("__key"))
    limit = broadcast_limit(latest.sparkSession, broadcast_bytes)
    if limit >= 0:
        keys = maybe_broadcast(keys, key_table_bytes(latest.count(), 1, 0), limit)
    known = applied.join(keys, F.col("id") == F.col("__key"), "left_semi")
    known = known.select(F.col("id").alias("__known"), F.col("seq").alias("__seq"))
    newer = F.col("__seq").isNull() | (latest[seq] > F.col("__seq"))
    return latest.join(known, latest[key] == F.col("__known"), "left").filter(newer).select(*latest.columns)


def applied_spec(key: str, seq: str, op: str = "op", delete_code: str = "D") -> M.MergeSpec:
    """Notes the newest change of each key; a deleted key is kept as such."""
    values = {"seq": M.src(seq).cast("long"), "deleted": M.src(op) == F.lit(delete_code)}
    return M.MergeSpec(
        target_key="id",
        source_key=key,
        when_matched=(M.update(values, M.src(seq) > M.tgt("seq")),),
        when_not_matched=(M.insert({"id": M.src(key), **values}),),
    )


def cdc_spec(target_key: str, key: str, copied: list[str], op: str = "op", delete_code: str = "D") -> M.MergeSpec:
    is_delete = M.src(op) == F.lit(delete_code)
    return M.MergeSpec(
        target_key=target_key,
        source_key=key,
        when_matched=(M.delete(is_delete), M.update({c: M.src(c) for c in copied})),
        when_not_matched=(M.insert({target_key: M.src(key), **{c: M.src(c) for c in copied}}, ~is_delete),),
    )


def cdc_apply(
    target: DataFrame,
    changes: DataFrame,
    target_key: str,
    key: str,
    seq: str,
    copied: list[str],
    op: str = "op",
    delete_code: str = "D",
    strategy: str = "auto",
) -> DataFrame:
    """Apply the last change per key: D deletes, anything else upserts."""
    latest = last_change(changes, key, seq)
    return M.merge(target, latest, cdc_spec(target_key, key, copied, op, delete_code), strategy)
