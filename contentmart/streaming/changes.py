"""A change feed as a restartable stream: keyed state in front of the warehouse.

Change files (staging layout plus ``seq`` and ``op``) land in any order.  Keyed state, held in RocksDB,
keeps the newest ``seq`` seen of each article, so of a micro-batch only changes that are newer than
everything before reach the merge: one row per key and batch at most, and none for what is late.  Keys
are met in groups, since a Python call for each key costs more than all the rest of the stream.

State expires ``retention_ms`` after a key's last newer change.  There is no watermark: it would drop late
rows, and a late row can be the newest of its key.  Nothing depends on the state being there: the
warehouse itself keeps the newest ``seq`` applied per key, deleted keys included, and passes over older
changes.  The state spares it the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

from contentmart import schemas
from contentmart.operators.casts import typed_ids
from contentmart.sources import delimited
from contentmart.sources.extract import extract_full
from contentmart.sources.staging import STAGED_IDS, as_staged_text
from contentmart.streaming.incremental import again_on_conflict, landing_stream

#: State beyond an executor's memory; and no empty batches, which would never end where state can expire.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
RETENTION_MS = 30 * 24 * 3600 * 1000
#: Groups that keys are dealt to by their hash, for each partition of the stream's shuffle; a group's keys share
#: one entry of the state, of about 30 bytes a key, which a batch rewrites where it has a key of the group.
GROUPS = 32
#: Layout of change files: that of staging, then the change's number and kind.
CHANGES = StructType(
    [*schemas.STAGING_ARTICLES.fields, StructField("seq", LongType(), True), StructField("op", StringType(), True)]
)


def write_changes(changes: DataFrame, path: str, mode: str = "append") -> None:
    """Land a feed of article changes as files that can be split."""
    text = as_staged_text(changes, "articles").columns
    ids = STAGED_IDS["articles"]
    rows = changes.select(*[F.col(c).cast("string").alias(c) if c in ids else F.col(c) for c in text], "seq", "op")
    delimited.write_delimited(rows, path, mode=mode, escape_lines=True)


def _packed(held: pd.DataFrame) -> bytes:
    """Keys, their newest ``seq`` and when each expires, as bytes."""
    batch = pa.RecordBatch.from_pandas(held, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as sink:
        sink.write_batch(batch)
    return out.getvalue().to_pybytes()


def _first_newest(rows: pd.DataFrame) -> pd.DataFrame:
    """The newest change of each key; of equal ones the first."""
    return rows.sort_values("__seq", ascending=False, kind="stable").drop_duplicates("__key")


def _newest(retention_ms: int):
    """Passes on, for a group of keys, each key's newest change of a batch if it is newer than all before."""

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # the last of its keys has expired
            state.remove()
            return
        best = None
        for part in parts:  # seq travels as text: a nullable number would become a float
            odd = part["seq"].isna()
            if odd.any():
                yield part[odd]  # a change without a number breaks a constraint downstream
            rows = part[~odd]
            rows = rows.assign(__seq=rows["seq"].astype("int64"))
            best = _first_newest(rows if best is None else pd.concat([best, rows]))
        now = state.getCurrentProcessingTimeMs()
        if state.exists:
            held = pa.ipc.open_stream(state.get[0]).read_pandas()
            held = held[held["until"] > now]
        else:
            held = pd.DataFrame({"key": [], "newest": [], "until": []}).astype({"key": "str", "newest": "int64", "until": "int64"})
        if best is not None and len(best):
            at = pd.Index(held["key"]).get_indexer(best["__key"])
            known = at >= 0
            older = np.zeros(len(best), bool)
            older[known] = best["__seq"].to_numpy()[known] <= held["newest"].to_numpy()[at[known]]
            best, at = best[~older], at[~older]
            kept = np.ones(len(held), bool)
            kept[at[at >= 0]] = False
            newer = pd.DataFrame({"key": best["__key"], "newest": best["__seq"], "until": now + retention_ms})
            held = pd.concat([held[kept], newer]) if len(held) else newer
            if len(best):
                yield best.drop(columns="__seq")
        if len(held):  # keys expire one by one where their group is met, and with the last of them the group
            state.update((_packed(held),))
            state.setTimeoutDuration(max(1, int(held["until"].max()) - now))
        elif state.exists:
            state.remove()

    return run


def newest_changes(stream: DataFrame, retention_ms: int = RETENTION_MS, groups: int = GROUPS) -> DataFrame:
    """A stream of changes without those that are older than one seen before for their key."""
    key = F.coalesce("id", F.lit(""))
    keyed = stream.withColumn("seq", F.col("seq").cast("string")).withColumn("__key", key)
    parts = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = keyed.withColumn("__group", F.pmod(F.xxhash64("__key"), F.lit(groups * parts)))
    kept = keyed.groupBy("__group").applyInPandasWithState(
        _newest(retention_ms), keyed.schema, "held binary", "update", GroupStateTimeout.ProcessingTimeTimeout
    )
    return kept.withColumn("seq", F.col("seq").cast("long")).drop("__key", "__group")


def run_change_stream(
    spark: SparkSession,
    landing: str,
    warehouse,
    checkpoint: str,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    retention_ms: int = RETENTION_MS,
    authors=None,
    on_violation: str = "fail",
):
    """Start (and with ``available_now`` drain) the change files -> warehouse stream.

    Each batch is one run of ``apply_article_changes``; its number is recorded with the tables, so a
    replayed batch publishes nothing.  ``authors`` is a source of the author table, as for the load.
    """
    from contentmart.plans.jobs import apply_article_changes

    @again_on_conflict
    def apply(batch: DataFrame, batch_id: int) -> None:
        whole = None if authors is None else extract_full(batch.sparkSession, authors, "authors")
        changes = typed_ids(batch, STAGED_IDS["articles"])
        apply_article_changes(
            batch.sparkSession, changes, warehouse, strategy=strategy, broadcast_bytes=broadcast_bytes,
            tag=f"stream:{checkpoint}#{batch_id}", authors=whole, on_violation=on_violation,
        )

    before = {k: spark.conf.get(k, None) for k in STREAM_CONF}
    for k, v in STREAM_CONF.items():
        spark.conf.set(k, v)
    try:  # the query takes the settings along when it starts
        rows = landing_stream(spark, landing, max_files_per_trigger, escape_lines=True, schema=CHANGES)
        writer = newest_changes(rows, retention_ms).writeStream.outputMode("update").foreachBatch(apply)
        writer = writer.option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
        query = writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if available_now:
        query.awaitTermination()
    return query
