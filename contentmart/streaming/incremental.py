"""The incremental load as a restartable Structured Streaming query.

Delta files (pipe-delimited, staging layout) arrive in a landing folder; each
micro-batch is merged into the published warehouse by ``foreachBatch``.  The
streaming checkpoint records which files each batch took, and every batch
records its batch id in each table's state, so a batch replayed after
a failure neither loses nor doubles work (and MERGE of the same batch is
idempotent anyway).

Authors travel with every delta, as in the batch load: given ``authors``, each
batch first upserts the author dimension from it, so an article by a new
author gets that author.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from contentmart import schemas
from contentmart.operators.casts import typed_ids
from contentmart.sources import delimited
from contentmart.sources.extract import extract_full
from contentmart.sources.publish import PublishConflict


def landing_stream(
    spark: SparkSession,
    landing: str,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    table: str = "articles",
    escape_lines: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Files of a landing folder as a stream, in the staging layout (or ``schema``).

    Files whose line breaks are escaped (``escape_lines``, as the library's own hand-off writes them) are
    split over tasks; others are read by one task each, since a quoted field may hold a line break.
    """
    schema = schema or schemas.STAGING[table]
    reader = spark.readStream.schema(schema).options(**delimited.read_options(escape_lines=escape_lines)).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
    rows = reader.csv(landing)
    return delimited.unescape_lines(rows, schema) if escape_lines else rows


def again_on_conflict(apply, tries: int = 5):
    """``apply``, run again from the new content where another run published first."""

    def run(batch: DataFrame, batch_id: int) -> None:
        for left in range(tries - 1, -1, -1):
            try:
                return apply(batch, batch_id)
            except PublishConflict:
                if not left:
                    raise

    return run


def _apply_batch(warehouse, strategy: str, broadcast_bytes: int | None, stream_tag: str, table: str = "articles", authors=None):
    from contentmart.plans.jobs import apply_delta
    from contentmart.sources.staging import STAGED_IDS

    @again_on_conflict
    def apply(batch: DataFrame, batch_id: int) -> None:
        staged = typed_ids(batch, STAGED_IDS[table])
        tag = f"{stream_tag}#{batch_id}"
        # Each table logs the batch it applied: a replayed batch republishes nothing.
        if table == "articles":
            spark = batch.sparkSession
            whole = None if authors is None else extract_full(spark, authors, "authors")
            apply_delta(spark, warehouse, whole, staged, strategy, broadcast_bytes, tag=tag)
        else:
            no_articles = batch.sparkSession.createDataFrame([], schemas.SOURCE_ARTICLES)
            apply_delta(batch.sparkSession, warehouse, staged, no_articles, strategy, broadcast_bytes, tag=tag)

    return apply


def run_incremental_stream(
    spark: SparkSession,
    landing: str,
    warehouse,
    checkpoint: str,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    clean_source: str | None = None,
    table: str = "articles",
    authors=None,
    escape_lines: bool = False,
):
    """Start (and with ``available_now`` drain) the landing -> warehouse stream.

    ``warehouse`` is a ``Warehouse`` (snapshot per batch) or a
    ``RangedWarehouse`` (each batch rewrites only the key ranges it touches).
    ``clean_source="delete"`` removes landed files once processed (Spark does
    this one batch late: a drained ``availableNow`` run leaves its last files).
    ``authors`` is a source of the author table (as for the batch load).
    ``table="authors"`` runs the same loop for author files (dimension only).
    ``escape_lines``: as for ``landing_stream``.  Each batch's counts are kept in ``load_audit``.
    """
    writer = (
        landing_stream(spark, landing, max_files_per_trigger, clean_source, table, escape_lines)
        .writeStream.foreachBatch(_apply_batch(warehouse, strategy, broadcast_bytes, f"stream:{checkpoint}", table, authors))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 hour")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
