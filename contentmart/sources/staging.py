"""Run-scoped staging: each load run lands its batch in its own folder.

Nothing is shared between runs (a full and an incremental run can overlap),
and "truncate then load" becomes "write this run's folder".
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart import schemas
from contentmart.session import scratch_path
from contentmart.sources import delimited, fs


STAGED_IDS = {"authors": ("id",), "articles": ("id", "author_id")}


def as_staged_text(df: DataFrame, table: str) -> DataFrame:
    """Source row -> staging row: declared column order (bound by name), ids as text."""
    ids = STAGED_IDS[table]
    return df.select(
        *[F.col(c).cast("string").alias(c) if c in ids else F.col(c) for c in schemas.column_names(schemas.STAGING[table])]
    )


class RunScratch:
    """Tables that one run derives and reads several times: written once, deleted when the run is done.

    Everything lies in a folder of the run's own under the shared checkpoint storage, so a lost executor
    re-reads files instead of recomputing the source, and all steps see one state of it.
    """

    def __init__(self, spark: SparkSession, name: str = "run") -> None:
        self.spark = spark
        self.root = scratch_path(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = os.path.join(self.root, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        fs.delete(self.spark, self.root)


class StagingArea:
    """Landing + staging for one run, under the shared checkpoint storage."""

    def __init__(self, spark: SparkSession, root: str | None = None, purge_landing: bool = True) -> None:
        self.spark = spark
        self.root = root or scratch_path(spark, "staging")
        self.purge_landing = purge_landing

    def landing(self, table: str) -> str:
        return os.path.join(self.root, "landing", table)

    def staged(self, table: str) -> str:
        return os.path.join(self.root, "staged", table)

    def land(self, table: str, df: DataFrame) -> str:
        """Write the extract as delimited text (replacing a same-named landing)."""
        path = self.landing(table)
        delimited.write_delimited(as_staged_text(df, table), path, escape_lines=True)
        return path

    def stage(self, table: str) -> DataFrame:
        """Replace this run's staging table with the landed file, purge the landing."""
        src = self.landing(table)
        fs.require(self.spark, src)
        loaded = delimited.read_delimited(self.spark, src, schemas.STAGING[table], escape_lines=True)
        loaded.write.mode("overwrite").parquet(self.staged(table))
        if self.purge_landing:
            fs.delete(self.spark, src)
        return self.spark.read.schema(loaded.schema).parquet(self.staged(table))

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """land + stage in one call."""
        self.land(table, df)
        return self.stage(table)

    def close(self) -> None:
        """Delete what the run has landed and staged."""
        fs.delete(self.spark, self.root)
