"""Row-count audit without a second pass.

``RunAudit.track(df, stage)`` attaches an ``Observation`` (a count computed by
the same job that writes or collects the frame); ``RunAudit.frame`` turns the
finished counts into a small DataFrame (one row per stage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RunAudit:
    def __init__(self) -> None:
        self._obs: dict[str, Observation] = {}
        self._known: dict[str, int] = {}

    def track(self, df: DataFrame, stage: str) -> DataFrame:
        obs = Observation(stage)
        self._obs[stage] = obs
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def add(self, df: DataFrame, stage: str, write):
        """What ``write`` makes of ``df``, whose rows count for the stage, beside what counted before."""
        before = self._known.get(stage, 0)
        out = write(self.track(df, stage))
        self.ran(stage)
        self._known[stage] += before
        return out

    def ran(self, stage: str) -> None:
        """Say that the job which writes the stage's frame is done; its count can then be read."""
        self._known[stage] = int(self._obs.pop(stage).get["rows"])

    def count(self, stage: str) -> int:
        """Rows seen by one stage; an error where its frame has not been written yet."""
        if stage not in self._known:
            raise RuntimeError(f"stage {stage!r} has not been written, so it has no row count yet")
        return self._known[stage]

    def counts(self) -> dict[str, int]:
        """All counts; an error while a tracked frame is still unwritten."""
        return {stage: self.count(stage) for stage in [*self._known, *self._obs]}

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = sorted(self.counts().items())
        return spark.createDataFrame(rows, "stage string, rows long")


def balance(counts: DataFrame, tables: tuple[str, ...] = ("authors", "articles")) -> DataFrame:
    """Per run and table: rows extracted, put in quarantine and loaded, and whether they add up.

    ``counts`` is the audit table (run_id, job, stage, rows).  A run that merges instead of loading a
    whole dimension has no loaded rows to compare and no verdict.
    """
    each = F.explode(F.array(*[F.lit(t) for t in tables])).alias("source")
    staged = counts.select("run_id", "job", "stage", "rows", each)

    def rows(prefix: str):
        return F.sum(F.when(F.col("stage") == F.concat(F.lit(prefix), F.col("source")), F.col("rows")))

    per_run = staged.groupBy("run_id", "job", "source").agg(
        rows("staging_").alias("extracted"),
        F.coalesce(rows("quarantine_"), F.lit(0)).alias("quarantined"),
        rows("dim_").alias("loaded"),
    )
    adds_up = F.col("extracted") == F.col("quarantined") + F.col("loaded")
    return per_run.filter(F.col("extracted").isNotNull()).withColumn("balanced", adds_up)
