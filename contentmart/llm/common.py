"""Helpers shared by the operators: column picking, written tables, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart.session import ensure_checkpoint_dir, scratch_path
from contentmart.sources import fs

#: ASCII white space of the word rules: space and the controls 9 to 13.
WHITESPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def column(df: DataFrame, name: str) -> Column:
    """The first column called ``name``: an exact match, else one that differs by case.

    Works on frames whose column names clash, where ``df[name]`` is ambiguous.
    """
    return positional(df)[f"__c{place(df, name)}"]


def place(df: DataFrame, name: str) -> int:
    exact = [i for i, c in enumerate(df.columns) if c == name]
    close = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not (exact or close):
        raise ValueError(f"no column {name!r} in {df.columns}")
    return (exact or close)[0]


def positional(df: DataFrame) -> DataFrame:
    """The same rows with columns named by place."""
    return df.toDF(*[f"__c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **roles: str) -> DataFrame:
    """Select columns by their input names and rename them to their roles; extra columns go."""
    flat = positional(df)
    return flat.select(*[flat[f"__c{place(df, src)}"].alias(role) for role, src in roles.items()])


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(paths: list[str]):
    """Notes the tables that are written meanwhile in ``paths``, for ``drop_tables``."""
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.pop()


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that nothing reads any more, and empty the list."""
    while paths:
        fs.delete(spark, paths.pop())


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends at files that
    every executor can see, so a lost executor costs no more than its running tasks."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Hands Python ``rows`` rows at once, at most, in what is run meanwhile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_row_id(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once with a unique ``rid``; later reads of it agree on the ids."""
    return materialise(df.withColumn("rid", F.monotonically_increasing_id()), name)


def ready(spark: SparkSession) -> SparkSession:
    ensure_checkpoint_dir(spark)
    return spark


def text_slices(batch: pa.RecordBatch, name: str, limit: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts have about ``limit`` bytes; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    return row_runs(batch, sizes, limit)


def row_runs(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose ``sizes`` add up to about ``limit``."""
    run = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: (src, dst) long pairs -> (node, component), component the smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014); each round joins an edge list
    with the smallest neighbour of each node, so a hub's neighbours are never gathered in one row.
    Every round is written to the shared folder.  Nodes without an edge are not returned.  The loop
    ends when all edges point at a node that points nowhere, which is checked by one aggregation.
    """
    e, _ = materialise(_directed(edges.select("src", "dst")), "components")
    for _ in range(max_rounds):
        if not _unsettled(e):
            roots = e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
        e, _ = materialise(_small_star(_large_star(e)), "components")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _directed(e: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return (
        e.filter("src != dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct()
    )


def _unsettled(e: DataFrame) -> bool:
    ends = e.select(F.col("src").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        e.select(F.col("dst").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    per_node = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not per_node.filter("out > 1 or (out = 1 and into = 1)").isEmpty()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
    return both.join(low, "src").filter("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    e = _directed(e)
    low = e.groupBy("src").agg(F.min("dst").alias("m"))
    linked = e.join(low, "src").filter("dst != m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return linked.unionByName(low.select("src", F.col("m").alias("dst"))).distinct()


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of n numbers the smallest that the links (u, v) reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
