"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside the cells.

Centroids are fitted on a bounded sample of distinct vectors; every vector is assigned.  A vector goes
to the cell of its nearest centroid and to every cell whose centroid is at most ``slack`` less similar,
so that close vectors on two sides of a border still meet.  Cosines inside a cell are products of
blocks of unit vectors in double precision, and a link needs the exact cosine of the two vectors.

Scale: equal vectors collapse first and count by their multiplicity, so a vector held by a third of all
rows is one row.  A cell of any size is cut into blocks, and a task gets one pair of blocks; block
pairs return, per vector, a count, plus links that span what the pair connects, never all pairs.  A pair
of vectors that meets in several cells counts in the first of them only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentmart.llm.common import components, materialise, pick, roots

#: Distinct vectors that the centroids are fitted on, at most.
FIT_SAMPLE = 16_384
#: Centroids at most; every task holds them.
MAX_CELLS = 4096
#: Vectors in a block at most.
BLOCK = 1024
#: A vector also goes to cells this much less similar than the nearest.
SLACK = 0.1


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Unit centroids (cells, dimensions); an empty cell takes the vector that fits its own worst."""
    x = unit_rows(sample).astype(np.float32)
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.empty(len(x), np.int64)
        best = np.empty(len(x), np.float32)
        for at in range(0, len(x), 4096):
            s = x[at : at + 4096] @ c.T
            near[at : at + 4096] = s.argmax(axis=1)
            best[at : at + 4096] = s.max(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        empty = np.flatnonzero(size < 1e-6)
        sums[empty] = x[np.argsort(best, kind="stable")[: len(empty)]]
        size[empty] = 1.0
        c = sums / size[:, None]
    return c


def _assign(centroids, slack: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centroids.value
        for b in batches:
            if not len(b):
                continue
            vec = b.column("vec")
            x = unit_rows(vec.flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)).astype(np.float32)
            s = x @ c.T
            row, cell = np.nonzero(s >= s.max(axis=1, keepdims=True) - np.float32(slack))
            cells = np.split(cell.astype(np.int32), np.flatnonzero(np.diff(row)) + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), vec, b.column("copies"), pa.array(cells, pa.list_(pa.int32()))],
                names=["node", "vec", "copies", "cells"],
            )

    return run


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["vec"].to_numpy()).astype(np.float64)


def _products(threshold: float):
    """Counts and spanning links of one pair of blocks of a cell."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cell, low, high = key
        pdf = pdf.sort_values(["block", "node"], ignore_index=True)
        left = pdf[pdf["block"] == low]
        right = left if low == high else pdf[pdf["block"] == high]
        a, b = unit_rows(_matrix(left)), unit_rows(_matrix(right))
        i, j = np.nonzero(a @ b.T >= threshold)
        if low == high:
            i, j = i[i < j], j[i < j]
        mine = ~_met_before(cell, left["cells"], right["cells"], i, j)
        i, j = i[mine], j[mine]
        ln, rn = left["node"].to_numpy(np.int64), right["node"].to_numpy(np.int64)
        lw, rw = left["copies"].to_numpy(np.int64), right["copies"].to_numpy(np.int64)
        nodes, spot = np.unique(np.concatenate([ln[i], rn[j]]), return_inverse=True)
        u, v = spot[: len(i)], spot[len(i) :]
        count = np.zeros(len(nodes), np.int64)
        np.add.at(count, u, rw[j])
        np.add.at(count, v, lw[i])
        root = roots(len(nodes), u, v)
        return pd.DataFrame({"node": nodes, "n": count, "root": nodes[root]})

    return run


def _met_before(cell: int, left: pd.Series, right: pd.Series, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the vectors of each pair also share a cell with a lower number."""
    known = np.unique(np.concatenate([*left, *right]))
    known = known[known < cell]

    def held(cells: pd.Series) -> np.ndarray:
        out = np.zeros((len(cells), len(known) + 1), bool)
        for r, c in enumerate(cells):
            c = np.asarray(c)
            out[r, np.searchsorted(known, c[c < cell])] = True
        return out

    a, b = held(left), held(right)
    met = np.zeros(len(i), bool)
    for at in range(0, len(i), 65_536):
        part = slice(at, at + 65_536)
        met[part] = (a[i[part]] & b[j[part]]).any(axis=1)
    return met


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    slack: float = SLACK,
    fit_sample: int = FIT_SAMPLE,
    max_cells: int = MAX_CELLS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    n_links counts the other rows with a cosine of ``threshold`` or more that were found; component_id
    is the smallest id reachable by links; the row with that id stays.

    A vector that is null, empty, all zero, or holds a null or non-finite component links with nothing
    and is its own component.  Vectors of different lengths do not link.  Repeated rows are separate
    rows of one class and link with each other; of rows that also share their id the first read stays.
    A null id is never the smallest unless the whole component has none.  An empty table gives an empty
    result; extra columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, vec_id=id_col, vec=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec")
    )
    rows = rows.withColumn("rid", F.monotonically_increasing_id())
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    fine = F.col("vec").isNotNull() & ~F.coalesce(F.exists("vec", bad), F.lit(False))
    fine = fine & F.coalesce((norm2 > 0) & (norm2 < float("inf")), F.lit(False))
    rows, _ = materialise(rows.withColumn("usable", fine), "embed-rows")

    classes = rows.filter("usable").groupBy("vec").agg(
        F.min("rid").alias("node"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    classes, _ = materialise(classes, "embed-classes")
    member = rows.filter("usable").select("rid", "vec_id", "vec").join(classes.select("vec", "node"), "vec").select("rid", "vec_id", "node")

    found = []
    for (length,) in classes.select(F.size("vec")).distinct().collect():  # one length in a sound table
        same = classes.filter(F.size("vec") == length)
        found.append(_links(spark, same, threshold, slack, fit_sample, max_cells, block))
    schema = "node long, n long, root long"
    met = spark.createDataFrame([], schema)
    for part in found:
        met = met.unionByName(part)
    met, _ = materialise(met, "embed-links")

    n_links = met.groupBy("node").agg(F.sum("n").alias("n"))
    comp = components(met.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    comp, _ = materialise(comp, "embed-components")
    named = (
        classes.select("node", "least", "copies")
        .join(n_links, "node", "left")
        .join(comp, "node", "left")
        .select("node", "least", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("root"))
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("node", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = member.join(named, "node").select("rid", "vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select(
        "rid", "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out, _ = materialise(linked.unionByName(alone), "embed-result")
    first = out.groupBy("vec_id", "component_id").agg(F.min("rid").alias("rid"))
    first = first.filter("vec_id = component_id").select("rid", F.lit(True).alias("first"))
    return out.join(first, "rid", "left").select(
        "vec_id", "n_links", "component_id", F.coalesce("first", F.lit(False)).alias("kept")
    )


def cells_for(n: int, max_cells: int) -> int:
    """Centroids for n vectors: assigning and comparing then cost about the same."""
    return max(1, min(max_cells, int(4 * math.sqrt(n))))


def _links(spark, classes: DataFrame, threshold, slack, fit_sample, max_cells, block) -> DataFrame:
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("vec")).limit(fit_sample).select("vec").toPandas()
    fitted = spherical_kmeans(np.stack(sample["vec"].to_numpy()), cells_for(n, max_cells))
    centroids = spark.sparkContext.broadcast(fitted)
    assigned, _ = materialise(
        classes.select("node", "vec", "copies").mapInArrow(
            _assign(centroids, slack), "node long, vec array<double>, copies long, cells array<int>"
        ),
        "embed-assigned",
    )
    spread = assigned.withColumn("cell", F.explode("cells"))
    sizes = assigned.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("size"))
    sizes = sizes.select("cell", F.ceil(F.col("size") / block).cast("int").alias("blocks"))  # max_cells rows at most
    spread = spread.join(F.broadcast(sizes), "cell")
    spread = spread.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = spread.withColumn("other", other).select(
        "cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "vec", "copies", "cells"
    )
    return pairs.groupBy("cell", "low", "high").applyInPandas(_products(threshold), "node long, n long, root long")
