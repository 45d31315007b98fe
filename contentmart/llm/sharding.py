"""Sharding by Hilbert-curve order over several metadata dimensions.

Each dimension becomes an ordered number, is quantised at its own quantiles, and the cells are
ordered along a Hilbert curve, so that rows near each other in any dimension lie near each other in
the files.  The rows are written as sorted runs (one file each, with min/max statistics of every
dimension for pruning), and the runs are cut at exact row ranks into shards whose counts differ by
one at most.

Scale: one shuffle carries the texts, to runs of about equal bytes.  The runs are laid out from the
bytes of the curve's cells, of which there are at most CELLS; a cell heavier than a run (a source may
hold a third of all rows) is dealt over several.  Ranks come from the row counts of the runs and the
place inside a run, never from a global window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentmart.llm.common import materialise, pick

#: Bits of a dimension: 2 ** BITS cells along it, cut at quantiles.
BITS = 4
#: Bytes of text aimed at for one run, and runs at most: beyond them runs grow with the corpus.
RUN_BYTES = 32 << 20
MAX_RUNS = 100_000
#: Cells that runs are laid out by, at most: the leading bits of the curve index.
CELLS = 1 << 16


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of rows of cell numbers (n, dimensions), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def string_cuts(df: DataFrame, dim: str, bits: int) -> list[tuple[str, int]]:
    """The strings at which a dimension is cut, and by how many cells: a string's cell is the share of the
    rows that order before it.

    Distinct values are counted, dealt to ranges in their order and summed range by range, so any number
    of values and any length will do; 2 ** bits - 1 strings at most come back.
    """
    values = df.filter(F.col(dim).isNotNull()).groupBy(F.col(dim).alias("value")).agg(F.count("*").alias("n"))
    ranged = values.repartitionByRange("value").withColumn("part", F.spark_partition_id())
    ranged, _ = materialise(ranged, "hilbert-values")
    sums = ranged.groupBy("part").agg(F.sum("n").alias("rows"))  # a row per range
    first = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("part", first.alias("first"), F.sum("rows").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy("value")
    earlier = F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("earlier", earlier).join(F.broadcast(sums), "part")
    cell = F.expr(f"((first + earlier) * {1 << bits}) div total")
    got = placed.groupBy(cell.alias("cell")).agg(F.min("value").alias("value")).collect()
    found = sorted((r["value"], r["cell"]) for r in got)
    return [(value, cell - before) for (_, before), (value, cell) in zip(found, found[1:], strict=False)]


def quantised(df: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """Adds ``cells``: for each dimension the number of its quantile cuts at or below the value; null is 0."""
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    text = [d for d, kind in df.dtypes if d in dims and kind == "string"]
    number = [d for d in dims if d not in text]
    cuts = {d: string_cuts(df, d, bits) for d in text}
    if number:
        asked = [F.percentile_approx(F.col(d).cast("double"), steps, 10_000).alias(d) for d in number]
        found = df.agg(*asked).first()  # (2 ** bits - 1) numbers per dimension, whatever the data
        cuts |= {d: [(float(x), 1) for x in found[d] or []] for d in number}
    cells = []
    for d in dims:
        v = F.col(d) if d in text else F.col(d).cast("double")
        below = [F.when(v >= F.lit(x), by).otherwise(0) for x, by in cuts[d]]
        cells.append(sum(below, F.lit(0)))
    return df.withColumn("cells", F.array(*[c.cast("int") for c in cells]))


def curve(cells: Column, bits: int) -> Column:
    """``hilbert_index`` of an array of cell numbers, a batch of rows at a time."""

    @F.pandas_udf("long")
    def along(c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack(c.to_numpy()), bits)) if len(c) else pd.Series([], dtype="int64")

    return along(cells)


def lay_out(cells: list[tuple[int, int]], run_bytes: int) -> tuple[list[tuple[int, int, int]], int]:
    """(cell, first run, runs) for (cell, bytes) in curve order, and the number of runs.

    Light cells share a run up to ``run_bytes``; a heavier one gets as many runs of its own as it fills.
    """
    out, run, filled = [], 0, 0
    for cell, size in sorted(cells):
        if filled and filled + size > run_bytes:
            run, filled = run + 1, 0
        own = max(1, -(-size // run_bytes))
        out.append((cell, run, own))
        run, filled = (run + own, 0) if own > 1 else (run, filled + size)
    return out, max(1, run + (filled > 0))


def shard(
    docs: DataFrame,
    dims: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 8,
    bits: int = BITS,
    run_bytes: int = RUN_BYTES,
) -> tuple[DataFrame, str]:
    """Write all rows as Hilbert-ordered runs; (rows with shard, slot and run, folder of the runs).

    ``dims`` maps a name to an expression over the input's columns; the default takes the source, the
    language, the size and the id, as far as the columns exist.  The runs hold id, text, size (UTF-8
    bytes and one), the dimensions and the curve index; shard s is the rows whose rank r has
    floor(r * shards / rows) = s, slot counts from 0 in it, so counts differ by one at most.

    A null dimension falls in the first cell; a null text has size 1; a null id orders first.  Ties on
    the curve are ordered by id inside a run, then by a hash of the text; repeated rows are separate
    rows.  An empty table gives an empty result and one empty run.  Extra columns are not written; their
    names may clash with anything.
    """
    have = {c.lower() for c in docs.columns}
    if dims is None:
        roles = {f"dim_{c}": c for c in ("source", "lang") if c in have}
        base = pick(docs, doc_id=id_col, text=text_col, **roles)
    else:
        flat = docs.select("*", *[v.alias(f"dim_{k}") for k, v in dims.items()])
        base = pick(flat, doc_id=id_col, text=text_col, **{f"dim_{k}": f"dim_{k}" for k in dims})
    base = base.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long"))
    base = base.withColumn("doc_id", F.col("doc_id").cast("long"))
    names = [c for c in base.columns if c.startswith("dim_")] + (["size", "doc_id"] if dims is None else [])
    base = quantised(base, names, bits)
    base = base.withColumn("curve", curve(F.col("cells"), bits)).withColumn("tie", F.xxhash64("text"))
    spare = max(0, bits * len(names) - CELLS.bit_length() + 1)
    cell = F.shiftrightunsigned("curve", spare)
    weights = [(r[0], r[1]) for r in base.groupBy(cell.alias("cell")).agg(F.sum("size")).collect()]  # CELLS at most
    total = sum(w for _, w in weights)
    layout, runs = lay_out(weights, max(run_bytes, -(-total // MAX_RUNS)))
    table = docs.sparkSession.createDataFrame(layout, "cell long, first int, own int")
    placed = base.withColumn("cell", cell).join(F.broadcast(table), "cell")
    deal = F.pmod(F.xxhash64("doc_id", "tie", F.monotonically_increasing_id()), F.col("own"))
    placed = (
        placed.withColumn("to", (F.col("first") + deal).cast("int"))
        .drop("cell", "first", "own")
        .repartitionById(runs, "to")
        .sortWithinPartitions("to", "curve", "doc_id", "tie")
        .withColumn("place", F.monotonically_increasing_id())
    )
    written, path = materialise(placed, "hilbert-runs")
    return cut(written, shards), path


def cut(written: DataFrame, shards: int) -> DataFrame:
    """Adds run, rank, shard and slot to runs that were written with their ``place``.

    The counts of the runs (one row a run) give each run its first rank.
    """
    run = F.shiftrightunsigned("place", 33).cast("int")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = written.groupBy(run.alias("run")).agg(F.count("*").alias("rows"))
    order = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("run", F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("before"), F.sum("rows").over(Window.partitionBy()).alias("total"))
    ranked = written.withColumn("run", run).join(F.broadcast(counts), "run").withColumn("rank", F.col("before") + inside)
    exact = F.expr(f"(rank * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", exact.cast("int"))
        .withColumn("slot", (F.col("rank") - first).cast("long"))
        .drop("before", "total", "place", "tie", "to")
    )


def manifest(rows: DataFrame) -> DataFrame:
    """What a reader prunes by: per shard and run the row range and the span of each dimension."""
    spans = [f for c in rows.columns if c.startswith("dim_") or c in ("size", "doc_id") for f in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    return rows.groupBy("shard", "run").agg(F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), *spans)
