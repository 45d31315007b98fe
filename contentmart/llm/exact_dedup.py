"""Exact deduplication against immutable snapshots.

Documents arrive in batches.  The distinct texts of a batch become an immutable snapshot: exact
buckets (digest, normalised text) plus one static binary-fuse filter per digest range (Graf and
Lemire, 2022).  An incoming digest is screened by the filters of all earlier snapshots; only a
positive one joins the exact buckets, where the bytes are compared.  Duplicates inside a batch are
grouped on their own, by digest and bytes, before any of that.

Scale: a copy group collapses map-side (group by digest and text), so a text held by a third of all
rows is one row per input partition in the only shuffle that carries texts.  Filters and screening
work on distinct digests, which are spread evenly over the ranges whatever the texts are.  Two texts
with one digest are told apart by their bytes, whatever the digest is.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.llm.common import WHITESPACE, materialise, pick

#: Distinct digests aimed at for one filter; the number of ranges follows the data.
KEYS_PER_FILTER = 32_768


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITESPACE, "")


def digest64(norm: Column) -> Column:
    return F.xxhash64(norm)


# --- binary-fuse filter -----------------------------------------------------


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys ^ np.uint64(seed)
    for shift, mul in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
    return h ^ (h >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """Segment length and number of segment starts for ``n`` keys, three slots a key."""
    if n < 2:
        return 4, 1
    seg = min(1 << int(math.floor(math.log(n) / math.log(3.33) + 2.25)), 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(n))
    starts = max(1, math.ceil(n * factor / seg) - 2)
    return seg, starts


def _slots(h: np.ndarray, seg: int, starts: int) -> np.ndarray:
    mask = np.uint64(seg - 1)
    h0 = ((h >> np.uint64(32)) * np.uint64(starts * seg)) >> np.uint64(32)
    h1 = (h0 + np.uint64(seg)) ^ ((h >> np.uint64(18)) & mask)
    h2 = (h0 + np.uint64(2 * seg)) ^ (h & mask)
    return np.stack([h0, h1, h2]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_fuse(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """A static filter of distinct uint64 keys: (seed, segment length, starts, one byte per slot).

    Peels in rounds: all slots that hold one remaining key are taken at once, and the bytes are set
    in the opposite order.  A seed whose graph does not peel is replaced, with more room every tenth.
    """
    n = len(keys)
    seg, starts = _shape(n)
    for seed in range(1, 200):
        if seed % 10 == 0:
            starts += max(1, starts // 8)
        h = _mix(keys, seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
        slots = _slots(h, seg, starts)
        size = (starts + 2) * seg
        count = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # exclusive-or of the keys that remain in the slot
        for row in slots:
            np.bitwise_xor.at(owner, row, np.arange(n))
        order, done = [], 0
        free = np.flatnonzero(count == 1)
        while len(free):
            key, first = np.unique(owner[free], return_index=True)
            slot = free[first]
            order.append((key, slot))
            done += len(key)
            touched = slots[:, key].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(owner, touched, np.tile(key, 3))
            free = np.unique(touched)
            free = free[count[free] == 1]
        if done == n:
            table, fp = np.zeros(size, np.uint8), _prints(h)
            for key, slot in reversed(order):
                mine = slots[:, key]
                rest = table[mine[0]] ^ table[mine[1]] ^ table[mine[2]] ^ table[slot]
                table[slot] = fp[key] ^ rest
            return seed, seg, starts, table.tobytes()
    raise RuntimeError("no seed peels; are the keys distinct?")


def in_fuse(keys: np.ndarray, seed: int, seg: int, starts: int, table: bytes) -> np.ndarray:
    h = _mix(keys, seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
    slots, t = _slots(h, seg, starts), np.frombuffer(table, np.uint8)
    return (t[slots[0]] ^ t[slots[1]] ^ t[slots[2]]) == _prints(h)


FILTER_SCHEMA = "range int, snapshot int, seed int, seg int, starts int, n long, table binary"


def _build_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    keys = np.unique(pdf["digest"].to_numpy(np.int64).view(np.uint64))
    seed, seg, starts, table = build_fuse(keys)
    return pd.DataFrame(
        {"range": [key[0]], "snapshot": [key[1]], "seed": [seed], "seg": [seg], "starts": [starts], "n": [len(keys)], "table": [table]}
    )


def build_filters(digests: DataFrame, ranges: int) -> DataFrame:
    """One filter per (digest range, snapshot) from ``digests`` (snapshot int, digest long)."""
    keyed = digests.select("snapshot", "digest", _range(ranges))
    return keyed.groupBy("range", "snapshot").applyInPandas(_build_group, FILTER_SCHEMA)


def _range(ranges: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(ranges)).cast("int").alias("range")


def _screen_group(incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    keys = incoming["digest"].to_numpy(np.int64).view(np.uint64)
    batch = incoming["snapshot"].to_numpy()
    hit = np.zeros(len(keys), bool)
    for f in filters.itertuples():
        later = batch > f.snapshot
        hit[later] |= in_fuse(keys[later], f.seed, f.seg, f.starts, f.table)
    return incoming.loc[hit, ["snapshot", "digest"]]


def screen(incoming: DataFrame, filters: DataFrame, ranges: int) -> DataFrame:
    """The (snapshot, digest) rows that some earlier snapshot's filter lets through."""
    left = incoming.select("snapshot", "digest", _range(ranges)).groupBy("range")
    return left.cogroup(filters.groupBy("range")).applyInPandas(_screen_group, "snapshot int, digest long")


# --- the operator -----------------------------------------------------------


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int = 2,
    digest=digest64,
    keys_per_filter: int = KEYS_PER_FILTER,
) -> DataFrame:
    """Every row with the row that stays for it: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space.  Of equal texts the row with the most
    code points stays, then the smallest id, then the first row read.  ``batches`` is the number of
    arriving batches the rows are dealt to by a hash of the id; it does not change the result.

    Null text counts as empty, and all empty texts are one group.  A null id loses to any other id.
    Rows repeated with their id are separate rows, of which one at most is kept.  An empty table
    gives an empty result; extra columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    base = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce("text", F.lit(""))).alias("n_cp"),
        normalised(F.col("text")).alias("norm"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("snapshot"),
    )
    base = base.withColumn("digest", digest(F.col("norm")))

    # Batch by batch: distinct texts by digest and bytes; copies collapse before the shuffle.
    texts = base.groupBy("snapshot", "digest", "norm").agg(F.count("*").alias("n"))
    texts, _ = materialise(texts.withColumn("text_sha256", F.sha2("norm", 256)), "exact-buckets")
    digests, _ = materialise(texts.select("snapshot", "digest").distinct(), "exact-digests")

    # Snapshots screen the batches that came after them; positives are compared with the exact buckets
    # byte by byte, and where an earlier snapshot has the text, the first that has it is its home.
    n_digests = digests.count()
    ranges = max(1, math.ceil(n_digests / max(1, keys_per_filter * batches)))
    filters, _ = materialise(build_filters(digests, ranges), "exact-filters")
    positive, _ = materialise(screen(digests, filters, ranges), "exact-positives")
    new = texts.join(positive, ["snapshot", "digest"], "left_semi").select(
        "digest", "text_sha256", F.col("norm").alias("new_norm"), F.col("snapshot").alias("new_snapshot")
    )
    same = (F.col("snapshot") < F.col("new_snapshot")) & (F.col("norm") == F.col("new_norm"))
    found = new.join(texts.select("digest", "snapshot", "norm"), "digest").filter(same)
    homes = found.groupBy("new_snapshot", "digest", "text_sha256").agg(F.min("snapshot").alias("home"))
    homes, _ = materialise(homes.withColumnRenamed("new_snapshot", "snapshot"), "exact-homes")

    # Each batch's own groups; those with a home in a snapshot join the group there, and only these
    # groups are summed.  All others are whole as they are.
    rows = base.select("doc_id", "n_cp", F.sha2("norm", 256).alias("text_sha256"), "snapshot", "digest")
    rows, _ = materialise(rows.withColumn("rid", F.monotonically_increasing_id()), "exact-rows")
    order = F.struct(
        "n_cp",
        F.col("doc_id").isNotNull().alias("has_id"),
        F.bitwise_not("doc_id").alias("by_id"),
        F.bitwise_not("rid").alias("by_rid"),
    )
    at = ["snapshot", "digest", "text_sha256"]
    groups = rows.groupBy(*at).agg(F.max(order).alias("best"), F.count("*").alias("size"))
    called = homes.select(F.col("home").alias("snapshot"), "digest", "text_sha256", F.lit(True).alias("called")).distinct()
    groups = groups.join(homes, at, "left").join(called, at, "left")
    groups, _ = materialise(groups.withColumn("home", F.coalesce("home", "snapshot")), "exact-groups")
    joined = (F.col("home") != F.col("snapshot")) | F.coalesce("called", F.lit(False))
    summed = groups.filter(joined).groupBy("home", "digest", "text_sha256").agg(
        F.max("best").alias("best"), F.sum("size").alias("size")
    )
    joined_groups = groups.filter(joined).select(*at, "home").join(summed, ["home", "digest", "text_sha256"])
    whole = groups.filter(~joined).select(*at, "best", "size").unionByName(joined_groups.select(*at, "best", "size"))
    keep = whole.select(
        *at,
        F.bitwise_not("best.by_id").alias("keep_id"),
        F.bitwise_not("best.by_rid").alias("keep_rid"),
        F.col("size").alias("group_size"),
    )
    # Written first: the join below then shuffles both sides itself, and Spark can split a hot text.
    keep, _ = materialise(keep, "exact-keep")
    return rows.join(keep, at).select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256"
    )
