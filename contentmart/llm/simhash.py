"""SimHash near-duplicate detection with a byte-position inverted index and count filtering.

A 64-bit fingerprint is eight positional bytes.  Fingerprints that differ in at most ``d`` bits differ
in at most ``d`` bytes, so they share at least ``8 - d`` positional bytes: the guaranteed minimum.
The inverted index maps positional bytes to fingerprints; a pair's shared bytes are tallied, pairs
below the minimum go, and the rest are verified on all 64 bits.

Lists of single bytes hold a 256th of all rows each, so their pairs grow with the square of the
corpus.  The index therefore keys combinations of positions: enough of them that any pair with the
minimum of shared bytes meets in one at least (a covering design, checked when it is built).

Scale: copies collapse to one fingerprint before anything is joined.  A pair is emitted once, from
the first combination it shares.  Lists longer than ``long_list`` (families of near copies with
thousands of different fingerprints) are not paired.  First their members within ``d`` bits of the one
nearest the list's middle (the majority of each bit) are linked to it.  What all these links reach is
contracted, and a list that lies in one component is done.  In the others the members outside the
largest component are compared with all, in blocks of ``BLOCK``; pairs within a component are not
looked at, and a pair of blocks gives back links that span the components it joins.  So a family of m
gives fewer than 2 m links, no link between components is lost, and none is made up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.llm.common import components, materialise, pick, place, positional, roots, with_row_id

SEED = 42
LONG_LIST = 64
#: Fingerprints in one block of a long list.
BLOCK = 2048
#: Bytes with A to Z lowered; no other UTF-8 byte is touched.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNK = 1 << 16


# --- fingerprints -------------------------------------------------------------


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of all word shingles, repeats included; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()  # at space and 9 to 13
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], gaps + 1])[: n - shingle + 1].tolist()
    ends = np.concatenate([gaps, [len(joined)]])[shingle - 1 :].tolist()
    total = n - shingle + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _CHUNK):
        h = np.fromiter(
            (digest(joined[s:e], SEED) for s, e in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)),
            np.uint64,
        )
        ones += _bit_counts(h)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > total).tolist()))


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the words have each bit, lowest bit first."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = len(bits) // 255 * 255
    out = np.zeros(64, np.int64)
    if full:  # sums of 255 bits fit a byte
        out += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return out + bits[full:].sum(axis=0, dtype=np.int64)


PRINTS = "rid long, doc_id long, fp long"


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), pa.array(fp.view(np.int64))], names=["rid", "doc_id", "fp"]
            )

    return run


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle=4) -> DataFrame:
    """(rid, doc_id, fp): a row's number, its id and its fingerprint's 64 bits as a signed long."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return rows.mapInArrow(_fingerprints(shingle), PRINTS)


# --- index --------------------------------------------------------------------


def covering(minimum: int, width: int) -> list[tuple[int, ...]]:
    """Combinations of ``width`` of the eight positions, one at least inside any ``minimum`` positions."""
    need = {frozenset(c) for c in combinations(range(8), minimum)}
    chosen = []
    while need:
        best = max(combinations(range(8), width), key=lambda c: sum(set(c) <= s for s in need))
        chosen.append(best)
        need = {s for s in need if not set(best) <= s}
    return chosen


def _byte(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255))


def _key(fp: Column, combo: tuple[int, ...]) -> Column:
    mask = sum(255 << (8 * i) for i in combo)
    return fp.bitwiseAND(F.lit(_signed(mask)))


def _tally(x: Column) -> Column:
    """Positional bytes that two fingerprints share, from their exclusive or."""
    return sum((F.when(_byte(x, i) == 0, 1).otherwise(0) for i in range(8)), F.lit(0))


def _first_combo(x: Column, combos: list[tuple[int, ...]]) -> Column:
    """The first combination whose bytes are all shared."""
    return F.coalesce(*[F.when(_key(x, c) == 0, F.lit(i)) for i, c in enumerate(combos)])


def width_for(n: int, minimum: int) -> int:
    """Bytes in a key: random fingerprints should share a list with a few others at most."""
    return max(1, min(minimum, 4, math.ceil(math.log2(max(n, 2)) / 8)))


def links(prints: DataFrame, max_bits: int, n: int, long_list: int = LONG_LIST, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect what lies within ``max_bits``; ``prints`` holds distinct fp.

    Where no list is long these are all pairs within ``max_bits``; otherwise links that span them.
    """
    if not 0 <= max_bits <= 7:
        raise ValueError("the byte index guarantees a shared byte for 0 to 7 differing bits only")
    minimum = 8 - max_bits
    combos = covering(minimum, width_for(n, minimum))
    fp = F.col("fp")
    index = prints.select(
        "fp", F.posexplode(F.array(*[_key(fp, c) for c in combos])).alias("combo", "key")
    )
    lists = index.groupBy("combo", "key").agg(F.count("*").alias("n")).filter("n > 1")
    lists, _ = materialise(lists, "simhash-lists")  # so that a hot list's rows are split in the join
    index, _ = materialise(index.join(lists, ["combo", "key"]), "simhash-index")
    short = index.filter(F.col("n") <= long_list)
    pair = short.select("combo", "key", F.col("fp").alias("a")).join(
        short.select("combo", "key", F.col("fp").alias("b")), ["combo", "key"]
    )
    x = F.col("a").bitwiseXOR(F.col("b"))
    met = pair.filter(
        (F.col("a") < F.col("b"))
        & (_tally(x) >= minimum)
        & (F.bit_count(x) <= max_bits)
        & (_first_combo(x, combos) == F.col("combo"))
    ).select("a", "b")
    long = index.filter(F.col("n") > long_list).select("combo", "key", "fp")
    if long.isEmpty():
        return met
    near = met.unionByName(_stars(long, max_bits))
    reached = components(near.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    reached, _ = materialise(reached.select(F.col("node").alias("fp"), "component"), "simhash-reached")
    spanning = reached.filter("fp != component").select(F.col("component").alias("a"), F.col("fp").alias("b"))
    return spanning.unionByName(_between(long, reached, max_bits, block))


def _stars(long: DataFrame, max_bits: int) -> DataFrame:
    """Links of each list's members to the one nearest the list's middle."""
    at = ["combo", "key"]
    fp = F.col("fp")
    bit = [fp.bitwiseAND(F.lit(_signed(1 << b))) != 0 for b in range(64)]
    sums = long.groupBy(*at).agg(F.count("*").alias("n"), *[F.count_if(c).alias(f"ones{b}") for b, c in enumerate(bit)])
    middle = F.lit(0).cast("long")
    for b in range(64):
        middle = middle.bitwiseOR(F.when(2 * F.col(f"ones{b}") > F.col("n"), F.lit(_signed(1 << b))).otherwise(F.lit(0)))
    middles, _ = materialise(sums.select(*at, middle.alias("middle")), "simhash-middles")
    away = F.bit_count(fp.bitwiseXOR(F.col("middle")))
    hubs = long.join(middles, at).groupBy(*at).agg(F.min_by("fp", F.struct(away.alias("away"), "fp")).alias("hub"))
    hubs, _ = materialise(hubs, "simhash-hubs")
    close = (fp != F.col("hub")) & (F.bit_count(fp.bitwiseXOR(F.col("hub"))) <= max_bits)
    return long.join(hubs, at).filter(close).select(F.col("hub").alias("a"), F.col("fp").alias("b"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _between(long: DataFrame, reached: DataFrame, max_bits: int, block: int) -> DataFrame:
    """Links between components, one fingerprint of each standing for it."""
    at = ["combo", "key"]
    label = F.coalesce("component", "fp").alias("component")
    member, _ = materialise(long.join(reached, "fp", "left").select(*at, "fp", label), "simhash-dense")
    parts = member.groupBy(*at, "component").agg(F.count("*").alias("n"))
    split = parts.groupBy(*at).agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("parts")
    )
    n_rest, n_top = F.col("n") - F.col("top.n"), F.col("top.n")
    split = split.filter("parts > 1").select(
        *at,
        F.col("top.component").alias("top"),
        F.ceil(n_rest / block).alias("rest_blocks"),
        F.ceil(n_top / block).alias("top_blocks"),
    )
    split, _ = materialise(split, "simhash-split")
    outside = F.col("component") != F.col("top")
    mine = F.when(outside, F.pmod(F.xxhash64("fp"), F.col("rest_blocks"))).otherwise(
        F.col("rest_blocks") + F.pmod(F.xxhash64("fp"), F.col("top_blocks"))
    )
    others = F.col("rest_blocks") + F.when(outside, F.col("top_blocks")).otherwise(0) - 1
    dealt = member.join(split, at).select(
        *at, "fp", "component", mine.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), others)).alias("other")
    )
    dealt = dealt.select(
        *at, "fp", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    made = dealt.groupBy(*at, "low", "high").applyInPandas(_compare(max_bits), "a long, b long")
    return made.distinct()


def _compare(max_bits: int):
    """Spanning links between the components that meet in one pair of blocks."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low, high = key[2], key[3]
        left = pdf[pdf["block"] == low]
        right = left if low == high else pdf[pdf["block"] == high]
        x, y = left["fp"].to_numpy(np.int64), right["fp"].to_numpy(np.int64)
        of_x, of_y = left["component"].to_numpy(np.int64), right["component"].to_numpy(np.int64)
        found = []
        for s in range(0, len(x), 256):
            part = slice(s, s + 256)
            bits = np.bitwise_count((x[part, None] ^ y[None, :]).view(np.uint64))
            i, j = np.nonzero((bits <= max_bits) & (of_x[part, None] != of_y[None, :]))
            if len(i):
                found.append(np.unique(np.stack([of_x[part][i], of_y[j]], axis=1), axis=0))
        if not found:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        pairs = np.concatenate(found)
        names, spot = np.unique(pairs, return_inverse=True)
        spot = spot.reshape(pairs.shape)
        root = roots(len(names), spot[:, 0], spot[:, 1])
        joined = root != np.arange(len(names))
        return pd.DataFrame({"a": names[root[joined]], "b": names[joined]})

    return run


def _grouped(rows: DataFrame, max_bits: int, long_list: int) -> DataFrame:
    """``rows`` (rid, doc_id, fp) with root, the smallest fingerprint that links reach."""
    nodes, _ = materialise(rows.select("fp").distinct(), "simhash-nodes")
    made = links(nodes, max_bits, nodes.count(), long_list)
    member = components(made.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    member, _ = materialise(member.select(F.col("node").alias("fp"), F.col("component").alias("root")), "simhash-members")
    rooted = rows.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return materialise(rooted, "simhash-rooted")[0]


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """Every row with its fingerprint (16 hex digits) and component_id, the smallest id reachable.

    Letters A to Z are lowered; words are split at ASCII white space; a text with fewer words than
    ``shingle`` is one shingle.  Null, empty and blank texts have fingerprint zero and link like any
    other.  Repeated rows share a fingerprint.  A null id is kept, takes part in links and never names
    a component unless nothing else is in it.  An empty table gives an empty result; extra columns
    are ignored, whatever their names.
    """
    rows, _ = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    rooted = _grouped(rows, max_bits, long_list)
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    least, _ = materialise(least, "simhash-least")  # so that a hot group's rows are split in the join
    return rooted.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stay: of each group of near duplicates the
    one with the smallest id, of rows that also share the id the first read; a null id stays only where
    no other is.  Other cases as in ``near_duplicates``.
    """
    flat, _ = with_row_id(positional(docs), "simhash-docs")
    at = {r: f"__c{place(docs, c)}" for r, c in (("doc_id", id_col), ("text", text_col))}
    hashed = flat.select("rid", F.col(at["doc_id"]).cast("long").alias("doc_id"), F.col(at["text"]).alias("text"))
    rows, _ = materialise(hashed.mapInArrow(_fingerprints(shingle), PRINTS), "simhash-rows")
    rooted = _grouped(rows, max_bits, long_list)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    stay = rooted.groupBy("root").agg(first.alias("first")).select(F.col("first.rid").alias("rid"))
    # A sort-merge join at every size: what stays grows with the corpus, so it is never broadcast.
    return flat.join(stay.hint("merge"), "rid", "left_semi").drop("rid").toDF(*docs.columns)
