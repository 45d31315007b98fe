"""Hard-deleted rows found by comparing digests of key ranges.

Both sides give one row for each key range: how many keys it holds and the sums of their first three
powers, modulo a prime.  Sums have no order, so each side adds up its own rows where they are stored.
Only ranges whose digests differ are cut finer and compared again; keys are compared one by one in what
is left.  Where few rows were deleted, neither side shuffles or sends its keys.

A range is called equal when count and sums are equal.  Where keys only left, the count tells.  Where as
many new keys came, up to three of each always give other sums (in ranges no wider than the prime); four
or more of each agree in all three sums only by rare chance.  Every difference is settled on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart.operators.reconcile import hard_delete_removed
from contentmart.operators.sizing import broadcast_limit, key_table_bytes, maybe_broadcast
from contentmart.sources.extract import JdbcSource, extract_full

#: Ranges of the first comparison, and the most that are cut finer; beyond that keys are compared.
RANGES = 4096
#: Finer ranges that one differing range is cut into.
FANOUT = 64
#: A range this narrow is not cut any more.
LEAF_WIDTH = 4096
#: The prime of the power sums: products of two residues fit a 64-bit integer.
PRIME = 2**31 - 1
#: Stretches of keys named in one statement to a database.
STRETCHES = 128

DIGEST = ("n", "s1", "s2", "s3")


class KeyRanges:
    """Ranges of equal width over the span of the target's keys, numbered from 0."""

    def __init__(self, low: int, high: int, ranges: int = RANGES, fanout: int = FANOUT, leaf: int = LEAF_WIDTH):
        self.low, self.high, self.fanout, self.leaf = low, high, fanout, leaf
        # The first width is a power of the fan-out times the last, so that ranges nest.
        self.width = leaf
        while self.width * ranges <= high - low:
            self.width *= fanout

    def finer(self) -> bool:
        """Cut every range into ``fanout`` ones, if they are wide enough for that."""
        if self.width <= self.leaf:
            return False
        self.width //= self.fanout
        return True

    def number(self, key: str):
        return F.expr(f"(`{key}` - ({self.low}L)) div {self.width}L")

    def stretches(self, numbers: list[int]) -> list[tuple[int, int]]:
        """The key intervals [from, to) of these ranges, neighbours joined."""
        out: list[list[int]] = []
        for n in sorted(numbers):
            start = self.low + n * self.width
            if out and out[-1][1] == start:
                out[-1][1] = start + self.width
            else:
                out.append([start, start + self.width])
        return [(a, min(b, self.high + 1)) for a, b in out]


def _within(rows: DataFrame, key: str, ranges: KeyRanges, numbers: list[int] | None, limit: int) -> DataFrame:
    """The rows whose key lies in the ranges with these numbers (None: in any)."""
    rows = rows.filter(F.col(f"`{key}`").between(ranges.low, ranges.high))
    if numbers is None:
        return rows
    listed = rows.sparkSession.createDataFrame([(n,) for n in numbers], "__listed long")
    listed = maybe_broadcast(listed, key_table_bytes(len(numbers), 1, 0), limit)
    return rows.join(listed, ranges.number(key) == F.col("__listed"), "left_semi")


def range_digests(keys: DataFrame, key: str, ranges: KeyRanges) -> DataFrame:
    """(range, n, s1, s2, s3) of the ranges that hold keys.  Sums combine in each task."""
    m = F.pmod(F.col(f"`{key}`") - F.lit(ranges.low), F.lit(PRIME))
    parts = keys.select(ranges.number(key).alias("range"), m.alias("m"))
    square = F.pmod(F.col("m") * F.col("m"), F.lit(PRIME))
    parts = parts.withColumn("m2", square).withColumn("m3", F.pmod(F.col("m2") * F.col("m"), F.lit(PRIME)))
    return parts.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.sum("m").alias("s1"), F.sum("m2").alias("s2"), F.sum("m3").alias("s3")
    )


class _FrameSide:
    """Keys in files or frames: digests are Spark aggregations over the key column alone."""

    def __init__(self, keys: DataFrame, key: str, limit: int):
        self.keys, self.limit = keys.select(F.col(key).cast("bigint").alias("id")), limit

    def digests(self, ranges: KeyRanges, held: KeyRanges, numbers: list[int] | None) -> DataFrame:
        return range_digests(_within(self.keys, "id", held, numbers, self.limit), "id", ranges)

    def pull(self, ranges: KeyRanges, numbers: list[int]) -> DataFrame:
        return _within(self.keys, "id", ranges, numbers, self.limit)


class _JdbcSide:
    """Keys in a database, which adds up the digests itself and sends one row for each range."""

    def __init__(self, spark: SparkSession, src: JdbcSource, table: str, key: str):
        self.spark, self.src, self.table, self.column = spark, src, table, key
        self.key = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(src.url).quoteIdentifier(key)
        self.props = {"fetchsize": str(src.fetch_size), **src.properties}

    def _conditions(self, ranges: KeyRanges, numbers: list[int] | None) -> list[str]:
        spans = [(ranges.low, ranges.high + 1)] if numbers is None else ranges.stretches(numbers)
        named = [f"({self.key} >= {a} AND {self.key} < {b})" for a, b in spans]
        return [" OR ".join(named[at : at + STRETCHES]) for at in range(0, len(named), STRETCHES)]

    def digests(self, ranges: KeyRanges, held: KeyRanges, numbers: list[int] | None) -> DataFrame:
        frames = None
        for where in self._conditions(held, numbers):
            # Products need 64 bits, also where the key has 32; a difference less its remainder divides evenly.
            prime, at = f"CAST({PRIME} AS BIGINT)", f"(CAST({self.key} AS BIGINT) - ({ranges.low}))"
            r = f"({at} - MOD({at}, {ranges.width})) / {ranges.width}"
            m = f"SELECT {r} AS r, MOD({at}, {prime}) AS m FROM {self.table} WHERE {where}"
            m2 = f"SELECT r, m, MOD(m * m, {prime}) AS m2 FROM ({m}) a"
            sums = f"SELECT r, COUNT(*) AS n, SUM(m) AS s1, SUM(m2) AS s2, SUM(MOD(m2 * m, {prime})) AS s3 FROM ({m2}) b GROUP BY r"
            rows = self.spark.read.jdbc(self.src.url, f"({sums}) d", properties=self.props)
            # A stretch of one statement never holds part of a range, so numbers don't meet across statements.
            rows = rows.toDF("range", *DIGEST).select(*[F.col(c).cast("long") for c in ("range", *DIGEST)])
            frames = rows if frames is None else frames.unionByName(rows)
        return frames

    def pull(self, ranges: KeyRanges, numbers: list[int]) -> DataFrame:
        rows = self.spark.read.jdbc(
            self.src.url, self.table, predicates=self._conditions(ranges, numbers), properties=self.props
        )
        return rows.select(F.col(self.column).cast("bigint").alias("id"))


def differing_ranges(target: _FrameSide, source, ranges: KeyRanges) -> list[int]:
    """Numbers of the ranges, cut as fine as it pays, in which the sides differ.

    ``ranges`` ends at the width the numbers count in.  At most RANGES are cut finer at once, so the list
    has at most RANGES times FANOUT numbers, whatever the tables hold.
    """
    numbers = None
    while True:
        held = KeyRanges(ranges.low, ranges.high, fanout=ranges.fanout, leaf=ranges.leaf)
        held.width = ranges.width if numbers is None else ranges.width * ranges.fanout
        ours = target.digests(ranges, held, numbers)
        theirs = source.digests(ranges, held, numbers).toDF("their_range", *[f"their_{c}" for c in DIGEST])
        same = [F.col(c).eqNullSafe(F.col(f"their_{c}")) for c in DIGEST]
        equal = same[0] & same[1] & same[2] & same[3]
        # Ranges that only the source has are of no concern: nothing of the target can be missing there.
        found = ours.join(theirs, F.col("range") == F.col("their_range"), "left").filter(~equal)
        numbers = [r["range"] for r in found.select("range").collect()]
        if not numbers or len(numbers) > RANGES or not ranges.finer():
            return numbers


def removed_by_digest(
    target: DataFrame,
    target_key: str,
    source,
    table: str | None = None,
    source_key: str = "id",
    broadcast_bytes: int | None = None,
    ranges: int = RANGES,
    fanout: int = FANOUT,
    leaf: int = LEAF_WIDTH,
) -> DataFrame:
    """Target rows whose key left the source: the rows of ``hard_delete_removed``.

    ``target`` should be stored, for it is read once for its span, once for each comparison (the key
    column alone) and once for the result; ``source`` is a JDBC source, a file source, a dict of frames
    (each with ``table``) or a frame.  Keys are whole numbers.  Rows without a key have left, as in the
    key comparison.  Keys that repeat are counted as often as they stand, so a repeat on one side makes
    a range differ, no more.  A source that changes meanwhile is seen, range by range, as it is at one
    moment of the run.
    """
    spark = target.sparkSession
    limit = broadcast_limit(spark, broadcast_bytes)
    no_key = target.filter(F.col(target_key).isNull())
    low, high = target.agg(F.min(target_key), F.max(target_key)).first()
    if low is None:
        return no_key
    theirs = _JdbcSide(spark, source, table, source_key) if isinstance(source, JdbcSource) else None
    if theirs is None:
        theirs = _FrameSide(extract_full(spark, source, table), source_key, limit)
    cut = KeyRanges(int(low), int(high), ranges, fanout, leaf)
    numbers = differing_ranges(_FrameSide(target, target_key, limit), theirs, cut)
    if not numbers:
        return no_key
    suspects = _within(target, target_key, cut, numbers, limit)
    return hard_delete_removed(suspects, target_key, theirs.pull(cut, numbers), "id").unionByName(no_key)
