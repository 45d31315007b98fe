"""Line deduplication by overlapping windows of consecutive lines.

Every run of three consecutive lines is hashed (128 bits).  Windows that occur more than once are
found over all documents; the first occurrence, by (id, row, position), stays, and the lines that
later occurrences cover are merged and removed.  Each removed line still stands at an earlier place,
since every window that goes points at an occurrence before it.

Scale: texts stay in the written table; only (row, position, hash) is shuffled.  A passage held by a
third of all documents is a hot hash: its count and first place come from a map-side combined
aggregation, which is written; the join back reads two tables, so Spark splits the hot hash.  Within a
document, spans and lines are handled in time linear in its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.llm.common import materialise, place, positional

WINDOW = 3


def _window_hash(hashes: str, i: Column, window: int) -> Column:
    lines = [F.element_at(F.col(hashes), i + k + 1) for k in range(window)]
    return F.concat(*lines)


def first_places(windows: DataFrame) -> DataFrame:
    """(h, first_rid, first_pos) of every window that repeats, as a written table.

    Written, because a join on top of the aggregation would take over its partitions, and those of a hot
    hash could not be split.
    """
    first = windows.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("doc", "rid", "pos")).alias("first"))
    first = first.filter("n > 1").select("h", F.col("first.rid").alias("first_rid"), F.col("first.pos").alias("first_pos"))
    return materialise(first, "line-first")[0]


def later_windows(windows: DataFrame, first: DataFrame) -> DataFrame:
    """(rid, pos) of the windows that stand at an earlier place too."""
    found = windows.select("h", "rid", "pos").join(first.hint("merge"), "h")
    return found.filter("not (rid = first_rid and pos = first_pos)").select("rid", "pos")


def _shifted(values: Column, first: Column) -> Column:
    """``values`` one place later, ``first`` in front; as many as before."""
    return F.concat(F.array(first), F.slice(values, 1, F.size(values) - 1))


def _spans(starts: Column, window: int) -> Column:
    """The line spans that windows at these sorted ``starts`` cover, merged where they overlap or touch.

    Each start is compared with its neighbours only, so the work grows with their number.
    """
    none = F.lit(None).cast("int")
    before = _shifted(starts, none)
    after = F.concat(F.slice(starts, 2, F.size(starts)), F.array(none))
    opens = F.zip_with(starts, before, lambda p, q: F.when(q.isNull() | (p - q > window), p))
    closes = F.zip_with(starts, after, lambda p, q: F.when(q.isNull() | (q - p > window), p + (window - 1)))
    return F.zip_with(
        F.array_compact(opens), F.array_compact(closes), lambda a, b: F.struct(a.alias("from"), b.alias("to"))
    )


def _stays(removed: Column) -> Column:
    """For each line up to the last removed one, whether it stays."""
    froms, tos = removed.getField("from"), removed.getField("to")
    runs = F.arrays_zip(froms.alias("a"), tos.alias("b"), _shifted(tos, F.lit(-1)).alias("last"))
    return F.flatten(
        F.transform(
            runs,
            lambda r: F.concat(
                F.array_repeat(F.lit(True), r["a"] - r["last"] - 1), F.array_repeat(F.lit(False), r["b"] - r["a"] + 1)
            ),
        )
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """All rows and columns of ``docs`` with repeated passages taken out of the text.

    Adds n_lines, n_removed (int) and removed, an array of (from, to) line spans, counted from 0, in
    order and disjoint.  Lines end at a newline and are compared as they are.  A text of fewer than
    ``window`` lines has no window and stays as it is.

    Null text stays null with n_lines 0; an empty text is one empty line.  A null id orders before
    all others; rows that repeat an id are separate rows, ordered as read.  Texts whose lines all
    repeat become empty.  An empty table gives an empty result.  Extra columns pass through; input
    columns called n_lines, n_removed or removed are replaced.
    """
    names, added = docs.columns, ("n_lines", "n_removed", "removed")
    id_at, text_at = place(docs, id_col), place(docs, text_col)
    flat = positional(docs).withColumn("rid", F.monotonically_increasing_id())
    flat, _ = materialise(flat, "line-rows")
    rid, doc, text = "rid", f"__c{id_at}", f"__c{text_at}"

    hashed = flat.select(
        F.col(doc).alias("doc"), rid, F.transform(F.split(text, "\n", -1), lambda x: F.unhex(F.md5(x))).alias("lines")
    ).filter(F.size("lines") >= window)
    places = F.transform(
        F.sequence(F.lit(0), F.size("lines") - window),
        lambda i: F.unhex(F.md5(_window_hash("lines", i, window))),
    )
    windows = hashed.select("doc", rid, F.posexplode(places).alias("pos", "h"))
    windows, _ = materialise(windows, "line-windows")

    later = later_windows(windows, first_places(windows))
    later, _ = materialise(later, "line-later")

    covered = later.groupBy("rid").agg(F.sort_array(F.collect_list("pos")).alias("starts"))
    covered = covered.select("rid", _spans(F.col("starts"), window).alias("removed"))

    # A sort-merge join at every size: the spans grow with the corpus, so they are never broadcast.
    joined = flat.join(covered.hint("merge"), "rid", "left")
    lines = F.split(text, "\n", -1)
    left = F.zip_with(lines, _stays(F.col("removed")), lambda x, stays: F.when(F.coalesce(stays, F.lit(True)), x))
    cut = F.array_join(left, "\n")  # joins what is not null
    new_text = F.when(F.col("removed").isNull(), F.col(text)).otherwise(cut)
    result = [
        (new_text if i == text_at else F.col(f"__c{i}")).alias(c)
        for i, c in enumerate(names)
        if c.lower() not in added
    ]
    spans_out = F.coalesce("removed", F.array().cast("array<struct<from:int,to:int>>"))
    n_removed = F.aggregate(spans_out, F.lit(0), lambda a, s: a + s["to"] - s["from"] + 1)
    return joined.select(
        *result,
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        n_removed.alias("n_removed"),
        spans_out.alias("removed"),
    )


#: The same rule for DuckDB over ``{docs}``: texts of windows instead of their hashes.
SQL = """
WITH d AS (SELECT *, string_split(text, chr(10)) AS ls FROM {docs}),
w AS (
  SELECT doc_id, i AS pos, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS win
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM d)
),
later AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS k FROM w)
  WHERE k > 1
),
cover AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM later),
gone AS (SELECT doc_id, list(pos) AS cut, count(*) AS n FROM cover GROUP BY doc_id)
SELECT d.doc_id,
  CASE WHEN g.n IS NULL THEN d.text
       ELSE coalesce(array_to_string([d.ls[i] FOR i IN range(1, len(d.ls) + 1) IF NOT list_contains(g.cut, i)], chr(10)), '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(d.ls) END AS n_lines,
  coalesce(g.n, 0) AS n_removed
FROM d LEFT JOIN gone g USING (doc_id)
"""
