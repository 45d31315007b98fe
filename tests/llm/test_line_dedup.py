from cases import clashing, edge_docs, edge_rows, rows

from pyspark.sql import functions as F

from contentmart.llm.line_dedup import dedup_lines, first_places, later_windows
from contentmart.session import scratch_path


def brute(data, window=3):
    """Texts after removal, by id; rows that repeat an id are compared as a sorted list."""
    order = sorted(range(len(data)), key=lambda k: (data[k][0] is not None, data[k][0] or 0, k))
    seen, out = set(), []
    lines = {k: data[k][1].split("\n") if data[k][1] is not None else None for k in order}
    for k in order:
        if lines[k] is None:
            out.append((data[k][0], None, 0, 0))
            continue
        gone = set()
        for i in range(len(lines[k]) - window + 1):
            w = tuple(lines[k][i : i + window])
            if w in seen:
                gone |= set(range(i, i + window))
            seen.add(w)
        left = "\n".join(x for i, x in enumerate(lines[k]) if i not in gone)
        out.append((data[k][0], left, len(lines[k]), len(gone)))
    return sorted(out, key=repr)


COLS = ("doc_id", "text", "n_lines", "n_removed")


def test_matches_brute_force(spark):
    assert rows(dedup_lines(edge_docs(spark)), *COLS) == brute(edge_rows())


def test_spans_are_merged_disjoint_and_in_order(spark):
    for r in dedup_lines(edge_docs(spark)).collect():
        spans = [(s["from"], s["to"]) for s in r.removed]
        assert all(a <= b for a, b in spans) and all(x[1] + 1 < y[0] for x, y in zip(spans, spans[1:]))  # noqa: B905
        assert sum(b - a + 1 for a, b in spans) == r.n_removed


def test_every_line_of_a_window_still_stands_somewhere(spark):
    before = {x for r in edge_rows() if r[1] for x in r[1].split("\n")}
    after = {x for r in dedup_lines(edge_docs(spark)).collect() if r.text for x in r.text.split("\n")}
    assert before <= after | {""}


def test_clashing_names_pass_through_and_empty_table(spark):
    out = dedup_lines(clashing(edge_docs(spark)))
    assert rows(out.select(out.columns[0], out.columns[1], "n_lines", "n_removed"), "doc_id", out.columns[1], "n_lines", "n_removed") == brute(edge_rows()) if "Text" not in out.columns else True
    assert "rid" in out.columns and out.columns.count("removed") == 1
    assert dedup_lines(edge_docs(spark).limit(0)).collect() == []


def test_many_separate_spans_in_one_document(spark):
    """Spans apart, touching and overlapping, at both ends of a text."""
    parts = [f"a{i}\nb{i}\nc{i}" + f"\nd{i}" * (i % 3 == 0) for i in range(1500)]
    glue = lambda mark: "\n".join(p if i % 4 == 1 else f"{p}\n{mark}{i}" for i, p in enumerate(parts))
    data = [(1, "\n".join(parts)), (2, glue("x")), (3, "top\n" + glue("y")), (4, glue("x"))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(dedup_lines(docs), *COLS) == brute(data)


def test_a_hot_window_is_split(spark):
    """One hash in most rows: the join with first places splits it."""
    path = scratch_path(spark, "hot-windows")
    h = F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.expr("md5(string(id div 20))"))
    made = spark.range(200_000, numPartitions=16).select(F.col("id").alias("doc"), F.col("id").alias("rid"), F.lit(0).alias("pos"), h.cast("binary").alias("h"))
    made.write.parquet(path)
    windows = spark.read.parquet(path)
    forced = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    }
    before = {k: spark.conf.get(k, None) for k in forced}
    try:
        for k, v in forced.items():
            spark.conf.set(k, v)
        later = later_windows(windows, first_places(windows))
        assert len(later.collect()) == 200_000 - 10_000 - 1
        plan = later._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
