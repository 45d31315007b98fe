"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_REPEAT``
(default 3) timed runs.  A run executes the whole plan into Spark's ``noop``
sink (nothing is collected to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contentmart import fixtures, registry, schemas  # noqa: E402
from contentmart.operators import dims, facts, merge  # noqa: E402
from contentmart.session import get_session, local_conf, scratch_path  # noqa: E402
from contentmart.sources.publish import BucketedTable  # noqa: E402

HEADLINE = [
    "fact_full_load",
    "fact_delta_source",
    "merge_fact_shuffle",
    "merge_fact_broadcast",
    "merge_fact_small_delta",
    "merge_fact_small_delta_shuffle",
    "merge_dim_articles",
    "merge_dim_authors",
    "cdc_apply",
    "dim_date",
    "check_foreign_key",
    "hard_delete_removed",
]


# An hourly run: a stored fact and a staged delta of one article in a hundred; only the merge is timed.
STORED = ["stored_merge_broadcast", "stored_merge_shuffle", "stored_merge_bucketed"]


def stored_merges(spark, sf_dir: str) -> dict:
    root = scratch_path(spark, "bench")
    fact, delta = registry.QUERIES["fact_full_load"](spark, sf_dir), fixtures.delta(spark, sf_dir).filter("id % 100 = 0")
    authors = dims.dim_authors(fixtures.authors(spark, sf_dir))
    facts.fact_delta_source(delta, authors).write.parquet(f"{root}/delta")
    source = spark.read.parquet(f"{root}/delta")
    fact.write.parquet(f"{root}/fact")
    bucketed = BucketedTable(spark, f"{root}/bucketed", schemas.FACT_REPORTS_ARTICLES, "article_id", buckets=8)
    bucketed.publish(fact)
    spec = facts.fact_merge_spec()

    def over_files(strategy: str):
        return lambda *_: merge.merge(spark.read.parquet(f"{root}/fact"), source, spec, strategy, staged=True)

    return {
        "stored_merge_broadcast": over_files("broadcast"),
        "stored_merge_shuffle": over_files("shuffle"),
        "stored_merge_bucketed": lambda *_: merge.merge(bucketed.read(), source, spec, staged=True, buckets=8),
    }


def run(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    df = query(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE + STORED
    conf = local_conf(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    spark = get_session(conf, app="contentmart-bench")
    results = {}
    queries = dict(registry.QUERIES)
    if set(names) & set(STORED):
        queries |= stored_merges(spark, sf_dir)
    for name in names:
        run(spark, queries[name], sf_dir)  # warm-up
        results[name] = round(statistics.median(run(spark, queries[name], sf_dir) for _ in range(repeat)), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(results.values()), 4),
                "unit": "sec",
                "queries": results,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeat": repeat,
                "driver_memory": conf.get("spark.driver.memory"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
