"""Run registered training-data queries against their SQL: python tests/llm/run_check.py SF_DIR NAME..."""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import __spark_entry__ as E  # noqa: E402
import duckdb  # noqa: E402
from oracle_compare import compare  # noqa: E402

from contentmart.session import get_session  # noqa: E402


def duck(sf_dir):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        p = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


if __name__ == "__main__":
    spark, sf = get_session(), sys.argv[1]
    for name in sys.argv[2:]:
        t = time.time()
        print(compare(spark, name, E.queries()[name], E.oracle_sql().get(name), sf, duck(sf)), round(time.time() - t, 1))
