"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [names...]"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

from contentmart.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = get_session()
if os.environ.get("ORACLE_SESSION_TZ"):
    spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_SESSION_TZ"])
qs, sqls = E.queries(), E.oracle_sql()
con = duck(sf)
bad = 0
for name in names or list(qs):
    t = time.time()
    try:
        r = compare(spark, name, qs[name], sqls.get(name), sf, con)
    except Exception as e:  # report and go on
        r = {"name": name, "status": "ERROR", "error": str(e)[:800]}
    r["sec"] = round(time.time() - t, 2)
    bad += r["status"] not in ("ok", "rows-only")
    print(json.dumps(r), flush=True)
print("FAILED" if bad else "ALL OK", bad)
