"""Command line for the load jobs.

    python -m contentmart init        --warehouse ROOT [--layout ranged|snapshot] [--width N]
    python -m contentmart full-load   --warehouse ROOT (--jdbc-url URL | --files ROOT) [--staging]
    python -m contentmart incremental --warehouse ROOT (--jdbc-url URL | --files ROOT) [--since TS] [--until TS]
    python -m contentmart stream      --warehouse ROOT --landing DIR --checkpoint DIR [--continuous INTERVAL]
                                      [--jdbc-url URL | --files ROOT]                 # authors for every batch
    python -m contentmart reconcile   --warehouse ROOT (--jdbc-url URL | --files ROOT)   # hard deletes
    python -m contentmart vacuum      --warehouse ROOT [--grace-hours 24]               # drop old data

The warehouse layout (snapshots or key ranges) is chosen at ``init`` and
detected afterwards.  Without ``--since`` the incremental run uses "now minus
one day", as a scheduled run without an interval start would.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from contentmart import schemas
from contentmart.plans import jobs
from contentmart.session import cluster_conf, get_session, local_conf
from contentmart.sources.extract import FileSource, JdbcSource, resolve_since
from contentmart.sources.publish import Warehouse, read_layout
from contentmart.sources.ranged import RangedWarehouse
from contentmart.streaming.incremental import run_incremental_stream


def open_warehouse(spark, root: str, ranged: bool | None = None, width: int | None = None):
    """Open an existing warehouse (its recorded layout wins) or create one of the asked layout."""
    layout = read_layout(spark, root)
    if layout is not None:
        ranged = layout["layout"] == "ranged"
        width = layout.get("width", width)
    return RangedWarehouse(spark, root, width) if ranged else Warehouse(spark, root)


def _source(args):
    if args.jdbc_url:
        props = {"preferTimestampNTZ": "true"}
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        if args.jdbc_user:
            props["user"] = args.jdbc_user
            props["password"] = os.environ.get(args.jdbc_password_env or "", "")
        return JdbcSource(args.jdbc_url, props, partition_column="id", partitions=args.partitions)
    if args.files:
        return FileSource(args.files, args.format, schemas=dict(schemas.SOURCE) if args.format == "csv" else {})
    raise SystemExit("give --jdbc-url or --files")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="contentmart")
    p.add_argument("command", choices=["init", "full-load", "incremental", "stream", "reconcile", "vacuum"])
    p.add_argument("--warehouse", required=True)
    p.add_argument("--layout", default="ranged", choices=["ranged", "snapshot"], help="warehouse layout (init only)")
    p.add_argument("--width", type=int, help="keys per range (ranged layout; default: measured per table)")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="name of the variable holding the password")
    p.add_argument("--partitions", type=int, default=64, help="JDBC read partitions")
    p.add_argument("--files", help="folder with one sub-folder per source table")
    p.add_argument("--format", default="parquet")
    p.add_argument("--staging", action="store_true", help="hand off through delimited files")
    p.add_argument("--since")
    p.add_argument("--until")
    p.add_argument("--landing")
    p.add_argument("--checkpoint")
    p.add_argument("--continuous", help="processing-time trigger, e.g. '1 hour' (default: drain and stop)")
    p.add_argument("--table", default="articles", choices=["articles", "authors"], help="what the landing holds (stream)")
    p.add_argument("--cluster", action="store_true", help="use the cluster session profile")
    p.add_argument("--grace-hours", type=float, default=24, help="age below which unlisted folders are spared (vacuum)")
    p.add_argument("--on-violation", default="fail", choices=["fail", "quarantine"], help="rows that break a declared constraint")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session(cluster_conf() if args.cluster else local_conf())
    if args.command == "init":
        wh = open_warehouse(spark, args.warehouse, args.layout == "ranged", args.width)
        tables = jobs.init_warehouse(spark, wh)
        report = {"command": "init", "layout": type(wh).__name__, "dim_date": tables["dim_date"].count()}
    elif args.command == "full-load":
        wh = open_warehouse(spark, args.warehouse, width=args.width)
        result = jobs.full_load(spark, _source(args), warehouse=wh, staging=args.staging or None, on_violation=args.on_violation)
        report = {"command": "full-load", "rows": result.audit.counts()}
    elif args.command == "incremental":
        wh = open_warehouse(spark, args.warehouse, width=args.width)
        since = args.since or resolve_since(None)
        result = jobs.incremental_load(
            spark, _source(args), wh, since=since, until=args.until, staging=args.staging or None, on_violation=args.on_violation
        )
        report = {"command": "incremental", "since": since, "skipped": result.skipped, "rows": result.audit.counts()}
    elif args.command == "vacuum":
        wh = open_warehouse(spark, args.warehouse, width=args.width)
        report = {"command": "vacuum", "removed": len(wh.vacuum(args.grace_hours * 3600))}
    elif args.command == "reconcile":
        wh = open_warehouse(spark, args.warehouse, width=args.width)
        tables = jobs.reconcile_hard_deletes(spark, _source(args), wh)
        report = {"command": "reconcile", "fact_rows": tables[jobs.FACT].count()}
    else:
        if not (args.landing and args.checkpoint):
            raise SystemExit("stream needs --landing and --checkpoint")
        wh = open_warehouse(spark, args.warehouse, width=args.width)
        query = run_incremental_stream(
            spark, args.landing, wh, args.checkpoint, available_now=not args.continuous, processing_time=args.continuous,
            table=args.table, authors=_source(args) if args.jdbc_url or args.files else None,
        )
        if args.continuous:
            query.awaitTermination()
        report = {"command": "stream", "fact_rows": wh.read(jobs.FACT).count()}
    print(json.dumps(report))
    return report


if __name__ == "__main__":
    main(sys.argv[1:])
