"""Composite load jobs: full load, incremental load, warehouse init, backfill."""
