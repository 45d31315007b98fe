"""The command line drives init, full load and incremental load end to end."""

import seed

from contentmart.cli import main
from contentmart.plans import jobs
from contentmart.session import scratch_path
from contentmart.sources.ranged import RangedWarehouse


def test_cli_init_full_incremental(spark):
    root = scratch_path(spark, "cli")
    src = seed.source(spark)
    for name, df in src.items():
        df.write.parquet(f"{root}/source/{name}")
    wh = f"{root}/wh"
    assert main(["init", "--warehouse", wh, "--width", "8"])["dim_date"] == 5479
    full = main(["full-load", "--warehouse", wh, "--files", f"{root}/source", "--width", "8"])
    assert full["rows"][jobs.FACT] == 20 and full["rows"]["dim_articles"] == 30
    inc = main(["incremental", "--warehouse", wh, "--files", f"{root}/source", "--width", "8", "--since", "2026-05-19 00:00:00"])
    assert inc["skipped"] == []
    opened = RangedWarehouse(spark, wh, width=8)
    assert opened.read(jobs.FACT).count() == 20


def test_cli_vacuum(spark):
    root = scratch_path(spark, "clivac")
    src = seed.source(spark)
    for name, df in src.items():
        df.write.parquet(f"{root}/source/{name}")
    wh = f"{root}/wh"
    main(["init", "--warehouse", wh, "--layout", "snapshot"])
    for _ in range(3):
        main(["full-load", "--warehouse", wh, "--files", f"{root}/source"])
    assert main(["vacuum", "--warehouse", wh, "--grace-hours", "0"])["removed"] > 0
    assert main(["full-load", "--warehouse", wh, "--files", f"{root}/source"])["rows"][jobs.FACT] == 20


def test_register_views_for_sql_reports(spark):
    from contentmart.sources.publish import register_views

    root = scratch_path(spark, "views")
    wh = RangedWarehouse(spark, f"{root}/wh", width=8)
    jobs.init_warehouse(spark, wh)
    jobs.full_load(spark, seed.source(spark), warehouse=wh)
    assert set(register_views(wh, "dwh_")) == {"dwh_dim_authors", "dwh_dim_articles", "dwh_dim_date", "dwh_fact_reports_articles"}
    rows = spark.sql(
        """select d.year, d.month, sum(f.article_count) as n
           from dwh_fact_reports_articles f join dwh_dim_date d using (published_date_at)
           group by d.year, d.month"""
    ).collect()
    assert [(r.year, r.month, r.n) for r in rows] == [(2026, 5, 20)]


def test_cli_over_jdbc(spark):
    url = "jdbc:derby:memory:contentmart_cli;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    src = seed.source(spark)
    for name, df in src.items():
        df.write.jdbc(url, name.upper(), mode="overwrite", properties={"driver": driver})
    wh = scratch_path(spark, "clijdbc")
    common = ["--warehouse", wh, "--jdbc-url", url, "--jdbc-driver", driver, "--partitions", "3", "--width", "8"]
    assert main(["init", "--warehouse", wh, "--width", "8"])["layout"] == "RangedWarehouse"
    assert main(["full-load", *common, "--staging"])["rows"][jobs.FACT] == 20
    inc = main(["incremental", *common, "--since", "2026-05-20 09:00:00", "--staging"])
    assert inc["skipped"] == []
    assert RangedWarehouse(spark, wh, width=8).read(jobs.FACT).count() == 20
