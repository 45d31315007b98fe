"""The warehouse as tables of Spark's catalog: lengths, defaults, reloads, years."""

import datetime as dt
import glob
import os

import pytest
from conftest import SF_SMALL
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from contentmart import registry
from contentmart.operators.calendar import dim_date
from contentmart.operators.reports import rollup_by_calendar
from contentmart.session import scratch_path
from contentmart.sources import catalog

OLD = dt.datetime(2001, 1, 1)


def made(spark, table):
    path = scratch_path(spark, "catalog-test")
    return catalog.create_table(spark, f"ct_{table}_{os.path.basename(path)}", table, path), path


def view(df):
    return registry._view_of(df)


def authors(spark, name):
    return spark.createDataFrame([(1, name, "a@example.org")], "author_id long, name string, email string")


def test_a_text_longer_than_declared_is_refused(spark):
    table, path = made(spark, "dim_authors")
    given = ["author_id", "name", "email"]
    catalog.reload_table(spark, table, "dim_authors", view(authors(spark, "x" * 255)), given)
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)length"):
        catalog.reload_table(spark, table, "dim_authors", view(authors(spark, "y" * 256)), given)
    assert [r["name"] for r in spark.table(table).collect()] == ["x" * 255]
    assert len(os.listdir(path)) == 1 and not [t for t in spark.catalog.listTables() if t.name.startswith(f"{table}_")]


def test_columns_left_out_get_their_default_and_given_nulls_stay(spark):
    table, _ = made(spark, "dim_authors")
    begun = spark.sql("SELECT localtimestamp() AS now").first()["now"]
    catalog.reload_table(spark, table, "dim_authors", view(authors(spark, "A")), ["name", "author_id", "email"])
    row = spark.table(table).first()
    assert (row["author_id"], row["name"]) == (1, "A") and row["created_at"] >= begun and row["updated_at"] >= begun
    fact, _ = made(spark, catalog.FACT)
    rows = spark.createDataFrame([(1, 7, 20010203, None), (2, 7, None, OLD)], "article_id long, author_id long, published_date_at long, created_at timestamp_ntz")
    catalog.reload_table(spark, fact, catalog.FACT, view(rows), rows.columns)
    found = {r["article_id"]: r for r in spark.table(fact).collect()}
    assert [found[i]["article_count"] for i in (1, 2)] == [1, 1]
    assert found[1]["created_at"] is None and found[2]["created_at"] == OLD and found[1]["updated_at"] >= begun
    assert found[1][catalog.FACT_YEAR] == 2001 and found[2][catalog.FACT_YEAR] is None


def test_a_reload_replaces_all_or_just_its_years(spark):
    fact, _ = made(spark, catalog.FACT)
    rows = lambda *keys: view(spark.createDataFrame([(k, k) for k in keys], "article_id long, published_date_at long"))
    given = ["article_id", "published_date_at"]
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", None)
    ids = lambda: sorted(r["article_id"] for r in spark.table(fact).collect())
    catalog.reload_table(spark, fact, catalog.FACT, rows(19990101, 20000101, 20000202), given)
    catalog.reload_table(spark, fact, catalog.FACT, rows(20000303, 20010101), given, years_only=True)
    assert ids() == [19990101, 20000303, 20010101]
    catalog.reload_table(spark, fact, catalog.FACT, rows(), given, years_only=True)
    assert len(ids()) == 3
    catalog.reload_table(spark, fact, catalog.FACT, rows(20020101), given)
    assert ids() == [20020101]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", None) == before
    with pytest.raises(ValueError, match="not partitioned"):
        catalog.reload_table(spark, fact, "dim_authors", rows(), given, years_only=True)
    with pytest.raises(ValueError, match="year"):
        catalog.reload_table(spark, fact, catalog.FACT, rows(), ["article_id"])


def test_a_report_reads_the_years_of_its_calendar_alone(spark):
    fact, path = made(spark, catalog.FACT)
    dates, _ = made(spark, "dim_date")
    catalog.reload_table(spark, fact, catalog.FACT, view(registry._fact(spark, SF_SMALL)))
    catalog.reload_table(spark, dates, "dim_date", view(dim_date(spark, dt.date(1990, 1, 1), dt.date(2005, 12, 31))))
    spring = spark.table(dates).filter(registry.SPRING)
    want = sorted(rollup_by_calendar(registry._fact(spark, SF_SMALL), spring).collect())
    # Files of years that the calendar leaves out, between its own years too, can't be read from now on.
    for file in glob.glob(f"{path}/*/{catalog.FACT_YEAR}=*/*.parquet"):
        if not any(f"={year}/" in file for year in (1996, 2000)):
            with open(file, "wb") as out:
                out.write(b"no parquet file")
    spark.catalog.refreshTable(fact)
    got = rollup_by_calendar(spark.table(fact), spring, fact_year=catalog.FACT_YEAR)
    assert sorted(got.collect()) == want and len(want) == 6
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
