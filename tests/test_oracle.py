"""Driver contract: every registered query equals its DuckDB oracle (sf0.001)."""

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as E

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 45


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["article_id", "author_id", "published_date_at", "article_count", "created_at", "updated_at"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_SMALL, con)
    assert r["status"] in ("ok", "rows-only"), r
