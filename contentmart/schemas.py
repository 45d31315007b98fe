"""Declared table schemas (source, staging, warehouse).

Explicit ``StructType`` everywhere; delimited files are bound to these by
position, never by type inference.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TS = TimestampNTZType()


def _schema(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in fields])


# Source (OLTP) tables.
SOURCE_AUTHORS = _schema(
    ("id", LongType(), False),
    ("name", StringType(), False),
    ("email", StringType(), False),
    ("created_at", TS, True),
    ("updated_at", TS, True),
)

SOURCE_ARTICLES = _schema(
    ("id", LongType(), False),
    ("title", StringType(), False),
    ("content", StringType(), True),
    ("published_at", TS, True),
    ("author_id", LongType(), False),
    ("created_at", TS, True),
    ("updated_at", TS, True),
    ("deleted_at", TS, True),
)

# Staging: same columns as the source, ids held as text.
STAGING_AUTHORS = _schema(
    ("id", StringType(), False),
    ("name", StringType(), False),
    ("email", StringType(), False),
    ("created_at", TS, True),
    ("updated_at", TS, True),
)

STAGING_ARTICLES = _schema(
    ("id", StringType(), False),
    ("title", StringType(), False),
    ("content", StringType(), True),
    ("published_at", TS, True),
    ("author_id", StringType(), False),
    ("created_at", TS, True),
    ("updated_at", TS, True),
    ("deleted_at", TS, True),
)

# Warehouse.
DIM_AUTHORS = _schema(
    ("author_id", LongType(), False),
    ("name", StringType(), False),
    ("email", StringType(), False),
    ("created_at", TS, True),
    ("updated_at", TS, True),
)

DIM_ARTICLES = _schema(
    ("article_id", LongType(), False),
    ("title", StringType(), False),
    ("content", StringType(), True),
    ("published_at", TS, True),
    ("created_at", TS, True),
    ("updated_at", TS, True),
    ("deleted_at", TS, True),
)

DIM_DATE = _schema(
    ("published_date_at", LongType(), True),
    ("date", DateType(), True),
    ("day", IntegerType(), True),
    ("month", IntegerType(), True),
    ("year", IntegerType(), True),
    ("quarter", IntegerType(), True),
)

FACT_REPORTS_ARTICLES = _schema(
    ("article_id", LongType(), True),
    ("author_id", LongType(), True),
    ("published_date_at", LongType(), True),
    ("article_count", LongType(), True),
    ("created_at", TS, True),
    ("updated_at", TS, True),
)

WAREHOUSE = {
    "dim_authors": DIM_AUTHORS,
    "dim_articles": DIM_ARTICLES,
    "dim_date": DIM_DATE,
    "fact_reports_articles": FACT_REPORTS_ARTICLES,
}

# Kept by the load jobs: the newest change applied per key of a feed (deleted keys included), and the
# counts of every run.
APPLIED_CHANGES = _schema(("id", LongType(), False), ("seq", LongType(), False), ("deleted", BooleanType(), False))
APPLIED = {"applied_authors": APPLIED_CHANGES, "applied_articles": APPLIED_CHANGES}
LOAD_AUDIT = _schema(
    ("run_id", StringType(), False),
    ("job", StringType(), False),
    ("stage", StringType(), False),
    ("rows", LongType(), False),
    ("recorded_at", TS, False),
)
BOOKS = {**APPLIED, "load_audit": LOAD_AUDIT}

STAGING = {"authors": STAGING_AUTHORS, "articles": STAGING_ARTICLES}
SOURCE = {"authors": SOURCE_AUTHORS, "articles": SOURCE_ARTICLES}

# Fixed values from the table DDL.
VARCHAR_LIMITS = {
    "authors": {"name": 255, "email": 255},
    "articles": {"title": 255},
    "dim_authors": {"name": 255, "email": 255},
    "dim_articles": {"title": 255},
}
ARTICLE_COUNT_DEFAULT = 1
# Column defaults as SQL, for tables of Spark's catalog.
COLUMN_DEFAULTS = {
    "fact_reports_articles": {"article_count": str(ARTICLE_COUNT_DEFAULT), "created_at": "localtimestamp()", "updated_at": "localtimestamp()"},
    "dim_authors": {"created_at": "localtimestamp()", "updated_at": "localtimestamp()"},
    "dim_articles": {"created_at": "localtimestamp()", "updated_at": "localtimestamp()", "deleted_at": "NULL"},
}
# What the warehouse tables declare of staged rows: columns that are NOT NULL, and text lengths.
DECLARED = {
    "authors": (("id", "name", "email"), VARCHAR_LIMITS["authors"]),
    "articles": (("id", "title", "author_id"), VARCHAR_LIMITS["articles"]),
}
# Columns that are unique in a table: keys, and what is declared so.
UNIQUE = {"authors": ("id", "email"), "articles": ("id",)}


def column_names(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields]
