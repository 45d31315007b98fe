"""Type-1 dimensions: projections for reloads and the MERGE specs for upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentmart import schemas
from contentmart.operators import merge as M

AUTHOR_COLUMNS = schemas.column_names(schemas.DIM_AUTHORS)
ARTICLE_COLUMNS = schemas.column_names(schemas.DIM_ARTICLES)
AUTHOR_COPIED = AUTHOR_COLUMNS[1:]  # all but the key
ARTICLE_COPIED = ARTICLE_COLUMNS[1:]


def dim_authors(authors: DataFrame) -> DataFrame:
    """id -> author_id (BIGINT), name, email, created_at, updated_at."""
    return authors.select(
        F.col("id").cast("bigint").alias("author_id"),
        "name",
        "email",
        "created_at",
        "updated_at",
    )


def dim_articles(articles: DataFrame) -> DataFrame:
    """id -> article_id; author_id dropped; drafts and soft-deletes kept."""
    return articles.select(
        F.col("id").cast("bigint").alias("article_id"),
        "title",
        "content",
        "published_at",
        "created_at",
        "updated_at",
        "deleted_at",
    )


def _upsert_spec(target_key: str, copied: list[str]) -> M.MergeSpec:
    return M.MergeSpec(
        target_key=target_key,
        source_key="id",
        when_matched=(M.update({c: M.src(c) for c in copied}),),
        when_not_matched=(M.insert({target_key: M.src("id"), **{c: M.src(c) for c in copied}}),),
    )


def authors_upsert_spec() -> M.MergeSpec:
    """Matched: overwrite name, email, created_at, updated_at; else insert."""
    return _upsert_spec("author_id", AUTHOR_COPIED)


def articles_upsert_spec() -> M.MergeSpec:
    """Matched: overwrite title, content, published_at, created_at, updated_at, deleted_at."""
    return _upsert_spec("article_id", ARTICLE_COPIED)


def merge_dim_authors(dim: DataFrame, staged: DataFrame, strategy: str = "auto", broadcast_bytes: int | None = None) -> DataFrame:
    return M.merge(dim, staged, authors_upsert_spec(), strategy, broadcast_bytes)


def merge_dim_articles(dim: DataFrame, staged: DataFrame, strategy: str = "auto", broadcast_bytes: int | None = None) -> DataFrame:
    return M.merge(dim, staged, articles_upsert_spec(), strategy, broadcast_bytes)
