"""Every checked query: its Spark form and its DuckDB oracle form, side by side.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over the whole driver
tables (through the stand-in views of ``fixtures``); ``ORACLE[name]`` is the
same result as DuckDB SQL over the same parquet files.  Column names match
exactly.  A query with no ``ORACLE`` entry is checked on rows only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart import fixtures as fx
from contentmart import schemas
from contentmart.fixtures import with_views
from contentmart.functions.dates import date_key, ntz_literal, yyyymmdd_text
from contentmart.functions.predicates import is_live, is_removable
from contentmart.operators import audit, digests, dims, facts, keys, merge, quality, reconcile, reports
from contentmart.operators.calendar import calendar, covering_bounds, dim_date
from contentmart.operators.casts import typed_ids
from contentmart.oracle_sql import date_key_sql, merge_sql
from contentmart.plans import jobs
from contentmart.session import scratch_path
from contentmart.sources import catalog, delimited, extract, fs, staging
from contentmart.sources.publish import BucketedTable, SnapshotTable, Warehouse
from contentmart.sources.ranged import RangedWarehouse
from contentmart.streaming.changes import run_change_stream, write_changes
from contentmart.streaming.incremental import run_incremental_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the checks.
DELTA_SINCE = "1998-01-01 00:00:00"
NEVER = "2100-01-01 00:00:00"
STAMP = "2001-12-31 00:00:00"
SEED_AUTHORS = [(1_000_000 + i, f"Literal {i}", f"literal{i}@example.org", f"2001-0{i}-0{i} 00:00:0{i}") for i in range(1, 4)]


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def _v(spark, sf, name):
    return fx.view(spark, sf, name)


def _dim_authors(spark, sf):
    return dims.dim_authors(_v(spark, sf, "authors"))


def _fact(spark, sf, view="articles"):
    return facts.fact_full_load(_v(spark, sf, view), _dim_authors(spark, sf))


def _delta_source(spark, sf, view="delta"):
    return facts.fact_delta_source(_v(spark, sf, view), _dim_authors(spark, sf))


# ---------------------------------------------------------------- SQL pieces
ARTICLE_COLS = "id, title, content, published_at, author_id, created_at, updated_at, deleted_at"
STAGED_ARTICLES_SQL = (
    "select cast(id as varchar) as id, title, content, published_at, cast(author_id as varchar) as author_id, "
    "created_at, updated_at, deleted_at from {v}"
)
DIM_AUTHORS_SQL = "select id as author_id, name, email, created_at, updated_at from authors"
DIM_ARTICLES_SQL = "select id as article_id, title, content, published_at, created_at, updated_at, deleted_at from {v}"
LIVE_SQL = "published_at is not null and deleted_at is null"


def fact_sql(v: str = "articles") -> str:
    """The rule, by windows: live articles of a known author, counted per article, author and moment."""
    return f"""select distinct id as article_id, author_id, {date_key_sql('published_at')} as published_date_at,
       count(*) over g as article_count, max(created_at) over g as created_at, max(updated_at) over g as updated_at
from {v}
where {LIVE_SQL} and author_id in (select id from authors)
window g as (partition by id, author_id, published_at)"""


def delta_source_sql(v: str = "delta") -> str:
    """The rule, by windows: every article with its author, if known, and the newest of each stamp."""
    return f"""select distinct id as article_id, known as author_id, max(published_at) over g as published_at,
       count(*) over g as article_count, max(deleted_at) over g as deleted_at, max(created_at) over g as created_at,
       max(updated_at) over g as updated_at
from (select *, case when author_id in (select id from authors) then author_id end as known from {v}) k
window g as (partition by id, known)"""


FACT_TYPES = [
    ("article_id", "bigint"),
    ("author_id", "bigint"),
    ("published_date_at", "bigint"),
    ("article_count", "bigint"),
    ("created_at", "timestamp"),
    ("updated_at", "timestamp"),
]
DIM_AUTHOR_TYPES = [("author_id", "bigint"), ("name", "varchar"), ("email", "varchar"), ("created_at", "timestamp"), ("updated_at", "timestamp")]
DIM_ARTICLE_TYPES = [
    ("article_id", "bigint"),
    ("title", "varchar"),
    ("content", "varchar"),
    ("published_at", "timestamp"),
    ("created_at", "timestamp"),
    ("updated_at", "timestamp"),
    ("deleted_at", "timestamp"),
]
S_LIVE = "s_published_at is not null and s_deleted_at is null"
S_REMOVABLE = "s_published_at is null or s_deleted_at is not null"


def fact_merge_sql(output: str = "rows", target: str | None = None, source: str | None = None) -> str:
    key = date_key_sql("s_published_at")
    body = merge_sql(
        target or fact_sql("articles"),
        source or delta_source_sql("delta"),
        "article_id",
        "article_id",
        FACT_TYPES,
        ["article_id", "author_id", "published_at", "article_count", "deleted_at", "created_at", "updated_at"],
        matched=[
            ("delete", S_REMOVABLE, {}),
            ("update", S_LIVE, {"author_id": "s_author_id", "published_date_at": key, "article_count": "s_article_count", "updated_at": "s_updated_at"}),
        ],
        not_matched=[
            ("insert", S_LIVE, {
                "article_id": "s_article_id", "author_id": "s_author_id", "published_date_at": key,
                "article_count": "s_article_count", "created_at": "s_created_at", "updated_at": "s_updated_at",
            }),
        ],
        output=output,
    )
    return with_views(body, "authors", "articles", "delta")


def upsert_sql(target: str, source: str, tkey: str, types, copied: list[str], source_cols: list[str], stamp: str | None = None) -> str:
    update = {c: f"s_{c}" for c in copied}
    if stamp is not None:
        update["updated_at"] = f"timestamp '{stamp}'"
    return merge_sql(
        target, source, tkey, "id", types, source_cols,
        matched=[("update", None, update)],
        not_matched=[("insert", None, {tkey: "s_id", **{c: f"s_{c}" for c in copied}})],
    )


AUTHOR_COPIED = ["name", "email", "created_at", "updated_at"]
ARTICLE_COPIED = ["title", "content", "published_at", "created_at", "updated_at", "deleted_at"]


# ================================================================ 2.1 sources
@register("extract_full", with_views("select * from articles", "articles"))
def q_extract_full(spark, sf):
    return extract.extract_full(spark, {"articles": _v(spark, sf, "articles")}, "articles")


@register("extract_delta", with_views(f"select * from articles where updated_at >= timestamp '{DELTA_SINCE}'", "articles"))
def q_extract_delta(spark, sf):
    return extract.extract_delta(_v(spark, sf, "articles"), "updated_at", DELTA_SINCE)


@register("extract_delta_whole", with_views("select * from authors", "authors"))
def q_extract_delta_whole(spark, sf):
    return extract.extract_delta(_v(spark, sf, "authors"), None, DELTA_SINCE)


@register(
    "delta_fallback_1day",
    with_views(
        """select a.*, strftime(m.hi - interval 1 day, '%Y-%m-%d %H:%M:%S') as threshold
from articles a, (select max(updated_at) as hi from articles) m
where a.updated_at >= m.hi - interval 1 day""",
        "articles",
    ),
)
def q_delta_fallback_1day(spark, sf):
    a = _v(spark, sf, "articles")
    since = extract.since_one_day_before_latest(a, "updated_at")
    return extract.extract_delta(a, "updated_at", since).withColumn("threshold", F.lit(since))


@register("delimited_roundtrip", with_views(STAGED_ARTICLES_SQL.format(v="articles"), "articles"))
def q_delimited_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip")
    delimited.write_delimited(staging.as_staged_text(_v(spark, sf, "articles"), "articles"), path)
    return delimited.read_delimited(spark, path, schemas.STAGING_ARTICLES)


@register("delimited_roundtrip_text", with_views("select id, nullif(text, '') as text, padded from text_rows", "text_rows"))
def q_delimited_roundtrip_text(spark, sf):
    path = scratch_path(spark, "roundtrip")
    rows = _v(spark, sf, "text_rows")
    delimited.write_delimited(rows, path)
    return delimited.read_delimited(spark, path, rows.schema)


@register("delimited_roundtrip_lines", with_views("select id, nullif(text, '') as text, padded from text_rows", "text_rows"))
def q_delimited_roundtrip_lines(spark, sf):
    """The hand-off form: line breaks escaped, so that files can be split between tasks."""
    path = scratch_path(spark, "roundtrip")
    rows = _v(spark, sf, "text_rows")
    delimited.write_delimited(rows, path, escape_lines=True)
    return delimited.read_delimited(spark, path, rows.schema, escape_lines=True)


@register(
    "landing_replaced_and_purged",
    with_views(STAGED_ARTICLES_SQL.format(v="delta").replace(" from ", ", false as landing_left from "), "delta"),
)
def q_landing_replaced_and_purged(spark, sf):
    """A second hand-off replaces the first; once loaded, nothing is left of the landing."""
    area = staging.StagingArea(spark)
    area.land("articles", _v(spark, sf, "articles"))
    staged = area.replace("articles", _v(spark, sf, "delta"))
    return staged.withColumn("landing_left", F.lit(fs.exists(spark, area.landing("articles"))))


@register("staging_replace", with_views(STAGED_ARTICLES_SQL.format(v="delta"), "delta"))
def q_staging_replace(spark, sf):
    area = staging.StagingArea(spark)
    area.replace("articles", _v(spark, sf, "articles"))
    return area.replace("articles", _v(spark, sf, "delta"))


@register("merge_empty_delta", with_views(DIM_ARTICLES_SQL.format(v="articles"), "articles"))
def q_merge_empty_delta(spark, sf):
    empty = extract.extract_delta(_v(spark, sf, "delta"), "updated_at", NEVER)
    return dims.merge_dim_articles(dims.dim_articles(_v(spark, sf, "articles")), empty)


@register("reload_dim_authors", with_views(DIM_AUTHORS_SQL, "authors"))
def q_reload_dim_authors(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.publish("dim_authors", dims.dim_authors(_v(spark, sf, "authors_delta")))
    wh.publish("dim_authors", dims.dim_authors(_v(spark, sf, "authors")))
    return wh.read("dim_authors")


@register("reload_dim_articles", with_views(DIM_ARTICLES_SQL.format(v="articles"), "articles"))
def q_reload_dim_articles(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.publish("dim_articles", dims.dim_articles(_v(spark, sf, "delta")))
    wh.publish("dim_articles", dims.dim_articles(_v(spark, sf, "articles")))
    return wh.read("dim_articles")


_SEED_VALUES = ", ".join(
    f"({i}, '{n}', '{e}', timestamp '{t}', timestamp '{t}')" for i, n, e, t in SEED_AUTHORS
)


@register(
    "values_rows",
    with_views(
        f"select * from authors union all select * from (values {_SEED_VALUES}) v(id, name, email, created_at, updated_at)",
        "authors",
    ),
)
def q_values_rows(spark, sf):
    import datetime as dt

    rows = [(i, n, e, dt.datetime.fromisoformat(t), dt.datetime.fromisoformat(t)) for i, n, e, t in SEED_AUTHORS]
    literal = extract.values_rows(spark, rows, schemas.SOURCE_AUTHORS)
    return _v(spark, sf, "authors").unionByName(literal)


@register("audit_counts")
def q_audit_counts(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    src = {"authors": _v(spark, sf, "authors"), "articles": _v(spark, sf, "articles")}
    result = jobs.full_load(spark, src, warehouse=wh)
    return result.audit.frame(spark)


ORACLE["audit_counts"] = with_views(
    f"""select 'dim_articles' as stage, count(*) as rows from articles
union all select 'dim_authors', count(*) from authors
union all select 'fact_reports_articles', count(*) from ({fact_sql('articles')}) f
union all select 'staging_articles', count(*) from articles
union all select 'staging_authors', count(*) from authors""",
    "authors",
    "articles",
)


@register(
    "audit_counts_incremental",
    with_views(
        """select 'staging_articles' as stage, count(*) as rows from delta where updated_at >= timestamp '1996-01-01 00:00:00'
union all select 'staging_authors', count(*) from authors""",
        "authors",
        "delta",
    ),
)
def q_audit_counts_incremental(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    later = {"authors": authors, "articles": _v(spark, sf, "delta")}
    return jobs.incremental_load(spark, later, wh, since="1996-01-01 00:00:00").audit.frame(spark)


# ======================================================= 2.2 projections, filters
@register("delta_parameterised", with_views(f"select * from articles where updated_at >= timestamp '{DELTA_SINCE}'", "articles"))
def q_delta_parameterised(spark, sf):
    _v(spark, sf, "articles").createOrReplaceTempView("cm_articles")
    return extract.parameterised_delta(spark, "cm_articles", "updated_at", DELTA_SINCE)


@register("staging_cast", with_views(f"select {ARTICLE_COLS} from articles", "articles"))
def q_staging_cast(spark, sf):
    staged = staging.as_staged_text(_v(spark, sf, "articles"), "articles")
    return typed_ids(staged, ("id", "author_id"))


@register("live_articles", with_views(f"select * from articles where {LIVE_SQL}", "articles"))
def q_live_articles(spark, sf):
    return _v(spark, sf, "articles").filter(is_live())


@register("removable_articles", with_views("select * from articles where published_at is null or deleted_at is not null", "articles"))
def q_removable_articles(spark, sf):
    return _v(spark, sf, "articles").filter(is_removable())


@register(
    "date_key",
    with_views(
        f"select id, strftime(published_at, '%Y%m%d') as published_text, {date_key_sql('published_at')} as published_date_at "
        "from articles where published_at is not null",
        "articles",
    ),
)
def q_date_key(spark, sf):
    a = _v(spark, sf, "articles").filter(F.col("published_at").isNotNull())
    return a.select("id", yyyymmdd_text("published_at").alias("published_text"), date_key("published_at").alias("published_date_at"))


# ================================================================ 2.3/2.4 joins, aggregates
@register("fact_full_load", with_views(fact_sql("articles"), "authors", "articles"))
def q_fact_full_load(spark, sf):
    return _fact(spark, sf, "articles")


@register("fact_full_load_dup", with_views(fact_sql("articles_dup"), "authors", "articles_dup"))
def q_fact_full_load_dup(spark, sf):
    return _fact(spark, sf, "articles_dup")


@register("fact_delta_source", with_views(delta_source_sql("delta"), "authors", "delta"))
def q_fact_delta_source(spark, sf):
    return _delta_source(spark, sf, "delta")


@register("fact_delta_source_dup", with_views(delta_source_sql("articles_dup"), "authors", "articles_dup"))
def q_fact_delta_source_dup(spark, sf):
    return _delta_source(spark, sf, "articles_dup")


@register(
    "identity_high_water",
    with_views(
        """select 'articles' as table_name, coalesce(max(id), 1) as high_water from articles
union all select 'authors', coalesce(max(id), 1) from authors""",
        "authors",
        "articles",
    ),
)
def q_identity_high_water(spark, sf):
    a = keys.high_water_frame(_v(spark, sf, "articles")).select(F.lit("articles").alias("table_name"), "high_water")
    b = keys.high_water_frame(_v(spark, sf, "authors")).select(F.lit("authors").alias("table_name"), "high_water")
    return a.unionByName(b)


def _dim_date_bounds_sql() -> str:
    return "(select cast(min(published_at) as date) as lo, cast(max(published_at) as date) as hi from articles)"


def _dim_date_sql() -> str:
    return f"""select {date_key_sql('d')} as published_date_at, cast(d as date) as date,
       cast(day(d) as integer) as day, cast(month(d) as integer) as month,
       cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter
from {_dim_date_bounds_sql()} b, generate_series(b.lo, b.hi, interval 1 day) g(d)"""


def _data_dim_date(spark, sf):
    bounds = covering_bounds(_v(spark, sf, "articles"), "published_at")
    return dim_date(spark, bounds[0], bounds[1])


@register(
    "report_by_month",
    with_views(
        f"""select dd.year, dd.quarter, dd.month, count(*) as articles, cast(sum(f.article_count) as bigint) as article_count
from ({fact_sql('articles')}) f join ({_dim_date_sql()}) dd on f.published_date_at = dd.published_date_at
group by dd.year, dd.quarter, dd.month""",
        "authors",
        "articles",
    ),
)
def q_report_by_month(spark, sf):
    bounds = covering_bounds(_v(spark, sf, "articles"), "published_at")
    days = dim_date(spark, bounds[0], bounds[1])
    n_days = (bounds[1] - bounds[0]).days + 1
    return reports.rollup_by_calendar(_fact(spark, sf, "articles"), days, calendar_days=n_days)


def _catalog_table(spark, table: str) -> str:
    path = scratch_path(spark, "catalog")
    return catalog.create_table(spark, f"contentmart_{table}_{path.rsplit('/', 1)[1]}", table, path)


def _view_of(df: DataFrame) -> str:
    name = f"contentmart_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


SPRING = "month(date) between 4 and 6 and year(date) in (1996, 2000)"  # one quarter of two years


@register(
    "report_spring_quarters",
    with_views(
        f"""select dd.year, dd.quarter, dd.month, count(*) as articles, cast(sum(f.article_count) as bigint) as article_count
from ({fact_sql('articles')}) f join ({_dim_date_sql()}) dd on f.published_date_at = dd.published_date_at
where dd.month between 4 and 6 and dd.year in (1996, 2000)
group by dd.year, dd.quarter, dd.month""",
        "authors",
        "articles",
    ),
)
def q_report_spring_quarters(spark, sf):
    """Fact and calendar as catalog tables; the fact's other years are not read."""
    fact, dates = _catalog_table(spark, jobs.FACT), _catalog_table(spark, "dim_date")
    catalog.reload_table(spark, fact, jobs.FACT, _view_of(_fact(spark, sf)))
    catalog.reload_table(spark, dates, "dim_date", _view_of(_data_dim_date(spark, sf)))
    return reports.rollup_by_calendar(spark.table(fact), spark.table(dates).filter(SPRING), fact_year=catalog.FACT_YEAR)


@register(
    "catalog_defaulted_column",
    with_views(
        f"""select id as article_id, author_id, {date_key_sql('published_at')} as published_date_at,
       cast(1 as bigint) as article_count, created_at, cast(null as timestamp) as updated_at,
       cast(year(published_at) as integer) as published_year
from articles where {LIVE_SQL}""",
        "articles",
    ),
)
def q_catalog_defaulted_column(spark, sf):
    """The insert leaves article_count out: the table's default fills it in; a NULL that is given stays."""
    live = _v(spark, sf, "articles").filter(is_live())
    rows = live.select(
        F.col("id").alias("article_id"), "author_id", date_key("published_at").alias("published_date_at"),
        "created_at", F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    fact = _catalog_table(spark, jobs.FACT)
    catalog.reload_table(spark, fact, jobs.FACT, _view_of(rows), columns=rows.columns)
    return spark.table(fact)


@register(
    "catalog_reload_years",
    with_views(
        f"""select * from ({fact_sql('articles')}) f where published_date_at // 10000 % 2 = 1 and article_id % 3 = 0
union all select * from ({fact_sql('articles')}) g where published_date_at // 10000 % 2 = 0""",
        "authors",
        "articles",
    ),
)
def q_catalog_reload_years(spark, sf):
    """Odd years are replaced by fewer rows; the others stay as the first load left them."""
    rows, fact = _fact(spark, sf), _catalog_table(spark, jobs.FACT)
    catalog.reload_table(spark, fact, jobs.FACT, _view_of(rows))
    fewer = rows.filter("published_date_at div 10000 % 2 = 1 and article_id % 3 = 0")
    catalog.reload_table(spark, fact, jobs.FACT, _view_of(fewer), years_only=True)
    return spark.table(fact).drop(catalog.FACT_YEAR)


# ================================================================ 2.6 generators, set ops
@register(
    "calendar_days",
    with_views(
        """select cast(d as date) as date
from (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders) b,
     generate_series(b.lo, b.hi, interval 1 day) g(d)""",
    ),
)
def q_calendar_days(spark, sf):
    bounds = covering_bounds(fx.table(spark, sf, "orders"), "o_orderdate")
    return calendar(spark, bounds[0], bounds[1])


@register("dim_date", with_views(_dim_date_sql(), "articles"))
def q_dim_date(spark, sf):
    return _data_dim_date(spark, sf)


@register("union_all_delta", with_views("select * from articles union all select * from delta", "articles", "delta"))
def q_union_all_delta(spark, sf):
    return _v(spark, sf, "articles").unionByName(_v(spark, sf, "delta"))


# ================================================================ 2.7 merge
@register("merge_fact", fact_merge_sql())
def q_merge_fact(spark, sf):
    bound = facts.delta_source_bound(_v(spark, sf, "delta"))
    return facts.merge_fact(_fact(spark, sf), _delta_source(spark, sf), source_bound=bound)


@register("merge_fact_broadcast", fact_merge_sql())
def q_merge_fact_broadcast(spark, sf):
    return facts.merge_fact(_fact(spark, sf), _delta_source(spark, sf), strategy="broadcast")


@register("merge_fact_shuffle", fact_merge_sql())
def q_merge_fact_shuffle(spark, sf):
    """The general form with every join that broadcasts by itself switched off."""
    return facts.merge_fact(_fact(spark, sf), _delta_source(spark, sf), strategy="shuffle", broadcast_bytes=-1)


def _small_delta_sql() -> str:
    return "(select * from delta where id % 100 = 0)"


@register("merge_fact_small_delta", fact_merge_sql(source=delta_source_sql(_small_delta_sql())))
def q_merge_fact_small_delta(spark, sf):
    """A delta of one article in a hundred, the size an hourly run has."""
    small = _v(spark, sf, "delta").filter("id % 100 = 0")
    source = facts.fact_delta_source(small, _dim_authors(spark, sf))
    return facts.merge_fact(_fact(spark, sf), source, strategy="broadcast")


@register("merge_fact_small_delta_shuffle", fact_merge_sql(source=delta_source_sql(_small_delta_sql())))
def q_merge_fact_small_delta_shuffle(spark, sf):
    small = _v(spark, sf, "delta").filter("id % 100 = 0")
    source = facts.fact_delta_source(small, _dim_authors(spark, sf))
    return facts.merge_fact(_fact(spark, sf), source, strategy="shuffle")


@register("merge_fact_bucketed", fact_merge_sql())
def q_merge_fact_bucketed(spark, sf):
    """The fact stored in buckets of its key: the merge shuffles the delta only."""
    root = scratch_path(spark, "bucketed")
    fact = BucketedTable(spark, f"{root}/fact", schemas.FACT_REPORTS_ARTICLES, "article_id")
    fact.publish(_fact(spark, sf))
    source = staging.RunScratch(spark).keep(_delta_source(spark, sf), "delta")
    fact.merge(source, facts.fact_merge_spec())
    return fact.read()


@register("merge_actions", fact_merge_sql("actions"))
def q_merge_actions(spark, sf):
    bound = facts.delta_source_bound(_v(spark, sf, "delta"))
    return merge.merge_action_counts(_fact(spark, sf), _delta_source(spark, sf), facts.fact_merge_spec(), source_bound=bound)


@register(
    "merge_dim_authors",
    with_views(
        upsert_sql(DIM_AUTHORS_SQL, "select * from authors_delta", "author_id", DIM_AUTHOR_TYPES, AUTHOR_COPIED, ["id"] + AUTHOR_COPIED),
        "authors",
        "authors_delta",
    ),
)
def q_merge_dim_authors(spark, sf):
    return dims.merge_dim_authors(_dim_authors(spark, sf), _v(spark, sf, "authors_delta"))


@register(
    "merge_dim_articles",
    with_views(
        upsert_sql(DIM_ARTICLES_SQL.format(v="articles"), "select * from delta", "article_id", DIM_ARTICLE_TYPES, ARTICLE_COPIED, ["id"] + ARTICLE_COPIED),
        "articles",
        "delta",
    ),
)
def q_merge_dim_articles(spark, sf):
    return dims.merge_dim_articles(dims.dim_articles(_v(spark, sf, "articles")), _v(spark, sf, "delta"))


@register(
    "merge_conflicts",
    with_views(
        """select id, count(*) as source_rows from articles_dup
where id in (select id from articles)
group by id having count(*) > 1""",
        "articles_dup",
    ),
)
def q_merge_conflicts(spark, sf):
    target = dims.dim_articles(_v(spark, sf, "articles"))
    return merge.merge_conflicts(target, _v(spark, sf, "articles_dup"), dims.articles_upsert_spec())


# ================================================================ 2.9 keys and constraints
@register(
    "check_unique",
    with_views(
        "select id, count(*) as rows from (select id from authors union all select id from authors_delta) u group by id having count(*) > 1",
        "authors",
        "authors_delta",
    ),
)
def q_check_unique(spark, sf):
    both = _v(spark, sf, "authors").unionByName(_v(spark, sf, "authors_delta"))
    return quality.check_unique(both, "id")


@register(
    "check_not_null",
    f"select article_id, 'author_id' as \"column\" from ({fact_merge_sql()}) m where author_id is null",
)
def q_check_not_null(spark, sf):
    merged = facts.merge_fact(_fact(spark, sf), _delta_source(spark, sf))
    return quality.check_not_null(merged, ["author_id"], key="article_id")


@register(
    "check_foreign_key",
    with_views(
        "select * from articles a where a.author_id is not null and not exists (select 1 from authors p where p.id = a.author_id)",
        "authors",
        "articles",
    ),
)
def q_check_foreign_key(spark, sf):
    return quality.check_foreign_key(_v(spark, sf, "articles"), "author_id", _v(spark, sf, "authors"), "id")


@register(
    "check_foreign_key_keys",
    with_views(
        """select a.author_id, count(*) as rows from articles a
where a.author_id is not null and not exists (select 1 from authors p where p.id = a.author_id)
group by a.author_id""",
        "authors",
        "articles",
    ),
)
def q_check_foreign_key_keys(spark, sf):
    return quality.orphan_keys(_v(spark, sf, "articles"), "author_id", _v(spark, sf, "authors"), "id")


@register(
    "check_length",
    with_views(
        """select 'name' as "column", cast(max(length(name)) as integer) as max_length, 255 as "limit",
       count(*) filter (where length(name) > 255) as violations from authors_raw
union all
select 'email', cast(max(length(email)) as integer), 255, count(*) filter (where length(email) > 255) from authors_raw""",
        "authors_raw",
    ),
)
def q_check_length(spark, sf):
    return quality.length_report(_v(spark, sf, "authors_raw"), schemas.VARCHAR_LIMITS["authors"])


@register(
    "check_length_rows",
    with_views(
        """select id, 'name' as "column", cast(length(name) as integer) as length, 255 as "limit"
from authors_raw where length(name) > 255""",
        "authors_raw",
    ),
)
def q_check_length_rows(spark, sf):
    return quality.check_length(_v(spark, sf, "authors_raw"), schemas.VARCHAR_LIMITS["authors"], key="id")


@register(
    "load_quarantine",
    with_views(
        """select 'quarantine' as place, id as author_id,
       case when name is null then 'name is null' else 'name longer than 255' end as reason
from authors_raw where name is null or length(name) > 255
union all
select 'dim_authors', id, null from authors_raw where length(name) <= 255""",
        "authors_raw",
    ),
)
def q_load_quarantine(spark, sf):
    """A full load whose source breaks declared constraints: where each author ends up."""
    src = {"authors": _v(spark, sf, "authors_raw"), "articles": _v(spark, sf, "articles")}
    result = jobs.full_load(spark, src, warehouse=Warehouse(spark, scratch_path(spark, "wh")), on_violation="quarantine")
    out = result.quarantine["authors"].select(F.lit("quarantine").alias("place"), F.col("id").cast("long").alias("author_id"), "reason")
    kept = result.tables["dim_authors"].select(F.lit("dim_authors").alias("place"), "author_id", F.lit(None).cast("string").alias("reason"))
    return out.unionByName(kept)


@register(
    "audit_balance",
    with_views(
        """select 'authors' as source, count(*) as extracted, count(*) filter (where name is null or length(name) > 255) as quarantined,
       count(*) filter (where length(name) <= 255) as loaded, true as balanced from authors_raw
union all
select 'articles', count(*), count(*) - count(distinct id), count(distinct id), true from articles_dup""",
        "authors_raw",
        "articles_dup",
    ),
)
def q_audit_balance(spark, sf):
    """Extracted = quarantined + loaded, from what a load has left in the audit table."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    src = {"authors": _v(spark, sf, "authors_raw"), "articles": _v(spark, sf, "articles_dup")}
    jobs.full_load(spark, src, warehouse=wh, on_violation="quarantine")
    return audit.balance(wh.read("load_audit")).drop("run_id", "job")


_ARTICLE_ORDER = ", ".join(f"{c} desc nulls last" for c in ["updated_at", *ARTICLE_COLS.replace(", updated_at", "").split(", ")])


@register(
    "load_duplicate_ids",
    with_views(
        f"""select case when n = 1 then 'dim_articles' else 'quarantine' end as place, id as article_id, published_at,
       case when n > 1 then 'id is not unique' end as reason
from (select *, row_number() over (partition by id order by {_ARTICLE_ORDER}) as n from articles_dup)""",
        "articles_dup",
    ),
)
def q_load_duplicate_ids(spark, sf):
    """A full load of a source that repeats article ids: one row of each stays, the newest."""
    src = {"authors": _v(spark, sf, "authors"), "articles": _v(spark, sf, "articles_dup")}
    result = jobs.full_load(spark, src, warehouse=Warehouse(spark, scratch_path(spark, "wh")), on_violation="quarantine")
    bad = result.quarantine["articles"].select(F.lit("quarantine").alias("place"), F.col("id").cast("long").alias("article_id"), "published_at", "reason")
    kept = result.tables["dim_articles"].select(F.lit("dim_articles").alias("place"), "article_id", "published_at", F.lit(None).cast("string").alias("reason"))
    return bad.unionByName(kept)


@register(
    "load_duplicate_emails",
    with_views(
        """select id as author_id, case when n > 1 then 'email is not unique' when held then 'email is held by another row' end as reason
from (select b.*, row_number() over (partition by email order by updated_at desc, id desc) as n,
             email in (select email from authors where id not in (select id from authors_clash)) as held
      from authors_clash b)""",
        "authors",
        "authors_clash",
    ),
)
def q_load_duplicate_emails(spark, sf):
    """An incremental run whose authors repeat e-mails, of each other and of authors in the warehouse."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    articles = _v(spark, sf, "articles")
    jobs.full_load(spark, {"authors": _v(spark, sf, "authors"), "articles": articles}, warehouse=wh)
    later = {"authors": _v(spark, sf, "authors_clash"), "articles": _v(spark, sf, "delta")}
    result = jobs.incremental_load(spark, later, wh, since="1996-01-01 00:00:00", on_violation="quarantine")
    bad = result.quarantine["authors"].select(F.col("id").cast("long").alias("author_id"), "reason")
    batch = later["authors"].select(F.col("id").alias("author_id"), "email", "name")
    new = result.tables["dim_authors"].join(batch, ["author_id", "email", "name"], "left_semi")
    return bad.unionByName(new.select("author_id", F.lit(None).cast("string").alias("reason")))


@register(
    "apply_defaults",
    with_views(
        f"""select id as article_id, author_id, {date_key_sql('published_at')} as published_date_at,
       cast(1 as bigint) as article_count, created_at, updated_at
from delta where {LIVE_SQL}""",
        "delta",
    ),
)
def q_apply_defaults(spark, sf):
    from contentmart.sources.publish import insert_columns

    live = _v(spark, sf, "delta").filter(is_live())
    rows = live.select("id", "author_id", date_key("published_at"), "created_at", "updated_at")
    shaped = insert_columns(
        rows, ["article_id", "author_id", "published_date_at", "created_at", "updated_at"], schemas.FACT_REPORTS_ARTICLES
    )
    return quality.apply_defaults(shaped, {"article_count": schemas.ARTICLE_COUNT_DEFAULT}, schemas.FACT_REPORTS_ARTICLES)


@register(
    "assign_identity",
    with_views(
        """select row_number() over (order by d.email) + (select coalesce(max(id), 1) from authors) as id, d.name, d.email
from authors_delta d where not exists (select 1 from authors a where a.email = d.email)""",
        "authors",
        "authors_delta",
    ),
)
def q_assign_identity(spark, sf):
    authors = _v(spark, sf, "authors")
    fresh = _v(spark, sf, "authors_delta").join(authors.select("email"), "email", "left_anti").select("name", "email")
    numbered = keys.assign_identity(fresh, ["email"], start_after=keys.high_water(authors))
    return numbered.select("id", "name", "email")


@register(
    "stamp_updates",
    with_views(
        upsert_sql(DIM_AUTHORS_SQL, "select * from authors_delta", "author_id", DIM_AUTHOR_TYPES, AUTHOR_COPIED, ["id"] + AUTHOR_COPIED, stamp=STAMP),
        "authors",
        "authors_delta",
    ),
)
def q_stamp_updates(spark, sf):
    spec = keys.stamped(dims.authors_upsert_spec(), "updated_at", ntz_literal(STAMP))
    return merge.merge(_dim_authors(spark, sf), _v(spark, sf, "authors_delta"), spec)


@register(
    "stamp_updates_now",
    with_views(
        """select id as author_id, id in (select id from authors_delta) as stamped_now from authors
union all select id, false from authors_delta where id not in (select id from authors)""",
        "authors",
        "authors_delta",
    ),
)
def q_stamp_updates_now(spark, sf):
    """Which rows an upsert stamps with the present moment."""
    start = spark.sql("select localtimestamp() as t").first()["t"]
    merged = merge.merge(_dim_authors(spark, sf), _v(spark, sf, "authors_delta"), keys.stamped(dims.authors_upsert_spec()))
    return merged.select("author_id", (F.col("updated_at") >= F.lit(start).cast("timestamp_ntz")).alias("stamped_now"))


@register(
    "cascading_reset_reload",
    with_views("select row_number() over (order by email) as id, name, email from authors_delta", "authors_delta"),
)
def q_cascading_reset_reload(spark, sf):
    """Reset the author table and its dependent, then load again with ids from 1."""
    root = scratch_path(spark, "reset")
    parent = SnapshotTable(spark, f"{root}/authors", schemas.SOURCE_AUTHORS)
    child = SnapshotTable(spark, f"{root}/articles", schemas.SOURCE_ARTICLES)
    parent.publish(_v(spark, sf, "authors"))
    child.publish(_v(spark, sf, "articles"))
    start = keys.reset_tables(parent, child)
    if not child.read().isEmpty():
        raise RuntimeError("the dependent table was not reset")
    fresh = parent.read().unionByName(_v(spark, sf, "authors_delta")).drop("id")
    parent.publish(keys.assign_identity(fresh, ["email"], start_after=start))
    return parent.read().select("id", "name", "email")


# ================================================================ 2.10 jobs
@register(
    "init_warehouse_load",
    with_views(
        f"""select 'dim_date' as table_name, 5479 as rows_before, 5479 as rows_after
union all select 'dim_authors', 0, count(*) from authors
union all select 'dim_articles', 0, count(*) from articles
union all select 'fact_reports_articles', 0, count(*) from ({fact_sql('articles')}) f""",
        "authors",
        "articles",
    ),
)
def q_init_warehouse_load(spark, sf):
    """Rows of the four tables after init and after a full load."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))

    def counts(tables, column):
        each = [df.agg(F.count(F.lit(1)).alias(column)).select(F.lit(n).alias("table_name"), column) for n, df in tables.items()]
        return reduce(DataFrame.unionByName, each)

    before = counts(jobs.init_warehouse(spark, wh), "rows_before")
    jobs.full_load(spark, {"authors": _v(spark, sf, "authors"), "articles": _v(spark, sf, "articles")}, warehouse=wh)
    return before.join(counts({n: wh.read(n) for n in schemas.WAREHOUSE}, "rows_after"), "table_name")


@register("full_load_fact", with_views(fact_sql("articles"), "authors", "articles"))
def q_full_load_fact(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    src = {"authors": _v(spark, sf, "authors"), "articles": _v(spark, sf, "articles")}
    return jobs.full_load(spark, src, warehouse=wh, staging=True).tables[jobs.FACT]


@register("incremental_load_fact", fact_merge_sql())
def q_incremental_load_fact(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    later = {"authors": authors, "articles": _v(spark, sf, "delta")}
    return jobs.incremental_load(spark, later, wh, since="1996-01-01 00:00:00", staging=True).tables[jobs.FACT]


def _ranged_incremental(spark, sf):
    wh = RangedWarehouse(spark, scratch_path(spark, "rwh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    later = {"authors": authors, "articles": _v(spark, sf, "delta")}
    return jobs.incremental_load(spark, later, wh, since="1996-01-01 00:00:00", staging=True).tables


@register("incremental_load_ranged_fact", fact_merge_sql())
def q_incremental_load_ranged_fact(spark, sf):
    return _ranged_incremental(spark, sf)[jobs.FACT]


@register(
    "incremental_load_ranged_dim_articles",
    with_views(
        upsert_sql(DIM_ARTICLES_SQL.format(v="articles"), "select * from delta", "article_id", DIM_ARTICLE_TYPES, ARTICLE_COPIED, ["id"] + ARTICLE_COPIED),
        "articles",
        "delta",
    ),
)
def q_incremental_load_ranged_dim_articles(spark, sf):
    return _ranged_incremental(spark, sf)["dim_articles"]


@register(
    "incremental_load_dim_articles",
    with_views(
        upsert_sql(DIM_ARTICLES_SQL.format(v="articles"), "select * from delta", "article_id", DIM_ARTICLE_TYPES, ARTICLE_COPIED, ["id"] + ARTICLE_COPIED),
        "articles",
        "delta",
    ),
)
def q_incremental_load_dim_articles(spark, sf):
    authors = _v(spark, sf, "authors")
    first = jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")})
    later = {"authors": authors, "articles": _v(spark, sf, "delta")}
    return jobs.incremental_load(spark, later, first.tables, since="1996-01-01 00:00:00").tables["dim_articles"]


@register("full_refresh_idempotent", with_views(fact_sql("articles"), "authors", "articles"))
def q_full_refresh_idempotent(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "delta")}, warehouse=wh)
    return jobs.full_refresh(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh).tables[jobs.FACT]


@register("backfill_chunked", with_views(fact_sql("articles"), "authors", "articles"))
def q_backfill_chunked(spark, sf):
    sink = scratch_path(spark, "backfill")
    return jobs.backfill_fact(spark, _v(spark, sf, "articles"), _dim_authors(spark, sf), months=6, sink=sink)


@register("backfill_rerun", with_views(fact_sql("articles"), "authors", "articles"))
def q_backfill_rerun(spark, sf):
    """Other chunk lengths and late rows on a rerun into the same sink."""
    sink = scratch_path(spark, "backfill")
    articles, authors = _v(spark, sf, "articles"), _dim_authors(spark, sf)
    early = articles.filter("id % 25 != 0")
    jobs.backfill_fact(spark, early, authors, months=6, sink=sink)
    jobs.backfill_fact(spark, early, authors, months=12, sink=sink)
    return jobs.backfill_fact(spark, articles, authors, months=12, sink=sink)


# ================================================================ 2.13 reconciliation
@register(
    "hard_delete_removed",
    with_views(f"select * from ({DIM_ARTICLES_SQL.format(v='articles')}) t where article_id not in (select id from delta)", "articles", "delta"),
)
def q_hard_delete_removed(spark, sf):
    target = dims.dim_articles(_v(spark, sf, "articles"))
    return reconcile.hard_delete_removed(target, "article_id", _v(spark, sf, "delta"), "id")


@register(
    "hard_delete_kept",
    with_views(f"select * from ({DIM_ARTICLES_SQL.format(v='articles')}) t where article_id in (select id from delta)", "articles", "delta"),
)
def q_hard_delete_kept(spark, sf):
    target = dims.dim_articles(_v(spark, sf, "articles"))
    return reconcile.hard_delete_kept(target, "article_id", _v(spark, sf, "delta"), "id")


@register(
    "hard_delete_by_digest",
    with_views(f"select * from ({DIM_ARTICLES_SQL.format(v='articles')}) t where article_id % 997 = 0", "articles"),
)
def q_hard_delete_by_digest(spark, sf):
    """One key in 997 left the source: ranges that hold none of them are settled by one row each."""
    path = scratch_path(spark, "digest-target")
    dims.dim_articles(_v(spark, sf, "articles")).write.parquet(path)
    left = _v(spark, sf, "articles").filter("id % 997 != 0")
    return digests.removed_by_digest(spark.read.parquet(path), "article_id", left, leaf=256)


@register(
    "reconcile_by_digest_fact",
    with_views(f"select * from ({fact_sql('articles')}) f where article_id in (select id from delta)", "authors", "articles", "delta"),
)
def q_reconcile_by_digest_fact(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    now = {"authors": authors, "articles": _v(spark, sf, "delta")}
    return jobs.reconcile_hard_deletes(spark, now, wh, by_digest=True)[jobs.FACT]


@register(
    "reconcile_hard_deletes_fact",
    with_views(f"select * from ({fact_sql('articles')}) f where article_id in (select id from delta)", "authors", "articles", "delta"),
)
def q_reconcile_hard_deletes_fact(spark, sf):
    wh = RangedWarehouse(spark, scratch_path(spark, "rwh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    # The source now holds only the delta's articles: every other article was hard-deleted.
    now = {"authors": authors, "articles": _v(spark, sf, "delta")}
    return jobs.reconcile_hard_deletes(spark, now, wh)[jobs.FACT]


_LATEST_SQL = "(select * from changes_full qualify row_number() over (partition by id order by seq desc) = 1)"
_UPSERTS_SQL = f"(select {ARTICLE_COLS} from {_LATEST_SQL} l where op <> 'D')"


@register(
    "cdc_warehouse_fact",
    with_views(
        f"""select * from ({fact_merge_sql(source=delta_source_sql(_UPSERTS_SQL))}) m
where article_id not in (select id from {_LATEST_SQL} l where op = 'D')""",
        "authors",
        "articles",
        "changes_full",
    ),
)
def q_cdc_warehouse_fact(spark, sf):
    wh = RangedWarehouse(spark, scratch_path(spark, "rwh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    return jobs.apply_article_changes(spark, _v(spark, sf, "changes_full"), wh)[jobs.FACT]


@register(
    "cdc_new_authors_fact",
    with_views(
        f"""select * from ({fact_merge_sql(source=delta_source_sql(_UPSERTS_SQL), target="select * from (" + fact_sql() + ") f where author_id % 3 <> 0")}) m
where article_id not in (select id from {_LATEST_SQL} l where op = 'D')""",
        "authors",
        "articles",
        "changes_full",
    ),
)
def q_cdc_new_authors_fact(spark, sf):
    """Authors reach the warehouse by a change feed of their own, in the same run as the articles."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors.filter("id % 3 != 0"), "articles": _v(spark, sf, "articles")}, warehouse=wh)
    feed = authors.withColumn("seq", F.lit(1)).withColumn("op", F.lit("U"))
    return jobs.apply_article_changes(spark, _v(spark, sf, "changes_full"), wh, author_changes=feed)[jobs.FACT]


@register(
    "cdc_warehouse_dim_articles",
    with_views(
        f"""select * from ({upsert_sql(DIM_ARTICLES_SQL.format(v="articles"), _UPSERTS_SQL[1:-1], "article_id", DIM_ARTICLE_TYPES, ARTICLE_COPIED, ["id"] + ARTICLE_COPIED)}) m
where article_id not in (select id from {_LATEST_SQL} l where op = 'D')""",
        "articles",
        "changes_full",
    ),
)
def q_cdc_warehouse_dim_articles(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    return jobs.apply_article_changes(spark, _v(spark, sf, "changes_full"), wh)["dim_articles"]


@register(
    "cdc_apply",
    with_views(
        merge_sql(
            "select id, title, author_id from articles",
            "select id, title, author_id, seq, op from changes qualify row_number() over (partition by id order by seq desc) = 1",
            "id",
            "id",
            [("id", "bigint"), ("title", "varchar"), ("author_id", "bigint")],
            ["id", "title", "author_id", "seq", "op"],
            matched=[("delete", "s_op = 'D'", {}), ("update", None, {"title": "s_title", "author_id": "s_author_id"})],
            not_matched=[("insert", "not (s_op = 'D')", {"id": "s_id", "title": "s_title", "author_id": "s_author_id"})],
        ),
        "articles",
        "changes",
    ),
)
def q_cdc_apply(spark, sf):
    target = _v(spark, sf, "articles").select("id", "title", "author_id")
    return reconcile.cdc_apply(target, _v(spark, sf, "changes"), "id", "id", "seq", ["title", "author_id"])


def _late_feeds(spark, sf):
    """The feed's later changes first, then, in a run of its own, the older ones."""
    feed = _v(spark, sf, "changes_full")
    return feed.filter("seq = 2"), feed.filter("seq = 1")


def _late_changes(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    for feed in _late_feeds(spark, sf):
        jobs.apply_article_changes(spark, feed, wh)
    return wh


@register("cdc_late_changes", ORACLE["cdc_warehouse_dim_articles"])
def q_cdc_late_changes(spark, sf):
    """Two feeds out of order, some of the late changes behind a delete: as one ordered feed."""
    return _late_changes(spark, sf).read("dim_articles")


@register("cdc_late_changes_fact", ORACLE["cdc_warehouse_fact"])
def q_cdc_late_changes_fact(spark, sf):
    return _late_changes(spark, sf).read(jobs.FACT)


@register(
    "cdc_late_changes_state",
    with_views("select id, cast(seq as bigint) as seq, op = 'D' as deleted from (select * from changes_full qualify row_number() over (partition by id order by seq desc) = 1)", "changes_full"),
)
def q_cdc_late_changes_state(spark, sf):
    """The newest change per key that the warehouse keeps, deleted keys included."""
    return _late_changes(spark, sf).read("applied_articles")


@register(
    "cdc_late_authors",
    with_views(
        f"""select author_id, name, email, created_at, updated_at from ({DIM_AUTHORS_SQL}) a
where author_id not in (select id from authors_delta)
union all select id, concat(name, ' v3'), email, created_at, updated_at from authors_delta where id % 2 = 0""",
        "authors",
        "authors_delta",
    ),
)
def q_cdc_late_authors(spark, sf):
    """An author feed that renames some and deletes others, and after it the feed that came before."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    jobs.full_load(spark, {"authors": _v(spark, sf, "authors"), "articles": _v(spark, sf, "articles")}, warehouse=wh)
    delta = _v(spark, sf, "authors_delta")
    none = _v(spark, sf, "changes_full").filter("seq = 0")
    last = delta.withColumn("name", F.concat("name", F.lit(" v3"))).withColumn("seq", F.lit(9))
    last = last.withColumn("op", F.when(F.col("id") % 2 == 0, "U").otherwise("D"))
    for feed in (last, delta.withColumn("seq", F.lit(3)).withColumn("op", F.lit("U"))):
        jobs.apply_article_changes(spark, none, wh, author_changes=feed)
    return wh.read("dim_authors")


_AUDIT_CDC_SQL = """select stage, cast(sum(rows) as bigint) as rows from (
select 'changes_articles' as stage, count(*) as rows from changes_full
union all select 'applied_articles', count(distinct id) from changes_full
) s group by stage"""


@register("audit_counts_cdc", with_views(_AUDIT_CDC_SQL, "changes_full"))
def q_audit_counts_cdc(spark, sf):
    """What the runs of two change feeds have left in the audit table: changes read and changes applied."""
    counts = _late_changes(spark, sf).read("load_audit").filter("job = 'apply_article_changes'")
    return counts.groupBy("stage").agg(F.sum("rows").alias("rows")).filter("rows > 0")


# ================================================================ 2.11 streaming
@register("stream_cdc", ORACLE["cdc_warehouse_fact"])
def q_stream_cdc(spark, sf):
    """Change files in any order, in several batches of two runs of the stream: as one ordered feed."""
    root = scratch_path(spark, "streamcdc")
    wh = Warehouse(spark, f"{root}/warehouse")
    jobs.full_load(spark, {"authors": _v(spark, sf, "authors"), "articles": _v(spark, sf, "articles")}, warehouse=wh)
    landing = f"{root}/landing"
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for feed in _late_feeds(spark, sf):
        write_changes(feed.repartition(files, F.xxhash64("id")), landing)
        run_change_stream(spark, landing, wh, f"{root}/checkpoint", max_files_per_trigger=-(-files // 2))
    return wh.read(jobs.FACT)


@register(
    "audit_counts_stream",
    with_views("select 'staging_articles' as stage, count(*) as rows from delta", "delta"),
)
def q_audit_counts_stream(spark, sf):
    """Rows of all micro-batches, from the audit table."""
    root = scratch_path(spark, "stream")
    wh = Warehouse(spark, f"{root}/warehouse")
    jobs.full_load(spark, {"authors": _v(spark, sf, "authors"), "articles": _v(spark, sf, "articles")}, warehouse=wh)
    landing = f"{root}/landing"
    run_incremental_stream(spark, landing, wh, f"{root}/checkpoint", max_files_per_trigger=_land(spark, sf, landing), escape_lines=True)
    counts = wh.read("load_audit").filter("job = 'apply_delta'")
    return counts.groupBy("stage").agg(F.sum("rows").alias("rows"))


@register("stream_incremental", fact_merge_sql())
def q_stream_incremental(spark, sf):
    root = scratch_path(spark, "stream")
    wh = Warehouse(spark, f"{root}/warehouse")
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    landing = f"{root}/landing"
    run_incremental_stream(spark, landing, wh, f"{root}/checkpoint", max_files_per_trigger=_land(spark, sf, landing), escape_lines=True)
    return wh.read(jobs.FACT)


def _land(spark, sf, landing: str, view: str = "delta") -> int:
    """Land a view in as many files as the session shuffles into; the files of a quarter of it."""
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    staged = staging.as_staged_text(_v(spark, sf, view), "articles").repartition(files, "id")
    delimited.write_delimited(staged, landing, escape_lines=True)  # a batch has few files: they are split over tasks
    return -(-files // 4)


@register("stream_new_authors", fact_merge_sql(target="select * from (" + fact_sql() + ") f where author_id % 3 <> 0"))
def q_stream_new_authors(spark, sf):
    """Authors that the warehouse does not know arrive with the stream's own deltas."""
    root = scratch_path(spark, "stream")
    wh = Warehouse(spark, f"{root}/warehouse")
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors.filter("id % 3 != 0"), "articles": _v(spark, sf, "articles")}, warehouse=wh)
    landing = f"{root}/landing"
    per_batch = _land(spark, sf, landing)
    run_incremental_stream(
        spark, landing, wh, f"{root}/checkpoint", max_files_per_trigger=per_batch, authors={"authors": authors}, escape_lines=True
    )
    return wh.read(jobs.FACT)


@register("stream_incremental_ranged", fact_merge_sql())
def q_stream_incremental_ranged(spark, sf):
    root = scratch_path(spark, "stream")
    wh = RangedWarehouse(spark, f"{root}/warehouse")
    authors = _v(spark, sf, "authors")
    jobs.full_load(spark, {"authors": authors, "articles": _v(spark, sf, "articles")}, warehouse=wh)
    landing = f"{root}/landing"
    run_incremental_stream(spark, landing, wh, f"{root}/checkpoint", max_files_per_trigger=_land(spark, sf, landing), escape_lines=True)
    return wh.read(jobs.FACT)
