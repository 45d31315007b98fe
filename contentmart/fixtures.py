"""Stand-in source tables derived from the driver's parquet tables.

The driver tables have no NULLs, so drafts, soft-deletes, orphans and repeated
ids are derived from key arithmetic over the *whole* tables (nothing is
sampled or capped).  Each view exists twice: a Spark DataFrame builder and the
same definition as DuckDB SQL for the oracle (``ORACLE_VIEWS``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart.functions.dates import ntz_literal

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    stamp = ntz_literal("1995-01-01 00:00:00")
    return c.filter(F.col("c_custkey") % 50 != 0).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def authors_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    new_id = F.col("c_custkey") + 750
    return c.filter(F.col("c_custkey") % 3 == 0).select(
        new_id.alias("id"),
        F.concat(F.col("c_name"), F.lit(" v2")).alias("name"),
        F.concat(F.lit("c"), new_id.cast("string"), F.lit("@example.com")).alias("email"),
        ntz_literal("1995-01-01 00:00:00").alias("created_at"),
        ntz_literal("1996-01-01 00:00:00").alias("updated_at"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, status, day = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    return o.select(
        k.alias("id"),
        F.col("o_orderpriority").alias("title"),
        status.alias("content"),
        F.col("o_custkey").alias("author_id"),
        F.when((status == "P") & (k % 2 == 0), F.lit(None)).otherwise(day).alias("published_at"),
        day.alias("created_at"),
        day.alias("updated_at"),
        F.when((status == "F") & (k % 5 == 0), day).alias("deleted_at"),
    )


def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    return o.filter(day >= ntz_literal("1996-01-01 00:00:00")).select(
        (k + 7000).alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("content"),
        F.col("o_custkey").alias("author_id"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(day).alias("published_at"),
        day.alias("created_at"),
        day.alias("updated_at"),
        F.when(k % 11 == 0, day).alias("deleted_at"),
    )


def articles_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir)
    shifted = a.filter(F.col("id") % 9 == 0).withColumn(
        "published_at", F.col("published_at") + F.expr("INTERVAL 1 DAY")
    )
    return a.unionByName(a.filter(F.col("id") % 3 == 0)).unionByName(shifted)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = delta(spark, sf_dir)
    first = d.select(
        "id",
        "title",
        "author_id",
        F.lit(1).alias("seq"),
        F.when(F.col("id") % 10 == 0, "D").otherwise("U").alias("op"),
    )
    second = d.filter(F.col("id") % 3 == 0).select(
        "id",
        F.concat(F.col("title"), F.lit(" v2")).alias("title"),
        "author_id",
        F.lit(2).alias("seq"),
        F.when(F.col("id") % 4 == 0, "D").otherwise("U").alias("op"),
    )
    return first.unionByName(second)


def changes_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``changes`` feed with full article images (for warehouse-level CDC)."""
    d = delta(spark, sf_dir)
    first = d.withColumn("seq", F.lit(1)).withColumn("op", F.when(F.col("id") % 10 == 0, "D").otherwise("U"))
    second = (
        d.filter(F.col("id") % 3 == 0)
        .withColumn("title", F.concat(F.col("title"), F.lit(" v2")))
        .withColumn("seq", F.lit(2))
        .withColumn("op", F.when(F.col("id") % 4 == 0, "D").otherwise("U"))
    )
    return first.unionByName(second)


def authors_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as an author, some without a name and some with a name over its declared length."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    stamp = ntz_literal("1995-01-01 00:00:00")
    return c.select(
        k.alias("id"),
        F.when(k % 7 != 0, F.repeat("c_name", (k % 20 + 1).cast("int"))).alias("name"),
        F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com")).alias("email"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def authors_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New authors, some with the e-mail of a customer's author, some of those twice."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def rows(shift: int, day: str) -> DataFrame:
        return c.filter((k % 3 == 0) & (k % shift == 0)).select(
            (k * 10_000_000 + shift).alias("id"),
            F.concat("c_name", F.lit(f" {shift}")).alias("name"),
            F.concat(F.when(k % 2 == 0, F.lit("c")).otherwise(F.lit("new")), k.cast("string"), F.lit("@example.com")).alias("email"),
            ntz_literal("1996-01-01 00:00:00").alias("created_at"),
            ntz_literal(day).alias("updated_at"),
        )

    return rows(1, "1996-01-01 00:00:00").unionByName(rows(7, "1996-02-01 00:00:00"))


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as it is, and between white space, quotes, backslashes and line breaks."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("id"),
        F.col("text"),
        F.concat(F.lit("  \\n\t"), F.col("text"), F.lit("\n|\"\\ \t ")).alias("padded"),
    )


BUILDERS = {
    "authors_raw": authors_raw,
    "authors_clash": authors_clash,
    "text_rows": text_rows,
    "authors": authors,
    "authors_delta": authors_delta,
    "articles": articles,
    "delta": delta,
    "articles_dup": articles_dup,
    "changes": changes,
    "changes_full": changes_full,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)


# The same views for DuckDB (oracle side).  Order matters: later ones use earlier ones.
ORACLE_VIEWS = {
    "authors_raw": """
select c_custkey as id, case when c_custkey % 7 <> 0 then repeat(c_name, c_custkey % 20 + 1) end as name,
       concat('c', cast(c_custkey as varchar), '@example.com') as email,
       timestamp '1995-01-01 00:00:00' as created_at, timestamp '1995-01-01 00:00:00' as updated_at
from customer""",
    "authors_clash": """
select c_custkey * 10000000 + s as id, concat(c_name, ' ', s) as name,
       concat(case when c_custkey % 2 = 0 then 'c' else 'new' end, c_custkey, '@example.com') as email,
       timestamp '1996-01-01 00:00:00' as created_at,
       case s when 1 then timestamp '1996-01-01 00:00:00' else timestamp '1996-02-01 00:00:00' end as updated_at
from customer, (values (1), (7)) v(s) where c_custkey % 3 = 0 and c_custkey % s = 0""",
    "text_rows": """
select doc_id as id, text,
       concat('  ', chr(92), 'n', chr(9), text, chr(10), '|"', chr(92), ' ', chr(9), ' ') as padded
from documents""",
    "authors": """
select c_custkey as id, c_name as name,
       concat('c', cast(c_custkey as varchar), '@example.com') as email,
       timestamp '1995-01-01 00:00:00' as created_at, timestamp '1995-01-01 00:00:00' as updated_at
from customer where c_custkey % 50 <> 0""",
    "authors_delta": """
select c_custkey + 750 as id, concat(c_name, ' v2') as name,
       concat('c', cast(c_custkey + 750 as varchar), '@example.com') as email,
       timestamp '1995-01-01 00:00:00' as created_at, timestamp '1996-01-01 00:00:00' as updated_at
from customer where c_custkey % 3 = 0""",
    "articles": """
select o_orderkey as id, o_orderpriority as title, o_orderstatus as content, o_custkey as author_id,
       case when o_orderstatus = 'P' and o_orderkey % 2 = 0 then null else o_orderdate end as published_at,
       o_orderdate as created_at, o_orderdate as updated_at,
       case when o_orderstatus = 'F' and o_orderkey % 5 = 0 then o_orderdate else null end as deleted_at
from orders""",
    "delta": """
select o_orderkey + 7000 as id, o_orderpriority as title, o_orderstatus as content, o_custkey as author_id,
       case when o_orderkey % 7 = 0 then null else o_orderdate end as published_at,
       o_orderdate as created_at, o_orderdate as updated_at,
       case when o_orderkey % 11 = 0 then o_orderdate else null end as deleted_at
from orders where o_orderdate >= timestamp '1996-01-01 00:00:00'""",
    "articles_dup": """
select * from articles
union all select * from articles where id % 3 = 0
union all select id, title, content, author_id, published_at + interval '1' day as published_at,
                 created_at, updated_at, deleted_at
          from articles where id % 9 = 0""",
    "changes": """
select id, title, author_id, 1 as seq, case when id % 10 = 0 then 'D' else 'U' end as op from delta
union all
select id, concat(title, ' v2') as title, author_id, 2 as seq, case when id % 4 = 0 then 'D' else 'U' end as op
from delta where id % 3 = 0""",
    "changes_full": """
select *, 1 as seq, case when id % 10 = 0 then 'D' else 'U' end as op from delta
union all
select id, concat(title, ' v2') as title, content, author_id, published_at, created_at, updated_at, deleted_at,
       2 as seq, case when id % 4 = 0 then 'D' else 'U' end as op
from delta where id % 3 = 0""",
}

_DEPENDS = {"articles_dup": ["articles"], "changes": ["delta"], "changes_full": ["delta"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for the named views (and what they need)."""
    needed: list[str] = []

    def add(n: str) -> None:
        for dep in _DEPENDS.get(n, []):
            add(dep)
        if n not in needed:
            needed.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} as ({ORACLE_VIEWS[n].strip()})" for n in needed)
    body = sql.strip()
    if not needed:
        return body
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
