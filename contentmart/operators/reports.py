"""Roll-ups of the article fact over the calendar dimension.

The fact joins the calendar on the shared date key.  The calendar's size is
known from its day count (a bound, not an estimate), so it is broadcast when
that bound fits and the fact is never shuffled for the join; the roll-up keys
are low-cardinality, so partial aggregation leaves a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentmart.operators.sizing import broadcast_limit, key_table_bytes, maybe_broadcast

LEVELS = ("year", "quarter", "month")


def rollup_by_calendar(
    fact: DataFrame,
    dim_date: DataFrame,
    levels: tuple[str, ...] = LEVELS,
    calendar_days: int | None = None,
    broadcast_bytes: int | None = None,
    fact_year: str | None = None,
) -> DataFrame:
    """(levels..., articles, article_count): fact rows and summed counts per period.

    ``fact_year``: the column that a stored fact is partitioned by.  It joins the calendar's year, so that
    the years the calendar holds are all that is read, wherever they lie (dynamic partition pruning).
    """
    # The calendar's span reaches the fact's scan as a plain filter and prunes files by their statistics.
    low, high = dim_date.agg(F.min("published_date_at"), F.max("published_date_at")).first()
    if low is not None:
        fact = fact.filter(F.col("published_date_at").between(low, high))
    days = calendar_days if calendar_days is not None else dim_date.count()
    limit = broadcast_limit(fact.sparkSession, broadcast_bytes)
    columns, on = list(dict.fromkeys(levels)), ["published_date_at"]
    if fact_year is not None:
        fact = fact.withColumnRenamed(fact_year, "year")
        columns, on = list(dict.fromkeys([*levels, "year"])), [*on, "year"]
    cal = maybe_broadcast(dim_date.select("published_date_at", *columns), key_table_bytes(days, 1, len(columns)), limit)
    return (
        fact.join(cal, on)
        .groupBy(*levels)
        .agg(F.count(F.lit(1)).alias("articles"), F.sum("article_count").cast("bigint").alias("article_count"))
    )
