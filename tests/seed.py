"""A seed-shaped fixture built by rule: 10 authors, 30 articles, 3 per author.

ids 1-20 live, 21/23/25/27/28 drafts, 22/24/26/29/30 soft-deleted; change
stamps laid out so deltas from 2026-05-18, 2026-05-19 and 2026-05-20 09:00
select 13, 10 and 5 rows (20 and 27 sit exactly on the last bound).
"""

import datetime as dt

from contentmart import schemas

DRAFTS = {21, 23, 25, 27, 28}
DELETED = {22, 24, 26, 29, 30}
LATE_UPDATES = {
    18: "2026-05-18 10:00:00",
    21: "2026-05-18 14:00:00",
    22: "2026-05-18 16:00:00",
    19: "2026-05-19 09:00:00",
    23: "2026-05-19 10:00:00",
    24: "2026-05-19 11:00:00",
    25: "2026-05-19 12:00:00",
    26: "2026-05-19 13:00:00",
    20: "2026-05-20 09:00:00",
    27: "2026-05-20 09:00:00",
    28: "2026-05-20 10:00:00",
    29: "2026-05-20 11:00:00",
    30: "2026-05-20 15:30:00",
}


def ts(text):
    return dt.datetime.fromisoformat(text)


def author_rows():
    return [
        (i, f"Writer {i:02d}", f"writer{i:02d}@example.org", ts(f"2026-04-{i:02d} 08:00:00"), ts(f"2026-04-{i:02d} 08:00:00"))
        for i in range(1, 11)
    ]


def article_rows():
    rows = []
    for i in range(1, 31):
        author = (i - 1) % 10 + 1
        day = min(i, 19)
        updated = ts(LATE_UPDATES.get(i, f"2026-05-{min(i, 17):02d} 10:00:00"))
        published = None if i in DRAFTS else min(ts(f"2026-05-{day:02d} 09:00:00"), updated)
        created = min(ts(f"2026-05-{min(i, 17):02d} 08:00:00"), updated)
        deleted = updated if i in DELETED else None
        rows.append((i, f"Post number {i}", f"Body of post {i}", published, author, created, updated, deleted))
    return rows


def source(spark):
    return {
        "authors": spark.createDataFrame(author_rows(), schemas.SOURCE_AUTHORS),
        "articles": spark.createDataFrame(article_rows(), schemas.SOURCE_ARTICLES),
    }
