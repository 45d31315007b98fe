"""Inputs for the hard cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that operators use inside, and near misses of real ones.
CLASHES = ["rid", "Text", "digest", "kept", "fp", "removed", "n_tokens", "weight", "size", "shard", "word", "src", "__c0", "item"]


def edge_rows():
    long = " ".join(f"word{i % 977} and" for i in range(60_000))
    base = "one two three four five six seven eight nine ten"
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n\r ", None, "b"),
        (4, base, "en", None),
        (5, base, "en", "a"),
        (5, base, "en", "a"),  # a repeated row
        (6, base.replace(" ", "  "), "en", "a"),
        (None, base, "fr", "b"),
        (None, None, None, None),
        (7, long, "en", "c"),
        (8, "12345 67890 !!!", "de", "c"),
        (9, "\n".join(["l1", "l2", "l3", "x", "l1", "l2", "l3", "l4"]), "en", "c"),
        (10, "\n".join(["l0", "l1", "l2", "l3", "l4"]), "en", "c"),
        (11, "é\U0001f600 ünï \x00 cödé", "fr", "c"),
        (-12, "a a a a a", "en", "c"),
        (12, "\n".join(["same"] * 9), "en", "c"),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


def clashing(df, names=CLASHES):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def low_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
