"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of key characters, and all values that are assigned to a key word.  Each becomes numbers: length and character shares,
transitions between character kinds and between letters (against the corpus's own words), the share of
letters that the corpus's words cover, and what the labelled findings say of the path it was found under and
of the words around it.  A random forest trained from labelled findings scores every candidate.

All of it is DataFrame expressions and Spark ML on the JVM: no Python runs on the executors.

Scale: texts are read by two maps (dictionary and candidates); only word counts and findings are
shuffled.  All words count: letter pairs are summed to 676 rows, and what words cover of the candidates is a
join of the candidates' pieces with the words.  Neighbouring words and path parts are learned from all labelled
findings, hashed into BUCKETS sums.  Spans are running sums over one document's findings.  The forest is fitted on a bounded
sample of labelled findings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentmart.llm.common import materialise, pick

KEY_WORDS = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private|credential|auth|bearer"
#: Key characters in a row, at least, where no key word announces them.
MIN_LENGTH = 16
_KEY = "[A-Za-z0-9_+/-]"
#: A run that is the ASCII part of one word with an accented or other Latin letter beside it.
_WORD = r"(?:[A-Z]?[a-z]++|[A-Z]++)"
_FRAGMENT = rf"(?:(?<=\p{{IsLatin}}){_WORD}(?!{_KEY})|{_WORD}(?=[\p{{IsLatin}}&&[^A-Za-z]]))"
RUN = rf"(?<!{_KEY})(?!{_FRAGMENT}){_KEY}{{{MIN_LENGTH},}}+"
#: What is assigned to a key word: up to the closing quote or white space, whatever its length and
#: characters; a full stop, comma or semicolon at the end of an unquoted value is left out.
_TO = rf"(?<=(?i:{KEY_WORDS})(?:[_-][A-Za-z0-9_-]{{0,16}})?[\"']?\s{{0,8}}[=:]\s{{0,8}}"
_HERE = r"(?<=[=:\s\"'])(?<=[=:]\s{0,8}[\"']?)"
ASSIGNED = rf"""{_HERE}(?:{_TO}\")[^\s\"]+|{_TO}')[^\s']+|{_TO})[^\s\"'](?:\S*[^\s.,;])?)"""
CANDIDATE = f"(?:{ASSIGNED}|{RUN})"
#: Letters of a word of the corpus that covers a part of a longer piece, at least and at most; whole pieces
#: are looked up from three letters on, whatever their length.
INNER_WORD = (5, 24)
#: Labelled findings of each kind that the forest is fitted on, at most.
FIT_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 6, 11
#: Characters of the surroundings that are looked at.
NEAR = 48
#: Hash buckets of neighbouring words and path parts.
BUCKETS = 1 << 13
#: Findings' worth of doubt in a word's odds: words that are rare among the labelled findings say little.
DOUBT = 2.0

PLAIN_WORDS = "example|sample|dummy|placeholder|test|digest|checksum|commit|sha1|sha256|md5|uuid|iban|isbn|version"


def findings(docs: DataFrame, id_col="doc_id", text_col="text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: rid, doc_id, path, start, candidate, before, after (the NEAR
    characters of the text on either side of it)."""
    roles = {"doc_id": id_col, "text": text_col} | ({"path": path_col} if path_col else {})
    rows = pick(docs, **roles).withColumn("rid", F.monotonically_increasing_id())
    if not path_col:
        rows = rows.withColumn("path", F.lit(""))
    hit = rows.filter(F.col("text").rlike(CANDIDATE))
    runs = hit.select(
        "rid",
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.split("text", CANDIDATE, -1).alias("gaps"),
    )
    # The text as gap, candidate, gap, ... with the edges of each only, of which NEAR on a side are enough.
    edge = lambda x: F.struct(F.length(x).alias("n"), F.right(x, F.lit(NEAR)).alias("tail"), F.left(x, F.lit(NEAR)).alias("head"))
    parts = F.flatten(F.zip_with("gaps", F.concat("found", F.array(F.lit(""))), lambda g, c: F.array(edge(g), edge(c))))
    runs = runs.select("rid", "doc_id", "path", "found", parts.alias("parts"))

    def one(c, k):
        at = 2 * k + 2  # the place of the candidate in parts, from 1
        first = F.greatest(F.lit(1), at - 2 * NEAR)
        before = F.array_join(F.slice(F.col("parts")["tail"], first, at - first), "")
        after = F.array_join(F.slice(F.col("parts")["head"], at + 1, F.lit(2 * NEAR)), "")
        return F.struct(
            k.alias("k"),
            c.alias("candidate"),
            F.element_at("parts", at - 1)["n"].alias("gap"),
            F.right(before, F.lit(NEAR)).alias("before"),
            F.left(after, F.lit(NEAR)).alias("after"),
        )

    each = runs.select("rid", "doc_id", "path", F.explode(F.transform("found", one)).alias("c")).select("rid", "doc_id", "path", "c.*")
    each, _ = materialise(each, "secret-findings")
    so_far = Window.partitionBy("rid").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.length("candidate")).over(so_far) - F.length("candidate")
    return each.withColumn("start", start.cast("long")).drop("gap", "k")


@dataclass
class Dictionary:
    """What the corpus's words say: the surprise of each letter pair, and (candidate, covered letters)."""

    surprise: list[float]
    covered: DataFrame


def word_counts(docs: DataFrame, text_col="text") -> DataFrame:
    """(w, n): all words of three ASCII letters or more outside the candidates, with their counts."""
    outside = F.lower(F.regexp_replace("text", CANDIDATE, " "))
    words = pick(docs, text=text_col).select(F.explode(F.split(outside, r"[^a-z\P{ASCII}]+")).alias("w"))
    return words.filter(F.col("w").rlike("^[a-z]{3,}$")).groupBy("w").agg(F.count("*").alias("n"))


def dictionary(words: DataFrame, candidates: DataFrame) -> Dictionary:
    """The letter pairs of all ``words`` (w, n) and what they cover of each of ``candidates`` (candidate)."""
    return Dictionary(_transition_table(words), coverage(words, candidates))


def coverage(words: DataFrame, candidates: DataFrame) -> DataFrame:
    """(candidate, covered): letters of a candidate that are in words of the corpus.

    A candidate's pieces are its runs of letters, cut where a capital follows a small letter.  Covered are
    pieces that are words, and what words of INNER_WORD letters cover of the others.
    """
    split = F.split(F.lower(F.regexp_replace("candidate", "(?<=[a-z])(?=[A-Z])", " ")), "[^a-z]+")
    pieces = candidates.select("candidate").distinct().select("candidate", F.explode(split).alias("piece"))
    pieces, _ = materialise(pieces.filter(F.length("piece") >= 3), "secret-pieces")
    low, high = INNER_WORD
    size = F.length("piece")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(1), size),
            lambda i: F.transform(
                F.filter(F.sequence(F.lit(low), F.lit(high)), lambda k: k <= size - i + 1),
                lambda k: F.struct(i.alias("at"), k.alias("k"), F.substring("piece", i, k).alias("w")),
            ),
        )
    )
    whole = F.array(F.struct(F.lit(1).alias("at"), size.alias("k"), F.col("piece").alias("w")))
    spots = pieces.select("piece").distinct().select("piece", F.explode(F.array_union(whole, inner)).alias("s")).select("piece", "s.*")
    hits = spots.join(words.select("w"), "w").groupBy("piece").agg(F.sort_array(F.collect_list(F.struct("at", "k"))).alias("hits"))
    start = F.struct(F.lit(1).alias("end"), F.lit(0).alias("sum"))
    union = F.aggregate(
        "hits",
        start,
        lambda a, h: F.struct(
            F.greatest(a["end"], h["at"] + h["k"]).alias("end"),
            (a["sum"] + F.greatest(F.lit(0), h["at"] + h["k"] - F.greatest(a["end"], h["at"]))).alias("sum"),
        ),
    )
    per_piece = hits.select("piece", union["sum"].alias("covered"))
    covered = pieces.join(per_piece, "piece").groupBy("candidate").agg(F.sum("covered").alias("covered"))
    # Written first: the joins with findings then shuffle both sides, and Spark can split a hot candidate.
    return materialise(covered, "secret-covered")[0]


def _share(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)) / F.length(c)


def _transition_table(words: DataFrame) -> list[float]:
    """Smoothed share of each letter pair (26 x 26) in all words (w, n), as its surprise in nats."""
    import math

    at = F.sequence(F.lit(1), F.length("w") - 1)
    pairs = words.select("n", F.explode(F.transform(at, lambda i: F.substring("w", i, F.lit(2)))).alias("pair"))
    n = [[0.5] * 26 for _ in range(26)]
    for pair, k in pairs.groupBy("pair").agg(F.sum("n")).collect():  # 676 rows at most
        n[ord(pair[0]) - 97][ord(pair[1]) - 97] += k
    return [-math.log(x / sum(row)) for row in n for x in row]


def _buckets(tag: str, parts: Column) -> Column:
    """The distinct buckets of an array of words; those of different tags have nothing to do with each other."""
    words = F.filter(parts, lambda w: F.length(w) > 0)
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(F.lit(tag), w), F.lit(BUCKETS)).cast("int")))


def surroundings() -> dict[str, Column]:
    """The buckets of a finding's word next before it, all words before and after it, and its path and the parts of that."""
    before, after, path = F.lower("before"), F.lower("after"), F.lower("path")
    other = r"[^\p{L}\p{N}_]+"
    return {
        "f_next": _buckets("next", F.array(F.regexp_extract(before, r"([\p{L}\p{N}_]+)[^\p{L}\p{N}_]*$", 1))),
        "f_before": _buckets("before", F.split(before, other)),
        "f_after": _buckets("after", F.split(after, other)),
        "f_path": _buckets("path", F.array_union(F.array(path), F.split(path, r"[^\p{L}\p{N}]+"))),
    }


def _half() -> Column:
    """Which half of the labelled findings one is in: all findings of a candidate are in the same."""
    return F.pmod(F.xxhash64(F.lit("half"), "candidate"), F.lit(2)).cast("int")


def learn_surroundings(labelled: DataFrame) -> list[list[float]]:
    """For each half of ``labelled`` (candidate, path, before, after, label), the log-odds of a secret by bucket.

    A bucket that no finding has is at 0, as are all where a half has findings of one kind only.
    """
    import math

    # The bucket -1 stands in every finding, for the totals.
    all_of = F.concat(F.array(F.lit(-1)), *surroundings().values())
    each = labelled.select(_half().alias("half"), "label", F.explode(all_of).alias("bucket"))
    sums = each.groupBy("half", "bucket").agg(F.sum("label").alias("yes"), F.count("*").alias("n"))
    tables = [[0.0] * BUCKETS for _ in range(2)]
    got = {(r["half"], r["bucket"]): (r["yes"], r["n"] - r["yes"]) for r in sums.collect()}  # 2 * (BUCKETS + 1) rows at most
    for (half, bucket), (yes, no) in got.items():
        all_yes, all_no = got[half, -1]
        if bucket >= 0 and all_yes and all_no:
            share = all_yes / (all_yes + all_no)
            tables[half][bucket] = math.log((yes + DOUBT * share) / (no + DOUBT * (1 - share))) - math.log(share / (1 - share))
    return tables


FEATURES = [
    "f_length", "f_digits", "f_upper", "f_lower", "f_signs", "f_distinct", "f_kinds", "f_surprise",
    "f_covered", "f_next", "f_before", "f_after", "f_path", "f_assigned", "f_quoted",
]


def features(found: DataFrame, words: Dictionary, odds: list[list[float]] | None = None, fitting: bool = False) -> DataFrame:
    """Adds the numbers of FEATURES to findings (candidate, path, before, after).

    ``odds`` are those of ``learn_surroundings``; a finding that the forest is fitted on takes them from the half that it is
    not in, so that its own label is not among them, any other the mean of both.
    """
    if odds is None:
        near = {name: F.lit(0.0) for name in surroundings()}
    else:
        mean = [(a + b) / 2 for a, b in zip(*odds, strict=True)]
        # A literal once the optimiser has been over it.
        listed = lambda t: F.split(F.lit(",".join(f"{x:.6g}" for x in t)), ",").cast("array<double>")
        table = F.when(_half() == 0, listed(odds[1])).otherwise(listed(odds[0])) if fitting else listed(mean)
        near = {
            name: F.aggregate(at, F.lit(0.0), lambda a, i: a + F.element_at(table, i + 1)) for name, at in surroundings().items()
        }
    c, low = F.col("candidate"), F.lower("candidate")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    changes = F.regexp_count(kinds, F.lit(r"0(?=[^0])|a(?=[^a])|A(?=[^A])|[^aA0](?=[aA0])"))
    letters = F.regexp_replace(low, "[^a-z]+", "")
    table = F.array(*[F.lit(float(x)) for x in words.surprise])
    code = lambda s, i: F.ascii(F.substring(s, i, F.lit(1))) - 97
    pairs = F.sequence(F.lit(1), F.length("letters") - 1)
    total = F.aggregate(
        pairs,
        F.lit(0.0),
        lambda a, i: a + F.element_at(table, (code(F.col("letters"), i) * 26 + code(F.col("letters"), i + 1) + 1).cast("int")),
    )
    before, after = F.lower("before"), F.col("after")
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    return found.join(words.covered, "candidate", "left").withColumn("letters", letters).select(
        *[F.col(x) for x in found.columns],
        F.length(c).cast("double").alias("f_length"),
        _share(c, "[0-9]").alias("f_digits"),
        _share(c, "[A-Z]").alias("f_upper"),
        _share(c, "[a-z]").alias("f_lower"),
        _share(c, "[^A-Za-z0-9]").alias("f_signs"),
        (F.size(F.array_distinct(F.split(c, ""))) / F.length(c)).alias("f_distinct"),
        (changes / F.length(c)).alias("f_kinds"),
        F.when(F.length("letters") < 2, 0.0).otherwise(total / (F.length("letters") - 1)).alias("f_surprise"),
        F.when(F.length("letters") == 0, 0.0).otherwise(F.coalesce("covered", F.lit(0)) / F.length("letters")).alias("f_covered"),
        *[x.alias(name) for name, x in near.items()],
        flag(before.rlike(r"[=:]\s*[\"']?$")).alias("f_assigned"),
        flag(before.rlike(r"[\"']$") & after.rlike(r"^[\"']")).alias("f_quoted"),
    )


def rule_label() -> Column:
    """A finding's label where its form or its surroundings say it, else null.

    1: known key formats, and values with a digit that are assigned to a key word.  0: letters only
    (words), account and identifier numbers by their form, and values announced as digests.
    """
    c, before = F.col("candidate"), F.lower("before")
    known = c.rlike(r"^AKIA[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk_live_[A-Za-z0-9]{16,}$|^xox[abpr]-[A-Za-z0-9-]{10,}$")
    assigned = before.rlike(f"({KEY_WORDS})[\"']?\\s*[=:]\\s*[\"']?$") & c.rlike("[0-9]")
    words = c.rlike("^[A-Za-z_/-]+$") & ~before.rlike(r"[=:]\s*[\"']?$")
    numbers = c.rlike(r"^[A-Z]{2}[0-9]{14,30}$|^[0-9_+/-]+$|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
    announced = before.rlike(f"({PLAIN_WORDS})[\"']?\\s*[=: ]\\s*[\"']?$")
    return F.when(known | assigned, 1.0).when(words | numbers | announced, 0.0)


def train(labelled: DataFrame, words: Dictionary, fit_findings: int = FIT_FINDINGS):
    """(forest, odds of the surroundings) from ``labelled`` findings (candidate, path, before, after, label 0 or 1), or
    None when they are all of one kind.  Copies count once; the odds are those of all findings, the forest is fitted on at
    most ``fit_findings`` of each kind, in hash order."""
    labelled = labelled.select("candidate", "path", "before", "after", "label").distinct()
    order = F.xxhash64("candidate", "path", "before", "after")
    kinds = [labelled.filter(F.col("label") == k).orderBy(order).limit(fit_findings) for k in (0.0, 1.0)]
    odds = learn_surroundings(labelled)
    sample, _ = materialise(features(kinds[0].unionByName(kinds[1]), words, odds, fitting=True).select("label", *FEATURES), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    # Both kinds weigh the same, so that one half is the border between them.
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    sample = sample.withColumn("w", F.when(F.col("label") == 1.0, F.lit(1.0 / n[1.0])).otherwise(F.lit(1.0 / n[0.0])) * sum(n.values()) / 2)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="w", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    )
    return forest.fit(_assembled(sample)), odds


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    threshold: float = 0.5,
) -> DataFrame:
    """Every candidate with the forest's verdict: doc_id, start, length, candidate, score, is_secret.

    ``labelled`` holds findings with a label; without it the corpus's own findings are labelled by
    ``rule_label`` where that can tell.  start counts code points (from 0) of the document.

    A null or empty text has no candidate.  Copies and repeated rows are separate findings.  A null path
    or id is carried as an empty path and a null id.  When all labels are of one kind, or none exist,
    that kind (else not secret) is everyone's verdict with score 1 or 0.  An empty table gives an empty
    result; extra columns are ignored, whatever their names.  A null path, before or after of a labelled
    finding is empty; one without a candidate or label is left out.
    """
    found = findings(docs, id_col, text_col, path_col)
    if labelled is None:
        labelled = found.withColumn("label", rule_label()).filter("label is not null")
    else:
        labelled = labelled.filter("candidate is not null and label is not null").fillna("", ["path", "before", "after"])
    counts, _ = materialise(word_counts(docs, text_col), "secret-words")
    words = dictionary(counts, found.select("candidate").union(labelled.select("candidate")))
    model = train(labelled.select("candidate", "path", "before", "after", "label"), words)
    if model is None:
        only = labelled.select(F.max("label")).first()[0]
        scored = found.withColumn("score", F.lit(float(only or 0.0)))
    else:
        forest, odds = model
        scored = forest.transform(_assembled(features(found, words, odds)))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "doc_id",
        "start",
        F.length("candidate").cast("long").alias("length"),
        "candidate",
        "score",
        (F.col("score") >= threshold).alias("is_secret"),
    )
