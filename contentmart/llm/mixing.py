"""Mixing sources to target weights by temperature.

A source's weight is its token share raised to an exponent and normalised: 1 keeps the shares, 0
makes all sources equal.  The exponent is bisected until the weights meet a target entropy or a limit
on how often a source is repeated.  The weights are realised within a token budget as block
permutations: each source's documents stand in a seeded random order of blocks and of documents in a
block; whole passes are whole permutations, and the last pass stops where the budget is filled.

Scale: sources stay a distributed table, however many there are; a round of the search is one
aggregation that tries a grid of exponents at once.  A source that holds a third of all rows is cut
into blocks by hash; running sums go over blocks first and inside a block second, so no task ever
holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentmart.llm.common import WORD, materialise, place, positional

#: Documents aimed at for one block of a permutation.
DOCS_PER_BLOCK = 2048
GRID = 17
MAX_EXPONENT = 16.0


def _try(shares: DataFrame, exponents: list[float], budget: float) -> list[tuple[float, float]]:
    """(entropy in nats, largest repetition) of the weights for each exponent, in one aggregation."""
    out = []
    logp = F.log("share")
    powers = [F.exp(logp * a) for a in exponents]
    sums = shares.agg(*[F.sum(p).alias(f"z{i}") for i, p in enumerate(powers)]).first()
    asked = []
    for i, p in enumerate(powers):
        w = p / F.lit(float(sums[i]))
        asked += [F.sum(-w * F.log(w)), F.max(w * budget / F.col("tokens"))]
    got = shares.agg(*asked).first()
    out = [(float(got[2 * i]), float(got[2 * i + 1])) for i in range(len(exponents))]
    return out


def solve_exponent(
    shares: DataFrame,
    budget: float,
    target_entropy: float | None = None,
    max_repetition: float | None = None,
    tolerance: float = 1e-6,
) -> float:
    """The smallest exponent that keeps every limit given; the largest tried if none can be kept.

    Entropy falls and the largest repetition of a small source falls as the exponent grows, so each
    limit is met on one side of a single exponent; a grid of exponents narrows it down 16-fold a round.
    A target entropy asks for weights with that entropy at most, a repetition limit for documents used
    that often at most.  Exponents over 1, which favour large sources, are tried for an entropy alone.
    """
    most = 1.0 if max_repetition is not None else MAX_EXPONENT

    def keeps(got: tuple[float, float]) -> bool:
        entropy, repeats = got
        return (target_entropy is None or entropy <= target_entropy + 1e-12) and (
            max_repetition is None or repeats <= max_repetition + 1e-12
        )

    low, high = 0.0, most
    while high - low > tolerance:
        grid = [low + (high - low) * i / (GRID - 1) for i in range(GRID)]
        kept = [keeps(x) for x in _try(shares, grid, budget)]
        if not any(kept):
            return most
        first = kept.index(True)
        if first == 0:
            return grid[0]
        low, high = grid[first - 1], grid[first]
    return high


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: int | None = None,
    target_entropy: float | None = None,
    max_repetition: float | None = None,
    seed: int = 20,
    docs_per_block: int = DOCS_PER_BLOCK,
) -> DataFrame:
    """Documents of the mixture, one row for each use, with all columns of ``docs``.

    Adds pass (int, from 0), weight (double, of the source), exponent (double) and n_tokens (long,
    words of the text).  ``budget`` is in tokens and is the corpus's own total when not given.  Source s
    gets budget * weight tokens: whole passes over its documents, then documents in block order while
    the sum of the pass, without the document, is below what is left.

    A null source is a source of its own.  A null or empty text has no tokens: it costs nothing and
    comes with every pass that its place is reached in; a source without tokens is passed once.
    Repeated rows are separate documents; ties in the order fall by id and row.  An empty table gives an
    empty result.  Extra columns pass through; input columns called like an added one are replaced.
    """
    added = ("pass", "weight", "exponent", "n_tokens")
    names = docs.columns
    at = {r: f"__c{place(docs, c)}" for r, c in (("source", source_col), ("id", id_col), ("text", text_col))}
    flat = positional(docs).select(
        "*",
        F.col(at["source"]).cast("string").alias("src"),
        words(F.col(at["text"])).alias("tok"),
        F.monotonically_increasing_id().alias("rid"),
    )
    flat, _ = materialise(flat, "mix-rows")
    key = F.coalesce(F.concat(F.lit("="), "src"), F.lit("null"))
    rows = flat.select("rid", key.alias("src"), "tok", F.xxhash64(F.lit(seed), F.col(at["id"]), "rid").alias("u"))

    sources, _ = materialise(rows.groupBy("src").agg(F.sum("tok").alias("tokens"), F.count("*").alias("docs")), "mix-sources")
    total = int(sources.agg(F.sum("tokens")).first()[0] or 0)
    budget = total if budget is None else int(budget)
    exponent = 1.0
    shares = sources.filter("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    if total and (target_entropy is not None or max_repetition is not None):
        exponent = solve_exponent(shares, budget, target_entropy, max_repetition)
    power = F.exp(F.log("share") * exponent)
    norm = float(shares.agg(F.sum(power)).first()[0] or 1.0) if total else 1.0
    weights = shares.select("src", (power / F.lit(norm)).alias("weight"))
    plan = sources.join(weights, "src", "left").select(
        "src",
        "tokens",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.greatest(F.lit(1), F.ceil(F.col("docs") / docs_per_block)).cast("long").alias("blocks"),
        F.floor(F.coalesce("weight", F.lit(0.0)) * F.lit(float(budget)) + 0.5).cast("long").alias("quota"),
    )
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(F.lit(1)))
    plan = plan.withColumn("left", F.when(F.col("tokens") > 0, F.expr("quota % tokens")).otherwise(F.lit(0)))
    plan, _ = materialise(plan, "mix-plan")

    # Places: blocks in random order by hash, documents by hash in a block.
    dealt = rows.join(plan.select("src", "blocks"), "src")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("u", F.lit(seed)), F.col("blocks"))).drop("blocks")
    dealt, _ = materialise(dealt, "mix-dealt")
    sums = dealt.groupBy("src", "block").agg(F.sum("tok").alias("tok"))
    turn = Window.partitionBy("src").orderBy(F.xxhash64("block", F.lit(seed)), "block")
    sums = sums.select("src", "block", (F.sum("tok").over(turn) - F.col("tok")).alias("before"))
    inside = Window.partitionBy("src", "block").orderBy("u", "rid").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.select("src", "block", "rid", "tok", (F.sum("tok").over(inside) - F.col("tok")).alias("run"))
    used = (
        placed.join(sums, ["src", "block"])
        .join(plan.select("src", "whole", "left", "weight"), "src")
        .select(
            "rid",
            "weight",
            (F.col("whole") + F.when(F.col("before") + F.col("run") < F.col("left"), 1).otherwise(0)).cast("int").alias("uses"),
        )
        .filter("uses > 0")
    )
    out = flat.join(used, "rid")
    out = out.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("uses") - 1)))
    columns = [F.col(f"__c{i}").alias(c) for i, c in enumerate(names) if c.lower() not in added]
    return out.select(*columns, "pass", "weight", F.lit(exponent).alias("exponent"), F.col("tok").alias("n_tokens"))
