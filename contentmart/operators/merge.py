"""MERGE (conditional delete / update / insert) as a DataFrame -> DataFrame operator.

Plain parquet tables cannot be merged in place, so ``merge`` returns the new
content of the target; ``publish`` writes it as the next snapshot.

Semantics (ANSI / warehouse MERGE):

* matched clauses are tried in order, the first true one applies; a matched
  row no clause takes is kept unchanged; target rows without a match are kept;
* not-matched clauses likewise; a source row no clause takes is dropped;
* more than one source row for one *matched* target row is an error;
* a NULL source key never matches (it can only be inserted).

Plan shape (see README, "merge"):

* the source is evaluated once: unless the caller hands in a staged frame it is checkpointed, and its
  size, its repeated keys and the joins all read that copy;
* every source row carries ``__n``, the rows of its key, from a count of the keys that repeat (partial
  aggregation first); most sources have none and skip the join;
* shuffle form (large source): one full outer join of target and source, each shuffled once.  It yields
  kept, updated and deleted rows and inserts together.  NULL keys of either side match nothing and are
  dealt out by a salt.  Source keys with more than ``hot_rows`` rows are hot: their rows are dealt over as
  many salts as their count asks for, and a target row with such a key is copied to each of them (a
  match there is a cardinality error anyway);
* bucketed form (a target stored in buckets of its key): the full outer join again, but only the source is
  shuffled, into the target's buckets; rows with a NULL source key pass it by;
* broadcast form (small, always measured source): the target is streamed through broadcast joins and
  never shuffled; inserts are the source rows whose key no target row holds.

Strategy ``auto`` takes the broadcast form for a source under the broadcast limit; ``broadcast`` asks for
it and still gets the shuffle form beyond the limit.  An empty source returns the target untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.session import ensure_checkpoint_dir
from contentmart.operators.sizing import Size, broadcast_limit, fits, measure

SRC = "__s_"
TGT = "__t_"
ACTION = "merge_action"
ACTIONS = ("delete", "insert", "keep", "skip", "update")
#: Hot source keys at most, so that their list (some 40 bytes each) is always small.
MAX_HOT_KEYS = 1000
#: Tasks that rows with a NULL key are dealt over.
NULL_SALTS = 64


def src(name: str) -> Column:
    """Reference a source column inside merge conditions and value maps."""
    return F.col(f"`{SRC}{name}`")


def tgt(name: str) -> Column:
    """Reference a target column inside merge conditions and value maps."""
    return F.col(f"`{TGT}{name}`")


@dataclass(frozen=True)
class Clause:
    kind: str  # delete | update | insert
    condition: Column | None = None
    values: dict[str, Column] = field(default_factory=dict)


def delete(condition: Column | None = None) -> Clause:
    return Clause("delete", condition)


def update(values: dict[str, Column], condition: Column | None = None) -> Clause:
    return Clause("update", condition, dict(values))


def insert(values: dict[str, Column], condition: Column | None = None) -> Clause:
    return Clause("insert", condition, dict(values))


@dataclass(frozen=True)
class MergeSpec:
    target_key: str
    source_key: str
    when_matched: tuple[Clause, ...] = ()
    when_not_matched: tuple[Clause, ...] = ()


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def _pick(conds: list[tuple[Column, str]], default: str) -> Column:
    out = None
    for cond, label in conds:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def _matched_action(spec: MergeSpec) -> Column:
    matched = F.col("__matched")
    guard = F.raise_error(
        F.concat(
            F.lit("MERGE_CARDINALITY_VIOLATION: several source rows match target key "),
            tgt(spec.target_key).cast("string"),
        )
    )
    labels = []
    for i, clause in enumerate(spec.when_matched):
        cond = F.lit(True) if clause.condition is None else clause.condition
        labels.append((F.coalesce(cond, F.lit(False)), "delete" if clause.kind == "delete" else f"update:{i}"))
    chosen = _pick(labels, "keep")
    return F.when(~matched, F.lit("keep")).when(F.col("__n") > 1, guard.cast("string")).otherwise(chosen)


def _insert_action(spec: MergeSpec) -> Column:
    labels = []
    for i, clause in enumerate(spec.when_not_matched):
        cond = F.lit(True) if clause.condition is None else clause.condition
        labels.append((F.coalesce(cond, F.lit(False)), f"insert:{i}"))
    return _pick(labels, "skip")


def _target_values(target: DataFrame, spec: MergeSpec, side: str) -> list[Column]:
    """Project every target column for the matched (``t``) or insert (``s``) side."""
    out = []
    act = F.col(ACTION)
    for f in target.schema.fields:
        if side == "t":
            value = tgt(f.name)
            for i, clause in reversed(list(enumerate(spec.when_matched))):
                if clause.kind == "update" and f.name in clause.values:
                    value = F.when(act == f"update:{i}", clause.values[f.name]).otherwise(value)
        else:
            value = F.lit(None)
            for i, clause in reversed(list(enumerate(spec.when_not_matched))):
                if f.name in clause.values:
                    value = F.when(act == f"insert:{i}", clause.values[f.name]).otherwise(value)
        out.append(value.cast(f.dataType).alias(f.name))
    return out


def _counted(s: DataFrame, skey: str, repeated: DataFrame | None) -> DataFrame:
    """Source rows with ``__n``, the number of rows of their key."""
    if repeated is None:
        return s.withColumn("__n", F.lit(1).cast("long"))
    joined = s.join(repeated, s[skey] == F.col("__rk"), "left")
    return joined.withColumn("__n", F.coalesce("__rn", F.lit(1).cast("long"))).drop("__rk", "__rn")


def _repeated(s: DataFrame, skey: str) -> tuple[DataFrame | None, int]:
    """Non-NULL source keys with several rows and their counts (checkpointed), and the largest count."""
    counts = s.filter(F.col(skey).isNotNull()).groupBy(F.col(skey).alias("__rk")).agg(F.count(F.lit(1)).alias("__rn"))
    counts = counts.filter(F.col("__rn") > 1).checkpoint(eager=True)
    most = counts.agg(F.max("__rn")).first()[0]
    return (None, 1) if most is None else (counts, int(most))


def _broadcast_plan(t: DataFrame, s: DataFrame, tkey: str, skey: str) -> DataFrame:
    """Small source: the target is streamed through broadcast joins, never shuffled."""
    small = F.broadcast(s.withColumn("__in_s", F.lit(True)))
    here = t.withColumn("__in_t", F.lit(True)).join(small, t[tkey] == s[skey], "left")
    # At most one row per source key, so it is no larger than the source.
    hit = t.select(F.col(tkey).alias("__hit")).join(F.broadcast(s.select(skey)), F.col("__hit") == F.col(skey), "left_semi")
    new = s.withColumn("__in_s", F.lit(True)).join(F.broadcast(hit.distinct()), s[skey] == F.col("__hit"), "left_anti")
    return here.unionByName(new, allowMissingColumns=True)


def _shuffle_plan(
    t: DataFrame, s: DataFrame, tkey: str, skey: str, repeated: DataFrame | None, hot_rows: int, limit: int
) -> DataFrame:
    """Large source: one full outer join that no source key and no NULL key can overload."""
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in t.columns]), F.lit(NULL_SALTS)).cast("long")
    t_salt = F.when(F.col(tkey).isNull(), spread).otherwise(F.lit(0).cast("long"))
    left = t.withColumn("__in_t", F.lit(True))
    if repeated is not None:
        salts = F.ceil(F.col("__rn") / F.lit(hot_rows)).cast("long")
        hot = repeated.filter(F.col("__rn") > hot_rows).select(F.col("__rk").alias("__hot"), salts.alias("__salts"))
        # rows / hot_rows of them at most; merge_frame sets hot_rows so that they fit.
        hot = F.broadcast(hot) if limit > 0 else hot
        left = left.join(hot, F.col(tkey) == F.col("__hot"), "left")
        copies = F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1).cast("long")) - 1)
        left = left.withColumn("__copy", F.explode(copies)).drop("__hot", "__salts")
        t_salt = F.when(F.col(tkey).isNull(), spread).otherwise(F.col("__copy"))
    left = left.withColumn("__ts", t_salt).drop("__copy")
    s_salts = F.when(F.col(skey).isNull(), F.lit(NULL_SALTS).cast("long")).otherwise(
        F.greatest(F.lit(1).cast("long"), F.ceil(F.col("__n") / F.lit(hot_rows)).cast("long"))
    )
    right = s.withColumn("__in_s", F.lit(True)).withColumn("__ss", F.pmod(F.xxhash64("__row"), s_salts))
    on = (left[tkey] == right[skey]) & (left["__ts"] == right["__ss"])
    return left.hint("merge").join(right.hint("merge"), on, "full").drop("__ts", "__ss", "__row")


def _bucketed_plan(t: DataFrame, s: DataFrame, tkey: str, skey: str, buckets: int) -> DataFrame:
    """A target stored in buckets of its key: only the source is shuffled, into the same buckets."""
    s = s.withColumn("__in_s", F.lit(True))
    keyed = s.filter(F.col(skey).isNotNull()).repartition(buckets, skey)
    here = t.withColumn("__in_t", F.lit(True)).hint("merge").join(keyed.hint("merge"), F.col(tkey) == F.col(skey), "full")
    return here.unionByName(s.filter(F.col(skey).isNull()), allowMissingColumns=True)


def _validate(target: DataFrame, source: DataFrame, spec: MergeSpec) -> None:
    if spec.target_key not in target.columns:
        raise ValueError(f"merge key {spec.target_key!r} is not a target column")
    if spec.source_key not in source.columns:
        raise ValueError(f"merge key {spec.source_key!r} is not a source column")
    for clause in spec.when_matched + spec.when_not_matched:
        unknown = sorted(set(clause.values) - set(target.columns))
        if unknown:
            raise ValueError(f"{clause.kind} sets columns the target does not have: {unknown}")
    if any(c.kind == "insert" for c in spec.when_matched) or any(c.kind != "insert" for c in spec.when_not_matched):
        raise ValueError("matched clauses delete or update; not-matched clauses insert")


def _choose(s: DataFrame, strategy: str, limit: int, bound: Size | None = None) -> tuple[str, Size]:
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    size = bound if bound is not None else measure(s)
    if size.empty:
        return "empty", size
    return ("shuffle" if strategy == "shuffle" or not fits(size, limit) else "broadcast"), size


def merge_frame(
    target: DataFrame,
    source: DataFrame,
    spec: MergeSpec,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    source_bound: Size | None = None,
    hot_rows: int = 100_000,
    staged: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """All merge outcomes: target columns plus ``merge_action``.

    Deleted target rows and skipped source rows are included (for audits);
    ``merge`` drops them.  ``source_bound`` is an upper bound of the source
    size the caller already knows (e.g. from the staged input); without it
    the source is measured in one pass.  ``staged`` says that ``source`` is a
    stored frame which is cheap to read again.  ``buckets`` says that the
    target is stored in so many buckets of its key.
    """
    _validate(target, source, spec)
    spark = source.sparkSession
    limit = broadcast_limit(spark, broadcast_bytes)
    ensure_checkpoint_dir(spark)
    s = _prefixed(source if staged else source.checkpoint(eager=True), SRC)
    chosen, size = _choose(s, strategy, limit, source_bound)
    if chosen == "empty":
        return target.withColumn(ACTION, F.lit("keep"))
    # Hot keys number at most rows / hot_rows: few enough for a broadcast, whatever the limit is.
    hot_rows = max(hot_rows, -(-size.rows // MAX_HOT_KEYS))
    t = _prefixed(target, TGT)
    tkey, skey = TGT + spec.target_key, SRC + spec.source_key
    repeated, most = _repeated(s, skey)
    if buckets and most <= hot_rows:
        joined = _bucketed_plan(t, _counted(s, skey, repeated), tkey, skey, buckets)
    elif chosen == "broadcast":
        joined = _broadcast_plan(t, _counted(s, skey, repeated), tkey, skey)
    else:
        # Row numbers of the stored copy: the same after a retry, unlike a random salt.
        s = _counted(s.withColumn("__row", F.monotonically_increasing_id()), skey, repeated)
        joined = _shuffle_plan(t, s, tkey, skey, repeated if most > hot_rows else None, hot_rows, limit)
    here = F.coalesce("__in_t", F.lit(False))
    joined = joined.withColumn("__matched", here & F.coalesce("__in_s", F.lit(False)))
    act = F.when(here, _matched_action(spec)).otherwise(_insert_action(spec))
    joined = joined.withColumn(ACTION, act)
    old, new = _target_values(target, spec, "t"), _target_values(target, spec, "s")
    values = [F.when(here, o).otherwise(n).alias(f.name) for o, n, f in zip(old, new, target.schema.fields, strict=True)]
    return joined.select(*values, F.substring_index(F.col(ACTION), ":", 1).alias(ACTION))


def merge(
    target: DataFrame,
    source: DataFrame,
    spec: MergeSpec,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    source_bound: Size | None = None,
    hot_rows: int = 100_000,
    staged: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """New target content after MERGE of ``source`` into ``target``.

    ``hot_rows``: a source key with more rows than this is spread over
    several tasks in the shuffle form.
    """
    frame = merge_frame(target, source, spec, strategy, broadcast_bytes, source_bound, hot_rows, staged, buckets)
    return frame.filter(F.col(ACTION).isin("keep", "update", "insert")).drop(ACTION)


def merge_action_counts(
    target: DataFrame,
    source: DataFrame,
    spec: MergeSpec,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
    source_bound: Size | None = None,
) -> DataFrame:
    """How many rows each branch took: (merge_action, rows)."""
    frame = merge_frame(target, source, spec, strategy, broadcast_bytes, source_bound)
    return frame.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows"))


def merge_conflicts(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Source keys with more than one row that hit a target row: (key, source_rows).

    The check ``merge`` itself raises on, listed instead of raised.
    """
    per_key = (
        source.filter(F.col(spec.source_key).isNotNull())
        .groupBy(spec.source_key)
        .agg(F.count(F.lit(1)).alias("source_rows"))
        .filter(F.col("source_rows") > 1)
    )
    target_keys = target.select(F.col(spec.target_key).alias("__k")).distinct()
    return per_key.join(target_keys, per_key[spec.source_key] == target_keys["__k"], "left_semi")
