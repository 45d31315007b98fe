"""Staging (text ids) to warehouse (numeric ids) casts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_ids(df: DataFrame, id_cols: tuple[str, ...] = ("id",)) -> DataFrame:
    """Cast text ids to BIGINT; a value that is not a number fails the run.

    The check is explicit (``try_cast`` + ``raise_error``), so it holds
    whether or not the session runs in ANSI mode.
    """
    out = df
    for c in id_cols:
        if c in df.columns:
            parsed = F.expr(f"try_cast(`{c}` AS BIGINT)")
            bad = F.col(c).isNotNull() & parsed.isNull()
            message = F.concat(F.lit(f"CAST_INVALID_INPUT: {c} = "), F.col(c).cast("string"))
            out = out.withColumn(c, F.when(bad, F.raise_error(message)).otherwise(parsed).cast("bigint"))
    return out


def split_bad_ids(df: DataFrame, id_cols: tuple[str, ...] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """(good rows cast to BIGINT, rows whose id text is not a number).

    Uses ``try_cast`` so nothing fails; the two outputs partition the input.
    """
    present = [c for c in id_cols if c in df.columns]
    ok = F.lit(True)
    for c in present:
        ok = ok & (F.col(c).isNull() | F.expr(f"try_cast(`{c}` as bigint)").isNotNull())
    flagged = df.withColumn("_ok", ok)
    good = typed_ids(flagged.filter("_ok").drop("_ok"), tuple(present))
    bad = flagged.filter(~F.col("_ok")).drop("_ok")
    return good, bad
