"""Pipe-delimited text: the hand-off format between extract and staging.

Written by every task in parallel (one file per partition), read back with a
declared schema bound by position.  Quote and escape are both ``"`` so text
holding the separator, quotes, newlines or white space at its ends survives; an
empty field is NULL.

A quoted field with a raw line break makes a file unsplittable: one task must
read it whole.  The library's own hand-off therefore writes line breaks as
backslash escapes (``escape_lines``); files from elsewhere are read as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Fixed values of the file layout.
SEPARATOR = "|"
QUOTE = '"'
NTZ_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_options(sep: str = SEPARATOR, header: bool = True, escape_lines: bool = False) -> dict[str, str]:
    """How files of this layout are read, by a batch or a stream."""
    return {**_options(sep, header), "multiLine": str(not escape_lines).lower()}


def unescape_lines(rows: DataFrame, schema: StructType) -> DataFrame:
    """Texts as they were before ``escape_lines``."""
    return rows.withColumns({c: _unescaped(F.col(c)) for c in _texts(schema)})


def _options(sep: str, header: bool) -> dict[str, str]:
    return {
        "sep": sep,
        "header": str(header).lower(),
        "quote": QUOTE,
        "escape": QUOTE,
        "nullValue": "",
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def _texts(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, StringType)]


def _escaped(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _unescaped(c: Column) -> Column:
    """Between pairs of backslashes, a backslash starts a line break."""
    plain = F.transform(
        F.split(c, r"\\\\", -1),
        lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
    )
    return F.array_join(plain, "\\")


def write_delimited(
    df: DataFrame, path: str, sep: str = SEPARATOR, header: bool = True, mode: str = "overwrite", escape_lines: bool = False
) -> None:
    """Write ``df`` as delimited text; ``overwrite`` replaces a same-named landing."""
    if escape_lines:
        df = df.withColumns({c: _escaped(F.col(c)) for c in _texts(df.schema)})
    (
        df.write.mode(mode)
        .options(**_options(sep, header))
        .option("timestampNTZFormat", NTZ_WRITE_FORMAT)
        .csv(path)
    )


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = SEPARATOR,
    header: bool = True,
    mode: str = "FAILFAST",
    escape_lines: bool = False,
) -> DataFrame:
    """Bulk load: skip the header, bind columns by position, fail on a bad row.

    Without ``escape_lines`` a quoted field may hold line breaks.  Timestamps are parsed
    leniently (with or without fractional seconds, ``T`` or blank separator).
    """
    rows = (
        spark.read.schema(schema)
        .options(**read_options(sep, header, escape_lines))
        .option("enforceSchema", "true")
        .option("mode", mode)
        .csv(path)
    )
    return unescape_lines(rows, schema) if escape_lines else rows
