"""Small file-system actions on shared storage (HDFS, object stores, local).

Spark has no DataFrame call for "does this path exist" or "delete this
landing file", so these go through the Hadoop FileSystem that Spark itself
uses; paths therefore work on any storage the cluster can read.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def require(spark: SparkSession, path: str) -> None:
    """Missing input is an error (the loader never runs on nothing)."""
    if not exists(spark, path):
        raise FileNotFoundError(f"input not found: {path}")


def write_text_atomic(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file under a temporary name, then rename it into place.

    Readers that list the folder see the file whole or not at all (names
    starting with ``_`` or ``.`` are ignored by Spark's file listing).
    """
    jvm = spark.sparkContext._jvm
    final = jvm.org.apache.hadoop.fs.Path(path)
    fsys = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tmp = jvm.org.apache.hadoop.fs.Path(final.getParent(), "_tmp." + final.getName())
    out = fsys.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fsys.rename(tmp, final):
        raise OSError(f"could not publish {path}")


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file whole, only where nothing has that name yet.

    The text goes to a file of its own first and is then renamed without overwrite, so of two writers
    one gets ``FileExistsError`` and readers never see a half-written file.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(path)
    fsys = final.getFileSystem(conf)
    own = jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_tmp.{uuid.uuid4().hex}")
    out = fsys.create(own, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fsys.makeQualified(final).toUri(), conf)
    try:
        context.rename(fsys.makeQualified(own), fsys.makeQualified(final), options)
    except Py4JJavaError as e:
        fsys.delete(own, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise FileExistsError(path) from None
        raise


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small text file whole (metadata such as a layout marker)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fsys = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fsys.open(hpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()
