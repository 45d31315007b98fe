"""Corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a frame
that is written as Parquet and read again as the next stage's docs.  All but the last return the
columns of ``documents``.  Nulls, empty texts, ties, repeated rows, empty tables and extra columns are
handled as each operator's docstring says.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart.llm import language_id, line_dedup, mixing, packing, registry, simhash
from contentmart.llm.common import drop_tables, materialise, place, positional, ready, scratch_scope

#: Shingle length and differing bits of the near-duplicate stage: those of the operator's contract.
SHINGLE, MAX_BITS = 4, 4
#: No source's documents are used more often than this on average; the budget is what came in.
MAX_REPETITION = 1.25


_WRITTEN: list[str] = []


def _stage(fn):
    """A stage whose operator's own tables are deleted when the next stage begins.

    By then this stage's result is written, and nothing reads them any more.
    """

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _WRITTEN)
        with scratch_scope(_WRITTEN):
            return fn(spark, docs, sf_dir)

    return run_stage


def _by_place(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named by place, so that no name clashes, and where its own columns are."""
    return positional(docs), {c: f"__c{place(docs, c)}" for c in ("doc_id", "text", "source", "n_chars")}


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters or like no language go."""
    return language_id.filter_languages(docs)


@_stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of passages that stand earlier; n_chars follows the text."""
    flat, at = _by_place(docs)
    out = line_dedup.dedup_lines(flat, id_col=at["doc_id"], text_col=at["text"])
    out = out.withColumn(at["n_chars"], F.length(at["text"]).cast("long"))
    return out.select(*flat.columns).toDF(*docs.columns)


@_stage
def dedup_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=SHINGLE, max_bits=MAX_BITS)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each use of a document in the mixture."""
    flat, at = _by_place(docs)
    out = mixing.mix(flat, at["source"], at["doc_id"], at["text"], max_repetition=MAX_REPETITION)
    return out.select(*flat.columns).toDF(*docs.columns)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(docs, registry.tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_simhash),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Language identification learns a model, which SQL cannot say; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    read: list[str] = []
    for name, stage in STAGES[:-1]:
        docs, path = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_tables(spark, read)  # the stage's input, now that its result is written
        read.append(path)
    return STAGES[-1][1](spark, docs, sf_dir)
