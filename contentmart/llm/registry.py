"""Checked queries of the training-data operators: Spark form and, where SQL can say it, DuckDB form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentmart.llm import conversation_repair, embedding_dedup, exact_dedup, fill_in_middle, language_id, line_dedup, lm_scoring, mixing, packing, secrets, sentencepiece_bpe, sharding, simhash


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col("n_lines").cast("long"), F.col("n_removed").cast("long"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(_table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The vocabulary file of the packing contract."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_id.identify(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings that stay once false positives are removed; the secret itself is not shown."""
    out = secrets.scan(_table(spark, sf_dir, "documents")).filter("is_secret")
    return out.select("doc_id", "start", "length", F.sha2("candidate", 256).alias("secret_sha256"), "score")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus's own budget, no source used more than one and a half times."""
    out = mixing.mix(_table(spark, sf_dir, "documents"), max_repetition=1.5)
    return out.select("doc_id", "source", "pass", "weight", "exponent", "n_tokens")


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = sharding.shard(_table(spark, sf_dir, "documents"), shards=8)
    return rows.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.transform(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def piece_model_path() -> str:
    """The model file of the encoding contract."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_digests(_table(spark, sf_dir, "documents"))


def sentencepiece_digests(docs: DataFrame) -> DataFrame:
    encoded = sentencepiece_bpe.encode(docs, piece_model_path())
    out = sentencepiece_bpe.decode(encoded, piece_model_path())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return conversation_repair.repair_digests(conversation_repair.damage(turns), ids=turns)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_language_id": op5_language_id,
    "op6_secret_scan": op6_secret_scan,
    "op7_source_mixing": op7_source_mixing,
    "op8_hilbert_sharding": op8_hilbert_sharding,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_conversation_repair": op13_conversation_repair,
}

_TEN = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, length(t) AS n_cp, regexp_replace(t, '[\x20\x09-\x0D]', '', 'g') AS norm FROM d),
g AS (SELECT norm, arg_min(doc_id, struct_pack(a := -n_cp, b := doc_id)) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""

ORACLE = {
    "op1_line_dedup": line_dedup.SQL.format(docs="documents"),
    "op10_exact_dedup": _TEN,
    "op11_fill_in_middle": fill_in_middle.SQL.format(docs="documents"),
}
