"""Queries of the training-data operators, and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest_neighbours
from .common import drop_scratch, fold, table  # noqa: F401 - drop_scratch for the entry points
from .decontam import contaminated
from .hmm import score_documents
from .langid import predict_language, train_langid
from .licenses import scan_licenses
from .linededup import dedup_lines, line_dedup_sql
from .packing import pack_documents
from .quality import AttentionMIL, score_quality, train_quality
from .sharding import extendible_shards, shard_sql
from .simhash import hex_fingerprint, near_duplicates

#: Small enough that the test tables need several shards.
SHARD_BYTES = 1 << 20


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), carry={"ids_crc32": F.crc32("ids")})


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id", "n_copies")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) != 2)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only contaminated documents: one row per document and item found in it."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tid")


def quality_model(spark: SparkSession, sf_dir: str) -> AttentionMIL | None:
    """Learned from labels whose id is in fold 0 or 2 of 3."""
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 3) != 1)
    return train_quality(table(spark, sf_dir, "documents"), labels)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_quality(docs, quality_model(spark, sf_dir))
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = train_langid(docs.filter(fold(F.col("doc_id"), 4) != 2))
    return predict_language(docs, net).select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op10_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


QUERIES = (
    op1_best_fit_packing,
    op2_simhash_near_dedup,
    op3_line_dedup,
    op4_nearest_neighbours,
    op5_hmm_scoring,
    op6_benchmark_decontamination,
    op7_quality_classifier,
    op8_language_id,
    op9_license_scan,
    op10_extendible_sharding,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": line_dedup_sql(), "op10_extendible_sharding": shard_sql(SHARD_BYTES)}
