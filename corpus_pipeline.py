"""A corpus pipeline over the documents table, made of the training-data operators.

Stages are ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which the next stage gets as written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_names, materialize, release, table, written
from millrace.llm.decontam import without_contaminated
from millrace.llm.linededup import dedup_lines
from millrace.llm.nearcopies import one_of_each
from millrace.llm.packing import pack_documents
from millrace.llm.quality import score_quality
from millrace.llm.queries import quality_model, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from all documents' labels of two folds of three."""
    (score,) = free_names(docs, "quality_score")
    return score_quality(docs, quality_model(spark, sf_dir), score_col=score).filter(F.col(score) >= 0.5).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines they share with a document of a larger id; n_chars follows the text."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return one_of_each(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece, with its sequence and place."""
    return pack_documents(docs, tokenizer_path(), carry={"ids_crc32": F.crc32("ids")})


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier and tokenised packing have no SQL form; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over ``documents``."""
    docs, mark = table(spark, sf_dir, "documents"), written()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
            release(spark, mark, docs)  # what led to this stage's result
    return docs
