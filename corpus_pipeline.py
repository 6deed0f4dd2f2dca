"""From raw documents to packed training sequences.

`STAGES` lists the steps in order: toxic documents go, one document of each near-duplicate group stays,
documents with benchmark passages go, personal data are replaced by their kinds, and what is left is
packed. Each stage gets the rows that the one before wrote, all of them. All but the last return the
columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandscope.llm.decontam import decontaminate
from bandscope.llm.near import drop_near_duplicates
from bandscope.llm.packing import pack_documents, tokenizer_path
from bandscope.llm.pii import redact
from bandscope.llm.toxicity import drop_toxic
from bandscope.session import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the model learns from `labels` of the documents given."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id."""
    return drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with spans of personal data replaced by their kind; n_chars is counted anew."""
    cleaned = redact(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]

# The first stage fits a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), name)
    return rows
