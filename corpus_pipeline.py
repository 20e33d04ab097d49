"""The corpus pipeline: stages that each work on all that the one before kept.

Every stage is a function of (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns the places of all pieces in packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiweave.llm import decontaminate, langid, packing, secrets, simhash
from lexiweave.llm.batches import held_out
from lexiweave.runtime import materialize

SECRET_MARK = "<secret>"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts that are null or have no letter go."""
    return langid.keep_known(docs, langid.train(docs, ~held_out(F.col("doc_id"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret and ``n_chars`` of the new text."""
    clean = secrets.redact(docs, secrets.train(docs), mark=SECRET_MARK)
    if "n_chars" not in clean.columns:
        return clean
    size = F.when(F.contains("text", F.lit(SECRET_MARK)), F.length("text").cast(clean.schema["n_chars"].dataType))
    return clean.withColumn("n_chars", size.otherwise(F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

# Trained networks, fingerprints and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each to the stored table of the one before."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
