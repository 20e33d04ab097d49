"""The registered queries of this subpackage: each applies one operator to its whole table.

``QUERIES`` maps a name to a function of (spark, table folder); ``SQL`` holds DuckDB twins where
SQL can express the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiweave.llm import (
    decontaminate,
    fingerprints,
    langid,
    multiindex,
    packing,
    quality,
    secrets,
    simhash,
    spelling,
    substrings,
    tokencounts,
    toxicity,
    whitening,
)
from lexiweave.llm.batches import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers, names or units."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a network trained on rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, ~held_out(F.col("doc_id")))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; the source is the host, its part in one language the path."""
    docs, usable = table(spark, sf_dir, "documents"), ~held_out(F.col("doc_id"))
    model = quality.train(docs, table(spark, sf_dir, "labels"), usable)
    sited = docs.select("doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("section"))
    return quality.posteriors(sited, model, "source", "section").withColumn("held_out", ~usable)


@query
def op4_multi_index_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return multiindex.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by patterns and by the field trained on them."""
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document and its offending sentences."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "offending"
    )


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, how much of it fits 1024 tokens, and the counts at all of its prefixes."""
    return tokencounts.token_counts(table(spark, sf_dir, "documents"), with_prefixes=True)


@query
def op9_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that documents share, with small differences."""
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, how like they are, and the near fingerprints."""
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent word at one edit, and the last of such a chain."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
