"""Term counts, frequency filters and vocabularies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.thresholds import MIN_TERM_LENGTH, TOPIC_MIN_COUNT, index_theta
from ..runtime import dense_index, lookup_join


def term_counts(tokens: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Occurrences of every term, per group if ``by`` is given."""
    return tokens.groupBy(*by, "term").agg(F.count("*").alias("n"))


def doc_count(docs: DataFrame, by: Sequence[str] = ("group_id",)) -> DataFrame:
    """Number of documents per group."""
    return docs.groupBy(*by).agg(F.count("*").alias("n_docs"))


def frequent_terms(
    counts: DataFrame, min_count: int = TOPIC_MIN_COUNT, min_len: int = MIN_TERM_LENGTH
) -> DataFrame:
    """Terms that are frequent and long enough."""
    return counts.where((F.col("n") >= min_count) & (F.length("term") >= min_len))


def adaptive_frequent_terms(
    counts: DataFrame,
    n_docs: DataFrame,
    by: Sequence[str] = ("group_id",),
    min_len: int = MIN_TERM_LENGTH,
) -> DataFrame:
    """Terms whose count reaches a threshold that depends on the size of their group."""
    theta = n_docs.select(*by, index_theta(F.col("n_docs")).alias("theta"))
    long_enough = counts.where(F.length("term") >= min_len)
    return (
        lookup_join(long_enough, theta, by, ["term"])
        .where(F.col("n") >= F.col("theta"))
        .select(*by, "term", "n")
    )


def build_vocabulary(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Give each distinct term its dimension: most frequent first, then by name."""
    totals = counts.groupBy(*by, "term").agg(F.sum("n").alias("n"))
    order = [*[F.asc(c) for c in by], F.desc("n"), F.asc("term")]
    return dense_index(totals, order, "idx", within=by).select(*by, "term", "idx", "n")


def union_vocabularies(lists: Sequence[DataFrame]) -> DataFrame:
    """Ordered union of weighted lists ``(term, pos, weight)``.

    A term keeps the place of its first appearance and the weight of its last.
    """
    ranked = [
        one.select("term", F.lit(rank).alias("list"), F.col("pos").cast("long").alias("pos"), "weight")
        for rank, one in enumerate(lists)
    ]
    place = F.struct("list", "pos")
    merged = (
        reduce(DataFrame.unionByName, ranked)
        .groupBy("term")
        .agg(F.min(place).alias("first"), F.max_by("weight", place).alias("weight"))
    )
    return dense_index(
        merged.select("term", "weight", "first.list", "first.pos"),
        [F.asc("list"), F.asc("pos"), F.asc("term")],
    ).select("term", "idx", "weight")


def rank_desc(df: DataFrame, value: str, *ties: str) -> DataFrame:
    """Full sort, largest value first, ties in ascending order of ``ties``."""
    return df.orderBy(F.desc(value), *[F.asc(tie) for tie in ties])


def top_k(df: DataFrame, k: int, by: Sequence[str], value: str, *ties: str) -> DataFrame:
    """The k largest rows per group with their rank from 1.

    The rank filter lets Spark keep only k rows per group before the shuffle.
    """
    order = Window.partitionBy(*by).orderBy(F.desc(value), *[F.asc(tie) for tie in ties])
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
