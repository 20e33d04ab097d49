"""Reports on cluster assignments ``(member, cluster)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import explode_once
from ..runtime import dense_index, lookup_join
from .terms import top_k


def assign_soft(df: DataFrame, p: str = "p", threshold: float = 0.5, out: str = "cluster") -> DataFrame:
    """First component whose probability reaches the threshold, else -1."""
    hits = F.transform(F.col(p), lambda one: one >= threshold)
    first = F.array_position(hits, True)
    return df.withColumn(out, F.when(first > 0, first - 1).otherwise(F.lit(-1)).cast("int"))


def members_with_rows(assign: DataFrame, profiles: DataFrame) -> DataFrame:
    """Cluster members with their profile rows."""
    return assign.join(profiles, "member")


def predictions_with_text(predicted: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Cluster of each row beside its own columns; a model leaves them in the row, so nothing is joined."""
    return predicted.withColumnRenamed(prediction, "cluster")


def cluster_sizes(assign: DataFrame) -> DataFrame:
    return assign.groupBy("cluster").agg(F.count("*").alias("n"))


def order_by_key(df: DataFrame, key: str = "cluster") -> DataFrame:
    return df.orderBy(F.asc(key))


def cluster_tag_counts(assign: DataFrame, tags: DataFrame, tag: str = "tag") -> DataFrame:
    """How often each tag occurs in each cluster, for all clusters at once.

    ``tags`` is ``(member, tag)`` or has an array column ``tags``.
    """
    if "tags" in tags.columns and tag not in tags.columns:
        joined = explode_once(members_with_rows(assign, tags), ["cluster"], "tags", tag)
    else:
        joined = members_with_rows(assign, tags)
    return joined.groupBy("cluster", tag).agg(F.count("*").alias("n"))


def cluster_words(clustered: DataFrame, terms: str = "terms") -> DataFrame:
    """Word counts of each cluster; a row has its cluster and its array of words."""
    return explode_once(clustered, ["cluster"], terms).groupBy("cluster", "term").agg(F.count("*").alias("n"))


def top_tags(counts: DataFrame, k: int = 3, tag: str = "term") -> DataFrame:
    """The k most frequent words of each cluster, exactly k."""
    return top_k(counts, k, ["cluster"], "n", tag)


def cluster_members(assign: DataFrame) -> DataFrame:
    """Members of each cluster in order: ``(cluster, pos, member)``.

    Stays in long form, since a cluster may hold a large part of all members.
    """
    return dense_index(
        assign.select("cluster", "member"),
        [F.asc("cluster"), F.asc("member")],
        "pos",
        within=["cluster"],
    ).select("cluster", "pos", "member")


def labels_across_k(assign: DataFrame, ks: Sequence[int] = (8, 9, 10)) -> DataFrame:
    """Labels of each member for each k, in the order of k, joined by blanks."""
    picked = assign.where(F.col("k").isin(list(ks)))
    ordered = F.sort_array(F.collect_list(F.struct("k", "cluster")))
    return picked.groupBy("member").agg(
        F.concat_ws(" ", F.transform(ordered, lambda one: one["cluster"].cast("string"))).alias("labels")
    )


def accuracy_report(scored: DataFrame) -> DataFrame:
    """Overall accuracy and recall of both classes; a score above 0 is class 1."""
    right = F.when((F.col("score") > 0) == (F.col("label") == 1), 1.0).otherwise(0.0)
    return scored.agg(
        F.avg(right).alias("accuracy"),
        F.avg(F.when(F.col("label") == 1, right)).alias("accuracy_pos"),
        F.avg(F.when(F.col("label") == 0, right)).alias("accuracy_neg"),
    )


def cluster_centres(points: DataFrame, features: str = "features") -> DataFrame:
    """Mean vector of each cluster as an array."""
    return points.groupBy("cluster").agg(
        vector_to_array(Summarizer.mean(F.col(features))).alias("centre")
    )


def squared_distance(values: Column, centre: Column) -> Column:
    return F.aggregate(
        F.zip_with(values, centre, lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda s, d: s + d
    )


def model_centres(model, spark) -> DataFrame:
    """Centres of a clustering model, ``(cluster, centre)``."""
    rows = [(k, [float(x) for x in c]) for k, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, centre array<double>")


def clustering_cost(points: DataFrame, centres: DataFrame, values: str = "values") -> DataFrame:
    """Sum of squared distances to the centre of the own cluster, and rows counted."""
    joined = lookup_join(points, centres, ["cluster"], ["member"])
    return joined.agg(
        F.sum(squared_distance(F.col(values).cast("array<double>"), F.col("centre"))).alias("cost"),
        F.count("*").alias("n"),
    )


def compare_labelings(df: DataFrame, first: str, second: str) -> DataFrame:
    """How often each pair of labels occurs."""
    return df.groupBy(first, second).agg(F.count("*").alias("n"))
