"""Text files for cluster reports and word graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clusters import cluster_members
from ..runtime import fits_broadcast, keyed_join

# Longest member list on one line; longer clusters take several lines.
MEMBERS_PER_LINE = 100_000


def write_cluster_members(assign: DataFrame, path: str, per_line: int = MEMBERS_PER_LINE) -> None:
    """``cluster:member,member`` lines."""
    placed = cluster_members(assign).withColumn("_line", F.floor(F.col("pos") / per_line))
    lists = placed.groupBy("cluster", "_line").agg(F.sort_array(F.collect_list("member")).alias("m"))
    lists.select(
        F.concat(F.col("cluster").cast("string"), F.lit(":"), F.concat_ws(",", F.col("m").cast("array<string>")))
    ).write.text(path)


def read_cluster_members(spark: SparkSession, path: str) -> DataFrame:
    """``cluster:member,member`` lines as ``(cluster, member)``."""
    parts = spark.read.text(path, lineSep="\n").select(
        F.expr("try_cast(split(value, ':')[0] AS int)").alias("cluster"),
        F.split(F.get(F.split("value", ":"), 1), ",").alias("members"),
    )
    return (
        parts.select("cluster", F.explode("members").alias("m"))
        .select("cluster", F.expr("try_cast(m AS bigint)").alias("member"))
        .where(F.col("cluster").isNotNull() & F.col("member").isNotNull())
    )


def write_tag_counts(counts: DataFrame, path: str, tag: str = "tag") -> None:
    """``tag:count`` lines in one folder per cluster, largest count first.

    Rows are range-partitioned by (cluster, count), so a large cluster becomes
    several files whose order continues from file to file.
    """
    order = [F.asc("cluster"), F.desc("n"), F.asc(tag)]
    lines = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select(
        "cluster", F.concat(F.col(tag), F.lit(":"), F.col("n").cast("string")).alias("line")
    ).write.partitionBy("cluster").text(path)


def write_membership(labels: DataFrame, path: str) -> None:
    """``member:label label`` lines."""
    labels.select(F.concat(F.col("member").cast("string"), F.lit(":"), F.col("labels"), F.lit(" "))).write.text(path)


def read_membership(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        F.regexp_extract("value", r"^(\d+):", 1).cast("bigint").alias("member"),
        F.trim(F.regexp_extract("value", r"^\d+:(.*)$", 1)).alias("labels"),
    )


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """``nodes`` and ``edges`` as CSV, one folder per group.

    A group without nodes gets no rows; both folders always exist.
    """
    columns = nodes.select("group_id", "node", "term", "size", "slot")
    columns.hint("rebalance", "group_id").write.partitionBy("group_id").csv(f"{path}/nodes")
    first = nodes.select("group_id", F.col("term").alias("src"), F.col("node").alias("v1"))
    second = nodes.select("group_id", F.col("term").alias("dst"), F.col("node").alias("v2"))
    small = fits_broadcast(first)
    pairs = keyed_join(
        keyed_join(edges, first, ["group_id", "src"], ["dst"], small),
        second,
        ["group_id", "dst"],
        ["src"],
        small,
    )
    rows = pairs.select(
        "group_id", F.least("v1", "v2").alias("v1"), F.greatest("v1", "v2").alias("v2"), "w"
    )
    rows.hint("rebalance", "group_id").write.partitionBy("group_id").csv(f"{path}/edges")


def read_graph_nodes(spark: SparkSession, path: str) -> DataFrame:
    schema = "node bigint, term string, size bigint, slot bigint, group_id string"
    return spark.read.schema(schema).csv(f"{path}/nodes")


def read_graph_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("v1 bigint, v2 bigint, w bigint, group_id string").csv(f"{path}/edges")
