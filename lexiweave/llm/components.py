"""Connected components of a link table, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiweave.runtime import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest id reachable from every id that occurs in ``links``: rows (id, component_id).

    Every round replaces the links of a node by links to the smallest neighbour, first among
    larger neighbours and then among smaller ones, until all links are stars around the
    smallest id of their component. Links that repeat are reduced before they are shuffled.
    Rows with a null end are ignored, links to oneself are kept as single nodes. Each round
    is a stored table, so a lost executor repeats one round at most.
    """
    both = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    both = materialize(both, "pairs")
    loops = both.where("a = b").select("a", "b")
    edges = materialize(
        both.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen["n"], seen["h"]) == state:
            break
        state = (seen["n"], seen["h"])
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    found = edges.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(roots)
    alone = loops.select(F.col("a").alias("id"), F.col("a").alias("component_id"))
    return found.unionByName(alone).groupBy("id").agg(F.min("component_id").alias("component_id"))


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): every pair with the smallest of u and its neighbours.

    The minima are a stored table, so both sides of the join come straight from a shuffle and
    adaptive execution can split a node with very many links among tasks.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(materialize(least, "least"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return _smallest(pairs).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; edges have a > b."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    linked = _smallest(pairs)
    moved = linked.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = linked.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).distinct()
