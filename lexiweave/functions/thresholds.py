"""Step functions that set thresholds by size, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The steps decide which terms, edges and communities are kept.
MIN_TERM_LENGTH = 2
TOPIC_MIN_COUNT = 4
INDEX_STEPS = ((100, 0.01), (1000, 0.05))
INDEX_CEILING = 50
GRAPH_STEPS = ((10, 0.0), (100, 1.0))
GRAPH_RATE_BELOW = 1000
GRAPH_RATE = 0.05
GRAPH_CEILING = 50.0
REFINE_ABOVE_SIZE = 10
REFINE_FACTOR = 1.5
COMMUNITY_STEPS = ((10, 3), (20, 4), (30, 5))
COMMUNITY_CEILING = 6
COLOR_SLOTS = 50


def index_theta(n_docs: Column) -> Column:
    """Least number of occurrences of an indexed term, from the number of comments."""
    (low, low_rate), (high, high_rate) = INDEX_STEPS
    return (
        F.when(n_docs < low, F.floor(n_docs * F.lit(low_rate)))
        .when(n_docs < high, F.floor(n_docs * F.lit(high_rate)))
        .otherwise(F.lit(INDEX_CEILING))
        .cast("long")
    )


def graph_theta(n_terms: Column) -> Column:
    """Weight an edge must exceed, from the number of terms of the graph."""
    (tiny, tiny_theta), (small, small_theta) = GRAPH_STEPS
    return (
        F.when(n_terms < tiny, F.lit(tiny_theta))
        .when(n_terms < small, F.lit(small_theta))
        .when(n_terms < GRAPH_RATE_BELOW, n_terms * F.lit(GRAPH_RATE))
        .otherwise(F.lit(GRAPH_CEILING))
    )


def min_part_size(n_communities: Column) -> Column:
    """Least size of a refined part, from the number of first-level communities."""
    steps = F.when(n_communities < COMMUNITY_STEPS[0][0], COMMUNITY_STEPS[0][1])
    for below, size in COMMUNITY_STEPS[1:]:
        steps = steps.when(n_communities < below, size)
    return steps.otherwise(COMMUNITY_CEILING)
