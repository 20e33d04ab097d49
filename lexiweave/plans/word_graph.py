"""Inverted index of comments, and word communities from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rows import explode_once
from ..functions.text import words
from ..operators.graph import (
    code_graph,
    communities,
    community_edges,
    community_nodes,
    filter_communities,
    group_theta,
    refine_large,
)
from ..operators.index import cooccurrence, doc_frequency, postings
from ..operators.terms import adaptive_frequent_terms, doc_count, term_counts
from ..operators.tokens import keep_classes
from ..runtime import materialize

# Word classes kept for the index.
INDEX_CLASSES = ("noun", "verb")


def index_vocabulary(docs: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Terms ``(group_id, term, n)`` that are frequent enough for their group."""
    tokens = explode_once(docs, ["group_id", "doc_id"], words(F.col("text")))
    if lexicon is not None:
        tokens = keep_classes(tokens, lexicon, INDEX_CLASSES)
    counts = term_counts(tokens, ["group_id"])
    return adaptive_frequent_terms(counts, doc_count(docs))


def build_index(docs: DataFrame, lexicon: DataFrame | None = None, match: str = "token") -> DataFrame:
    """Postings of ``docs(group_id, doc_id, text)``, all groups in one job."""
    vocabulary = materialize(index_vocabulary(docs, lexicon), "vocabulary")
    return postings(docs, vocabulary, match)


def word_graph(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the word communities of each group."""
    index = materialize(index, "postings")
    theta = materialize(group_theta(index), "theta")
    edges = materialize(cooccurrence(index, theta), "edges")
    terms = index.select("group_id", "term").distinct()
    graph = code_graph(terms, edges)
    first = materialize(communities(terms, edges, graph=graph), "first")
    refined = materialize(refine_large(edges, first, theta, graph=graph), "refined")
    kept = filter_communities(refined, first)
    nodes = materialize(community_nodes(kept, doc_frequency(index)), "nodes")
    return nodes, community_edges(nodes, edges)
