"""Inverted index, co-occurrence and word communities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.graph import (
    code_graph,
    communities,
    community_edges,
    community_nodes,
    edges_of_nodes,
    filter_communities,
    group_theta,
    modularity,
    refine_large,
    simplify,
    threshold_edges,
)
from ..operators.index import (
    cooccurrence,
    doc_frequency,
    posting_intersection_size,
    postings,
)
from ..plans.word_graph import build_index, index_vocabulary, word_graph
from ..functions.thresholds import REFINE_ABOVE_SIZE
from ..runtime import dense_index, fits_broadcast, keyed_join, materialize
from .base import SQL_EDGES, SQL_GRAPH_THETA, SQL_INDEX_VOCABULARY, SQL_POSTINGS, query


def _index(t):
    return materialize(build_index(t.comments()), "postings")


def _edges(t):
    index = _index(t)
    return index, cooccurrence(index, group_theta(index))


@query("ag8_postings", f"WITH {SQL_POSTINGS} SELECT group_id, term, doc_id FROM post")
def _(t):
    return build_index(t.comments())


@query(
    "ag8_postings_of_all_copies",
    f"""WITH {SQL_INDEX_VOCABULARY}
      SELECT DISTINCT group_id, term, doc_id FROM toks SEMI JOIN voc USING (group_id, term)""",
)
def _(t):
    vocabulary = materialize(index_vocabulary(t.comments()), "vocabulary")
    return postings(t.comments(), vocabulary, merge_copies=False)


@query(
    "jn2_substring_postings",
    f"""WITH {SQL_INDEX_VOCABULARY},
      firsts AS (SELECT lang AS group_id, lower(text) AS text, min(doc_id) AS doc_id
        FROM documents GROUP BY lang, documents.text)
      SELECT group_id, term, doc_id FROM firsts JOIN voc USING (group_id) WHERE contains(text, term)""",
)
def _(t):
    vocabulary = materialize(index_vocabulary(t.comments()), "vocabulary")
    return postings(t.comments(), vocabulary, "substring")


@query(
    "ag9_doc_frequency",
    f"WITH {SQL_POSTINGS} SELECT group_id, term, count(DISTINCT doc_id) AS df FROM post GROUP BY 1, 2",
)
def _(t):
    return doc_frequency(build_index(t.comments()))


@query("jn3_cooccurrence", f"WITH {SQL_EDGES} SELECT group_id, src, dst, w FROM pairs WHERE w > 20")
def _(t):
    index = _index(t)
    theta = index.select("group_id").distinct().withColumn("theta", F.lit(20.0))
    return cooccurrence(index, theta)


@query(
    "set1_posting_intersection_size",
    f"""WITH {SQL_POSTINGS},
      f AS (SELECT group_id, term, count(*) AS df FROM post GROUP BY 1, 2),
      r AS (SELECT group_id, term, row_number() OVER (PARTITION BY group_id ORDER BY df DESC, term) AS k FROM f),
      asked AS (SELECT x.group_id, x.term AS src, y.term AS dst
        FROM r x JOIN r y ON x.group_id = y.group_id AND y.k = x.k + 1)
      SELECT asked.group_id, src, dst, count(*) AS w FROM asked
      JOIN post a ON a.group_id = asked.group_id AND a.term = src
      JOIN post b ON b.group_id = asked.group_id AND b.term = dst AND a.doc_id = b.doc_id GROUP BY 1, 2, 3""",
)
def _(t):
    # Every term with the next one in the order of document frequency.
    index = _index(t)
    order = [F.asc("group_id"), F.desc("df"), F.asc("term")]
    ranked = materialize(dense_index(doc_frequency(index), order, "k", within=["group_id"]), "ranked")
    after = ranked.select("group_id", (F.col("k") - 1).alias("k"), F.col("term").alias("dst"))
    pairs = ranked.select("group_id", "k", F.col("term").alias("src")).join(after, ["group_id", "k"])
    return posting_intersection_size(index, pairs)


@query("gr1_graph_theta", f"WITH {SQL_GRAPH_THETA} SELECT group_id, theta FROM gtheta")
def _(t):
    return group_theta(_index(t)).select("group_id", "theta")


@query(
    "gr2_threshold_edges",
    f"""WITH {SQL_EDGES} SELECT group_id, src, dst, w FROM edges JOIN gtheta USING (group_id)
      WHERE w > 1.5::DOUBLE * theta""",
)
def _(t):
    # The stricter threshold that large communities are refined with.
    index, edges = _edges(t)
    return threshold_edges(edges, group_theta(index), 1.5)


@query("gr2_cooccurrence_above_theta", f"WITH {SQL_EDGES} SELECT group_id, src, dst, w FROM edges")
def _(t):
    return _edges(t)[1]


# Raw pairs with loops and both directions: market segments of customers against types of parts.
RAW_PAIRS = """raw AS (
  SELECT o_orderpriority AS group_id, c_mktsegment AS src, p_type AS dst, 1 AS w
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = l_partkey
  UNION ALL SELECT o_orderpriority, p_type, c_mktsegment, 1
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = l_partkey
  UNION ALL SELECT o_orderpriority, c_mktsegment, c_mktsegment, 1 FROM orders JOIN customer ON c_custkey = o_custkey)"""


@query(
    "gr3_simplify",
    f"""WITH {RAW_PAIRS} SELECT group_id, least(src, dst) AS src, greatest(src, dst) AS dst,
      CAST(sum(w) AS BIGINT) AS w FROM raw WHERE src <> dst GROUP BY 1, 2, 3""",
)
def _(t):
    ordered = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    pairs = ordered.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("p_partkey") == F.col("l_partkey")
    )
    group = F.col("o_orderpriority").alias("group_id")
    one = F.lit(1).alias("w")
    segment, kind = F.col("c_mktsegment"), F.col("p_type")
    there = pairs.select(group, segment.alias("src"), kind.alias("dst"), one)
    back = pairs.select(group, kind.alias("src"), segment.alias("dst"), one)
    loops = ordered.select(group, segment.alias("src"), segment.alias("dst"), one)
    return simplify(there.unionByName(back).unionByName(loops))


def _letters(index):
    """A given membership: terms by first letter."""
    return index.select("group_id", "term").distinct().withColumn("community", F.substring("term", 1, 1))


SQL_LETTERS = f"""{SQL_EDGES},
mem AS (SELECT DISTINCT group_id, term, substr(term, 1, 1) AS community FROM post)"""


@query(
    "gr5_modularity",
    f"""WITH {SQL_LETTERS},
      m AS (SELECT group_id, CAST(sum(w) AS DOUBLE) AS m FROM edges GROUP BY 1),
      ends AS (SELECT group_id, src AS term, w FROM edges UNION ALL SELECT group_id, dst, w FROM edges),
      tot AS (SELECT group_id, community, CAST(sum(w) AS DOUBLE) AS tot FROM ends JOIN mem USING (group_id, term) GROUP BY 1, 2),
      inn AS (SELECT e.group_id, CAST(sum(w) AS DOUBLE) AS inn FROM edges e
        JOIN mem a ON a.group_id = e.group_id AND a.term = src JOIN mem b ON b.group_id = e.group_id AND b.term = dst
        WHERE a.community = b.community GROUP BY 1)
      SELECT m.group_id, round(coalesce(max(inn), 0) / max(m) - sum((tot / (2 * m)) ** 2), 6) AS modularity
      FROM m JOIN tot USING (group_id) LEFT JOIN inn USING (group_id) GROUP BY 1""",
)
def _(t):
    index, edges = _edges(t)
    return modularity(edges, _letters(index)).withColumn("modularity", F.round("modularity", 6))


# A given refinement: parts by the first two letters in communities of more than ten terms.
SQL_REFINED = f"""{SQL_LETTERS},
siz AS (SELECT group_id, community, count(*) AS size FROM mem GROUP BY 1, 2),
ref AS (SELECT group_id, term, community, CASE WHEN size > 10 THEN substr(term, 1, 2) ELSE '' END AS part
  FROM mem JOIN siz USING (group_id, community)),
fst AS (SELECT group_id, count(*) AS n FROM siz GROUP BY 1),
least AS (SELECT group_id, CASE WHEN n < 10 THEN 3 WHEN n < 20 THEN 4 WHEN n < 30 THEN 5 ELSE 6 END AS least FROM fst),
ps AS (SELECT group_id, community, part, count(*) AS size FROM ref GROUP BY 1, 2, 3),
kept AS (SELECT group_id, term, community, part FROM ref SEMI JOIN (
  SELECT group_id, community, part FROM ps JOIN least USING (group_id)
  WHERE CASE WHEN part = '' THEN size > 1 ELSE size >= least END) k USING (group_id, community, part))"""


def _kept(index):
    first = _letters(index)
    sizes = first.groupBy("group_id", "community").agg(F.count("*").alias("size"))
    refined = first.join(sizes, ["group_id", "community"]).select(
        "group_id",
        "term",
        "community",
        F.when(F.col("size") > 10, F.substring("term", 1, 2)).alias("part"),
    )
    return filter_communities(refined, first)


@query("gr7_filter_communities", f"WITH {SQL_REFINED} SELECT group_id, term, community, part FROM kept")
def _(t):
    return _kept(_index(t)).select("group_id", "term", "community", "part")


SQL_NODES = f"""{SQL_REFINED},
dfreq AS (SELECT group_id, term, count(*) AS size FROM post GROUP BY 1, 2),
nodes AS (SELECT group_id, term, size,
  dense_rank() OVER (PARTITION BY group_id ORDER BY community, part) - 1 AS number
  FROM kept JOIN dfreq USING (group_id, term))"""


@query(
    "gr8_community_nodes",
    f"""WITH {SQL_NODES} SELECT group_id, term, size, number % 50 AS slot,
      row_number() OVER (PARTITION BY group_id ORDER BY number, term) - 1 AS node FROM nodes""",
)
def _(t):
    index = _index(t)
    return community_nodes(_kept(index), doc_frequency(index))


@query(
    "gr9_community_edges",
    f"""WITH {SQL_NODES} SELECT group_id, src, dst, w FROM edges
      SEMI JOIN (SELECT group_id, term AS src FROM nodes) a USING (group_id, src)
      SEMI JOIN (SELECT group_id, term AS dst FROM nodes) b USING (group_id, dst)""",
)
def _(t):
    index, edges = _edges(t)
    return community_edges(_kept(index), edges)


@query(
    "jn6_edges_of_nodes",
    f"""WITH {SQL_NODES} SELECT group_id, src, dst, w FROM edges
      SEMI JOIN (SELECT group_id, term AS src FROM nodes) a USING (group_id, src)
      SEMI JOIN (SELECT group_id, term AS dst FROM nodes) b USING (group_id, dst)""",
)
def _(t):
    index, edges = _edges(t)
    return edges_of_nodes(_kept(index).select("group_id", "term"), edges).select("group_id", "src", "dst", "w")


def _merge_gains(edges, found):
    """Pairs of communities of a group whose union would have a higher modularity; ``edges`` is a stored table."""
    small = fits_broadcast(found)
    ends = F.explode(F.array("src", "dst")).alias("term")
    degree = edges.select("group_id", "w", ends).groupBy("group_id", "term").agg(F.sum("w").alias("k"))
    shares = keyed_join(degree, found, ["group_id", "term"], [], small).groupBy("group_id", "community").agg(F.sum("k").alias("tot"))
    whole = shares.groupBy("group_id").agg(F.sum("tot").alias("m2"))
    one = found.select("group_id", F.col("term").alias("src"), F.col("community").alias("a"))
    two = found.select("group_id", F.col("term").alias("dst"), F.col("community").alias("b"))
    between = (
        keyed_join(keyed_join(edges, one, ["group_id", "src"], ["dst"], small), two, ["group_id", "dst"], ["src"], small).where("a <> b")
        .groupBy("group_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .agg(F.sum("w").alias("w"))
    )
    tot_a = shares.select("group_id", F.col("community").alias("a"), F.col("tot").alias("tot_a"))
    tot_b = shares.select("group_id", F.col("community").alias("b"), F.col("tot").alias("tot_b"))
    scored = between.join(tot_a, ["group_id", "a"]).join(tot_b, ["group_id", "b"]).join(whole, "group_id")
    # The product of two sums of weights may pass a long.
    return scored.where(F.col("w") - F.col("tot_a").cast("double") * F.col("tot_b") / F.col("m2") > 1e-6)


def _community_checks(terms, edges, found):
    """Per group: its terms, how many are in one community, and what a community search must not leave."""
    found = materialize(found, "found")
    gains = _merge_gains(edges, found).groupBy("group_id").agg(F.count("*").alias("improving_merges"))
    alone = found.withColumn("community", F.col("term"))
    low = modularity(edges, found).withColumnRenamed("modularity", "q").join(
        modularity(edges, alone), "group_id"
    ).where(F.col("q") < F.col("modularity")).groupBy("group_id").agg(F.count("*").alias("below_single_terms"))
    once = found.groupBy("group_id", "term").count().where("count = 1").groupBy("group_id").agg(
        F.count("*").alias("n_once")
    )
    sizes = terms.groupBy("group_id").agg(F.count("*").alias("n_terms"))
    both = sizes.join(once, "group_id", "left").join(gains, "group_id", "left").join(low, "group_id", "left")
    return both.na.fill(0).select("group_id", "n_terms", "n_once", "improving_merges", "below_single_terms")


SQL_COMMUNITY_CHECKS = """SELECT group_id, count(DISTINCT term) AS n_terms, count(DISTINCT term) AS n_once,
  CAST(0 AS BIGINT) AS improving_merges, CAST(0 AS BIGINT) AS below_single_terms FROM post GROUP BY 1"""


@query("gr4_communities", f"WITH {SQL_POSTINGS} {SQL_COMMUNITY_CHECKS}")
def _(t):
    index, edges = _edges(t)
    terms = materialize(index.select("group_id", "term").distinct(), "terms")
    edges = materialize(edges, "edges")
    return _community_checks(terms, edges, communities(terms, edges))


@query(
    "gr6_refine_large",
    f"""WITH {SQL_POSTINGS} SELECT group_id, count(DISTINCT term) AS n_terms, count(DISTINCT term) AS n_once,
      CAST(0 AS BIGINT) AS large_unsplit, CAST(0 AS BIGINT) AS small_split FROM post GROUP BY 1""",
)
def _(t):
    # Every term once, and exactly the terms of communities above the size have a part.
    index, edges = _edges(t)
    edges = materialize(edges, "edges")
    terms = materialize(index.select("group_id", "term").distinct(), "terms")
    graph = code_graph(terms, edges)
    first = materialize(communities(terms, edges, graph=graph), "first")
    refined = materialize(refine_large(edges, first, group_theta(index), graph=graph), "refined")
    sizes = first.groupBy("group_id", "community").agg((F.count("*") > REFINE_ABOVE_SIZE).alias("large"))
    marked = refined.join(sizes, ["group_id", "community"])
    checks = marked.groupBy("group_id").agg(
        F.count("*").alias("n_terms"), F.count_distinct("term").alias("n_once"),
        F.count_if(F.col("large") & F.col("part").isNull()).alias("large_unsplit"),
        F.count_if(~F.col("large") & F.col("part").isNotNull()).alias("small_split"),
    )
    return checks


@query(
    "plan_word_graph",
    f"""WITH {SQL_POSTINGS} SELECT group_id, CAST(0 AS BIGINT) AS gaps, CAST(0 AS BIGINT) AS wrong_size,
      CAST(0 AS BIGINT) AS twice, CAST(0 AS BIGINT) AS loose_edges, CAST(0 AS BIGINT) AS wrong_weights,
      CAST(0 AS BIGINT) AS missing_edges FROM (SELECT DISTINCT group_id FROM post)""",
)
def _(t):
    # Nodes are numbered without gaps, carry their document frequency and are different terms. Edges have two
    # nodes as ends and the number of documents that hold both, and none above the threshold is missing.
    index = _index(t)
    nodes, edges = word_graph(index)
    nodes, edges = materialize(nodes, "nodes"), materialize(edges, "edges")
    frequency = doc_frequency(index)
    checked = nodes.join(frequency, ["group_id", "term"])
    per_group = checked.groupBy("group_id").agg(
        (F.max("node") + 1 - F.count_distinct("node")).alias("gaps"),
        F.count_if(F.col("size") != F.col("df")).alias("wrong_size"),
        (F.count("*") - F.count_distinct("term")).alias("twice"),
    )
    one = nodes.select("group_id", F.col("term").alias("src"), F.lit(1).alias("one"))
    two = nodes.select("group_id", F.col("term").alias("dst"), F.lit(1).alias("two"))
    every = cooccurrence(index, group_theta(index)).withColumnRenamed("w", "counted")
    both, small = edges.join(every, ["group_id", "src", "dst"], "full"), fits_broadcast(nodes)
    both = keyed_join(keyed_join(both, one, ["group_id", "src"], ["dst"], small, "left"), two, ["group_id", "dst"], ["src"], small, "left")
    inside = F.col("one").isNotNull() & F.col("two").isNotNull()
    ends = both.groupBy("group_id").agg(
        F.count_if(F.col("w").isNotNull() & ~inside).alias("loose_edges"),
        F.count_if(F.col("w").isNotNull() & ~F.col("w").eqNullSafe(F.col("counted"))).alias("wrong_weights"),
        F.count_if(inside & F.col("w").isNull()).alias("missing_edges"),
    )
    found = index.select("group_id").distinct().join(per_group, "group_id", "left").join(ends, "group_id", "left")
    return found.na.fill(0)
