"""Files: each query writes rows derived from the tables and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.affinity import class_affinity
from ..operators.clusters import labels_across_k
from ..operators.graph import community_nodes, edges_of_nodes, group_theta
from ..operators.index import cooccurrence, doc_frequency
from ..operators.terms import rank_desc
from ..operators.vectors import dense_vectors
from ..plans.word_graph import build_index
from ..runtime import materialize, scratch_path
from .. import sources as S
from .base import SQL_LABELLED, SQL_POSTINGS, SQL_WORDS, query
from .feature_queries import SQL_SEGMENTS, _assign, _segments, _six, _tagged
from .graph_queries import SQL_NODES, _index, _kept

DOC_WORDS = SQL_WORDS.format("text")

SQL_LINES = """lines AS (SELECT unnest(string_split(text, chr(10))) AS text FROM documents)"""


@query("src1_read_lines", f"WITH {SQL_LINES} SELECT text, count(*) AS n FROM lines GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "lines")
    t.documents.select("text").write.text(path)
    return S.read_lines(t.spark, path).groupBy("text").agg(F.count("*").alias("n"))


@query(
    "src2_read_grouped_lines",
    f"WITH {SQL_LINES} SELECT text, count(*) AS n, TRUE AS dense FROM lines GROUP BY 1",
)
def _(t):
    path = scratch_path(t.spark, "grouped")
    t.documents.select("text").write.text(path)
    lines = materialize(S.read_grouped_lines(t.spark, path), "lines")
    # Line numbers of a file must run from 0 without gaps.
    files = lines.groupBy("group_id").agg(
        (F.max("doc_id") + 1 - F.countDistinct("doc_id")).alias("gaps"), F.min("doc_id").alias("low")
    )
    bad = files.where((F.col("gaps") != 0) | (F.col("low") != 0)).select("group_id")
    return (
        lines.join(bad.withColumn("bad", F.lit(True)), "group_id", "left")
        .groupBy("text")
        .agg(F.count("*").alias("n"), (F.count("bad") == 0).alias("dense"))
    )


@query("src13_resume_by_files", f"WITH {SQL_LINES} SELECT text, count(*) AS n FROM lines GROUP BY 1")
def _(t):
    # Half of the files are finished; with the lines of the pending ones every line is there once.
    given, output = scratch_path(t.spark, "given"), scratch_path(t.spark, "output")
    t.documents.select("text").repartition(8).write.text(given)
    lines = S.read_grouped_lines(t.spark, given)
    first = lines.where(F.pmod(F.xxhash64("group_id"), F.lit(2)) == 0).select("group_id", "text")
    first.write.partitionBy("group_id").text(output)
    rest = S.read_pending_lines(t.spark, given, output)
    done = t.spark.read.schema("value string, group_id string").option("lineSep", "\n").text(output)
    both = rest.select("text").unionByName(done.select(F.col("value").alias("text")))
    return both.groupBy("text").agg(F.count("*").alias("n"))


@query(
    "src3_read_category_lines",
    """WITH l AS (SELECT p_brand, string_agg(DISTINCT p_name, '/' ORDER BY p_name) AS line FROM part GROUP BY 1)
      SELECT term, count(*) AS n_classes FROM (SELECT unnest(string_split(line, '/')) AS term FROM l WHERE length(line) > 4)
      GROUP BY 1""",
)
def _(t):
    path = scratch_path(t.spark, "categories")
    brands = t.part.groupBy("p_brand").agg(F.concat_ws("/", F.sort_array(F.collect_set("p_name"))).alias("line"))
    brands.select("line").write.text(path)
    return S.read_category_lines(t.spark, path).groupBy("term").agg(F.countDistinct("label").alias("n_classes"))


SQL_LISTS = f"""{SQL_LABELLED % ('quality', DOC_WORDS)},
c AS (SELECT term, sum(label) / count(*) AS share, CAST(sum(label) AS BIGINT) AS pos,
  CAST(count(*) - sum(label) AS BIGINT) AS neg FROM rec GROUP BY 1),
l1 AS (SELECT term, share AS weight FROM c WHERE pos > 5 AND share >= 0.9::DOUBLE),
l2 AS (SELECT term, 1 - share AS weight FROM c WHERE neg > 5 AND share <= 0.95::DOUBLE)"""


@query(
    "src4_read_weighted_terms",
    f"""WITH {SQL_LISTS} SELECT term, round(coalesce(l2.weight, l1.weight), 6) AS weight
      FROM l1 FULL OUTER JOIN l2 USING (term)""",
)
def _(t):
    records = t.labelled("quality")
    first = class_affinity(records, low=0.9)
    second = class_affinity(records, support=F.col("neg") > 5, low=0.0, high=0.95)
    paths = []
    for df in (first, second):
        path = scratch_path(t.spark, "weights")
        lines = rank_desc(df, "share", "term")
        lines.select(F.concat(F.col("term"), F.lit("`"), F.col("share").cast("string"))).write.text(path)
        paths.append(path)
    terms = S.read_weighted_terms(t.spark, [(paths[0], False), (paths[1], True)])
    return _six(terms.select("term", "weight"), "weight")


@query(
    "src5_src6_libsvm",
    """WITH e AS (SELECT label, unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS value,
        generate_subscripts(embedding, 1) - 1 AS idx FROM embeddings)
      SELECT CAST(label AS DOUBLE) AS label, idx, round(sum(value), 5) + 0.0 AS total, count(*) AS n FROM e GROUP BY 1, 2""",
)
def _(t):
    from pyspark.ml.functions import vector_to_array

    path = scratch_path(t.spark, "libsvm")
    S.write_libsvm(dense_vectors(t.embeddings.select("label", "embedding"), "embedding"), path)
    rows = S.read_libsvm(t.spark, path, 64).select(
        "label", F.posexplode(vector_to_array("features")).alias("idx", "value")
    )
    return rows.groupBy("label", F.col("idx").cast("bigint").alias("idx")).agg(
        (F.round(F.sum("value"), 5) + F.lit(0.0)).alias("total"), F.count("*").alias("n")
    )


@query("src7_src8_postings", f"WITH {SQL_POSTINGS} SELECT group_id, term, doc_id FROM post")
def _(t):
    path = scratch_path(t.spark, "index")
    S.write_postings(build_index(t.comments()), path)
    return S.read_postings(t.spark, path)


@query("src7_src8_postings_in_parts", f"WITH {SQL_POSTINGS} SELECT group_id, term, doc_id FROM post")
def _(t):
    path = scratch_path(t.spark, "index")
    S.write_postings(_index(t), path, per_line=20)
    return S.read_postings(t.spark, path)


@query("src9_read_cluster_members", "SELECT label AS cluster, vec_id AS member FROM embeddings")
def _(t):
    path = scratch_path(t.spark, "members")
    S.write_cluster_members(_assign(t), path, per_line=20)
    return S.read_cluster_members(t.spark, path)


@query(
    "src10_write_tag_counts",
    f"WITH {SQL_SEGMENTS} SELECT cluster, tag || ':' || count(*) AS line FROM asg JOIN ptags USING (member) GROUP BY cluster, tag",
)
def _(t):
    from ..operators.clusters import cluster_tag_counts

    path = scratch_path(t.spark, "tags")
    S.write_tag_counts(cluster_tag_counts(_segments(t), _tagged(t)), path)
    return t.spark.read.schema("line string, cluster int").text(path)


@query(
    "src11_write_membership",
    "SELECT vec_id AS member, concat_ws(' ', label % 8, label % 9, label % 10) AS labels FROM embeddings",
)
def _(t):
    path = scratch_path(t.spark, "membership")
    labelled = t.embeddings.select(
        F.col("vec_id").alias("member"), F.explode(F.array(F.lit(8), F.lit(9), F.lit(10))).alias("k"), "label"
    )
    S.write_membership(labels_across_k(labelled.withColumn("cluster", F.col("label") % F.col("k"))), path)
    return S.read_membership(t.spark, path)


@query(
    "src12_write_graph",
    f"""WITH {SQL_NODES}, num AS (SELECT group_id, term, row_number() OVER (PARTITION BY group_id ORDER BY number, term) - 1 AS node
        FROM nodes)
      SELECT p.group_id, least(a.node, b.node) AS v1, greatest(a.node, b.node) AS v2, w FROM edges p
      JOIN num a ON a.group_id = p.group_id AND a.term = src JOIN num b ON b.group_id = p.group_id AND b.term = dst""",
)
def _(t):
    path = scratch_path(t.spark, "graph")
    index = _index(t)
    nodes = materialize(community_nodes(_kept(index), doc_frequency(index)), "nodes")
    edges = edges_of_nodes(nodes, cooccurrence(index, group_theta(index))).select("group_id", "src", "dst", "w")
    S.write_graph(nodes, edges, path)
    return S.read_graph_edges(t.spark, path)
