"""Registered queries: each is a function of the tables, with its SQL twin beside it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rows import explode_once
from ..functions.text import words


@dataclass
class Tables:
    """The given tables below one folder, and the inputs derived from them."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def comments(self) -> DataFrame:
        """``documents`` as comments, one group per language."""
        return self.documents.select(F.col("lang").alias("group_id"), "doc_id", "text")

    def tokens(self) -> DataFrame:
        return explode_once(self.comments(), ["group_id", "doc_id"], words(F.col("text")))

    def labelled(self, label: str) -> DataFrame:
        """Word arrays of the labelled documents."""
        labels = self.labels.select("doc_id", F.col(label).alias("label"))
        return self.documents.select("doc_id", "text").join(labels, "doc_id").select(
            "doc_id", words(F.col("text")).alias("terms"), "label"
        )

    def profile_lines(self) -> DataFrame:
        """Customers as tagged lines; customers without orders lack the last two fields."""
        place = self.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        priorities = self.orders.groupBy("o_custkey").agg(
            F.concat_ws(",", F.sort_array(F.collect_set("o_orderpriority"))).alias("g")
        )
        bought = (
            self.orders.select("o_custkey", F.col("o_orderkey").alias("l_orderkey"))
            .join(self.lineitem.select("l_orderkey", F.col("l_partkey").alias("p_partkey")), "l_orderkey")
            .join(self.part.select("p_partkey", "p_brand"), "p_partkey")
            .groupBy("o_custkey")
            .agg(F.concat_ws(",", F.sort_array(F.collect_set("p_brand"))).alias("c"))
        )

        def field(tag: str, value) -> F.Column:
            return F.concat(F.lit(f"<{tag}>"), value.cast("string"), F.lit(f"</{tag}>"))

        return (
            self.customer.join(place, "c_nationkey")
            .join(priorities, F.col("c_custkey") == priorities.o_custkey, "left")
            .join(bought, F.col("c_custkey") == bought.o_custkey, "left")
            .select(
                F.col("c_custkey").alias("member"),
                F.concat(
                    field("age", F.floor(F.col("c_acctbal") / 1000)),
                    field("sex", F.col("c_mktsegment")),
                    field("area", F.col("n_name")),
                    F.coalesce(field("group", F.col("g")), F.lit("")),
                    F.coalesce(field("collection", F.col("c")), F.lit("")),
                ).alias("raw"),
            )
        )

    def labelled_lines(self) -> DataFrame:
        """Labelled documents as tagged lines with the class marker ``<sex>m</sex>``."""
        labels = self.labels.select("doc_id", "quality")
        flat = F.translate("text", "\n<>", "   ")
        return self.documents.join(labels, "doc_id").select(
            "doc_id",
            F.concat(
                F.when(F.col("quality") == 1, "<sex>m</sex>").otherwise("<sex>f</sex>"),
                F.lit("<tag>"), F.col("lang"), F.lit(","), F.col("source"), F.lit(",</tag><group>"),
                F.substring_index(F.translate("text", "<>", "  "), "\n", 1),
                F.lit("</group><words>"), flat, F.lit("</words>"),
            ).alias("raw"),
        )


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query of the tables under ``name``."""

    def register(run: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return register


# SQL pieces shared by the twins.

SQL_WORDS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"

SQL_TOKENS = f"""
toks AS (
  SELECT lang AS group_id, doc_id, unnest({SQL_WORDS.format('text')}) AS term FROM documents)
"""

SQL_LABELLED = """
rec AS (
  SELECT d.doc_id, %s AS label, unnest(list_distinct(%s)) AS term
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
"""

SQL_LABELLED_ALL = """
rec AS (
  SELECT d.doc_id, %s AS label, unnest(%s) AS term
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
"""

SQL_INDEX_VOCABULARY = f"""
{SQL_TOKENS},
n AS (SELECT lang AS group_id, count(*) AS n_docs FROM documents GROUP BY 1),
theta AS (
  SELECT group_id, CAST(CASE WHEN n_docs < 100 THEN floor(n_docs * 0.01::DOUBLE)
    WHEN n_docs < 1000 THEN floor(n_docs * 0.05::DOUBLE) ELSE 50 END AS BIGINT) AS theta FROM n),
cnt AS (SELECT group_id, term, count(*) AS n FROM toks GROUP BY 1, 2),
voc AS (
  SELECT group_id, term, cnt.n AS n FROM cnt JOIN theta USING (group_id)
  WHERE length(term) >= 2 AND cnt.n >= theta)
"""

SQL_POSTINGS = f"""
{SQL_INDEX_VOCABULARY},
firsts AS (SELECT lang AS group_id, text, min(doc_id) AS doc_id FROM documents GROUP BY 1, 2),
post AS (
  SELECT DISTINCT group_id, term, doc_id FROM toks
  SEMI JOIN firsts USING (group_id, doc_id)
  SEMI JOIN voc USING (group_id, term))
"""

SQL_GRAPH_THETA = f"""
{SQL_POSTINGS},
gtheta AS (
  SELECT group_id, CASE WHEN t < 10 THEN 0.0::DOUBLE WHEN t < 100 THEN 1.0::DOUBLE
    WHEN t < 1000 THEN t * 0.05::DOUBLE ELSE 50.0::DOUBLE END AS theta
  FROM (SELECT group_id, count(DISTINCT term) AS t FROM post GROUP BY 1))
"""

SQL_EDGES = f"""
{SQL_GRAPH_THETA},
pairs AS (
  SELECT a.group_id, a.term AS src, b.term AS dst, count(*) AS w
  FROM post a JOIN post b ON a.group_id = b.group_id AND a.doc_id = b.doc_id AND a.term < b.term
  GROUP BY 1, 2, 3),
edges AS (SELECT group_id, src, dst, w FROM pairs JOIN gtheta USING (group_id) WHERE w > theta)
"""

SQL_PROFILES = """
pri AS (
  SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS g
  FROM orders GROUP BY 1),
col AS (
  SELECT o_custkey, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS c
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1),
prof AS (
  SELECT c_custkey AS member, CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR) AS age,
    c_mktsegment AS sex, n_name AS area, g AS grp, c AS coll
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN pri ON pri.o_custkey = c_custkey LEFT JOIN col ON col.o_custkey = c_custkey),
taglist AS (
  SELECT member, list_concat([age, sex, area], coalesce(string_split(grp, ','), CAST([] AS VARCHAR[])),
    coalesce(string_split(coll, ','), CAST([] AS VARCHAR[]))) AS tags FROM prof),
ptags AS (SELECT member, unnest(tags) AS tag FROM taglist)
"""
