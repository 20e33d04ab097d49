"""Text form of the inverted index: ``term:[id, id]``, one folder per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import lookup_join

# Longest id list on one line. A term with more documents gets several lines,
# which the reader puts together again.
IDS_PER_LINE = 100_000
# Most ids that a task gathers for a term; longer lists are dealt into parts.
IDS_PER_PART = 1 << 16


def posting_lines(postings: DataFrame, per_line: int = IDS_PER_LINE) -> DataFrame:
    """``(group_id, line)``, with lists of bounded length.

    The ids of a term are gathered once and cut into lines there. Only terms with very many ids are looked up, to be
    dealt into parts: there is at most one per ``IDS_PER_PART`` postings, so their table stays small and the postings
    are not shuffled for it.
    """
    most = max(per_line, IDS_PER_PART)
    frequency = postings.groupBy("group_id", "term").agg(F.count("*").alias("_df"))
    long_lists = frequency.where(F.col("_df") > most).select(
        "group_id", "term", F.ceil(F.col("_df") / most).cast("long").alias("_parts")
    )
    placed = lookup_join(postings, long_lists, ["group_id", "term"], ["doc_id"], "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_parts")), F.lit(0))
    )
    gathered = placed.groupBy("group_id", "term", "_part").agg(F.sort_array(F.collect_set("doc_id")).alias("_all"))
    last = F.floor(F.greatest(F.size("_all") - 1, F.lit(0)) / per_line).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("_all", k * per_line + 1, F.lit(per_line)))
    return gathered.select("group_id", "term", F.explode(cut).alias("ids")).select(
        "group_id",
        F.concat(F.col("term"), F.lit(":["), F.concat_ws(", ", F.col("ids").cast("array<string>")), F.lit("]")).alias("line"),
    )


def write_postings(postings: DataFrame, path: str, per_line: int = IDS_PER_LINE) -> None:
    posting_lines(postings, per_line).hint("rebalance", "group_id").write.partitionBy("group_id").text(path)


def parse_postings(lines: DataFrame) -> DataFrame:
    """``(group_id, line)`` back to ``(group_id, term, doc_id)``."""
    ids = F.split(F.regexp_replace(F.regexp_extract("line", r"\[([^\]]*)\]\s*$", 1), r"\s", ""), ",")
    # The parts of a line are cut before its ids become rows.
    parts = lines.select(
        "group_id",
        F.regexp_extract("line", r"^(.*):\[", 1).alias("term"),
        F.array_remove(ids, F.lit("")).alias("ids"),
    )
    return (
        parts.select("group_id", "term", F.explode("ids").alias("id"))
        .select("group_id", "term", F.expr("try_cast(id AS bigint)").alias("doc_id"))
        .where(F.col("doc_id").isNotNull())
    )


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.schema("value string, group_id string").option("lineSep", "\n").text(path)
    return parse_postings(lines.select("group_id", F.col("value").alias("line")))
