"""Readers for line-oriented text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fields import parse_group_id, split_values
from ..operators.terms import union_vocabularies
from ..runtime import dense_index, lookup_join, materialize

# The line formats.
MIN_CATEGORY_CHARS = 5
CATEGORY_SEPARATOR = "/"
WEIGHT_LINE = r"^([\s\S]*)`([^`]*)$"


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line: ``(text)``."""
    return spark.read.text(path, lineSep="\n").select(F.col("value").alias("text"))


def _numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with their file and their position in it.

    The lines are stored once, so that both uses below see the same splits; a
    position is the number of lines in earlier splits of the file plus the rank
    inside the split. Nothing is sorted and no line is shuffled by content.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    stored = materialize(lines, "lines")
    blocks = stored.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("_seq").alias("_first"))
    # One row per file split: small numbers, never lines, meet in one task per file.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "file", "block", "_first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    )
    return lookup_join(stored, materialize(offsets, "splits"), ["file", "block"], ["_seq"]).select(
        "file",
        (F.col("_before") + F.col("_seq") - F.col("_first")).alias("doc_id"),
        "text",
    )


def read_grouped_lines(spark: SparkSession, directory: str | Sequence[str]) -> DataFrame:
    """All files of a directory: ``(group_id, doc_id, text)``.

    The group is the file name without ``.txt``, the id the line number from 0.
    One job reads all files.
    """
    # File paths arrive percent-encoded; a plus sign in a name is itself.
    path = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
    return _numbered_lines(spark, directory).select(
        parse_group_id(path).alias("group_id"), "doc_id", "text"
    )


def read_category_lines(spark: SparkSession, directory: str | Sequence[str]) -> DataFrame:
    """Each line of at least five characters is a class: ``(label, pos, term)``.

    Classes are numbered in the order of files and lines; items stand between
    slashes, each with its position in the line.
    """
    lines = _numbered_lines(spark, directory).where(F.length("text") >= MIN_CATEGORY_CHARS)
    classes = dense_index(lines, [F.asc("file"), F.asc("doc_id")], "label")
    return classes.select(
        "label", F.posexplode(split_values(F.col("text"), CATEGORY_SEPARATOR)).alias("pos", "term")
    )


def read_weighted_lines(spark: SparkSession, path: str, invert: bool = False) -> DataFrame:
    """Lines ``term`share``: ``(pos, term, weight)``; ``invert`` gives 1 - share.

    The line is cut at its last backtick, so a term may hold backticks.
    """
    lines = _numbered_lines(spark, path).select(
        F.col("doc_id").alias("pos"),
        F.regexp_extract("text", WEIGHT_LINE, 1).alias("term"),
        F.expr("try_cast(regexp_extract(text, '`([^`]*)$', 1) AS double)").alias("share"),
    )
    weight = 1 - F.col("share") if invert else F.col("share")
    return lines.where((F.col("term") != "") & F.col("share").isNotNull()).select(
        "pos", "term", weight.alias("weight")
    )


def read_weighted_terms(spark: SparkSession, specs: Sequence[tuple[str, bool]]) -> DataFrame:
    """Ordered union of weighted lists: ``(term, idx, weight)``, last weight wins.

    ``specs`` is a sequence of ``(path, invert)``.
    """
    return union_vocabularies([read_weighted_lines(spark, path, invert) for path, invert in specs])
