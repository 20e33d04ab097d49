"""Resume a job over many files: groups whose output exists are not read again."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import parse_group_id
from .text import read_grouped_lines

# Characters of a path that would be read as a pattern.
_PATTERN = re.compile(r"([\[\]{}*?\\])")


def _listed(spark: SparkSession, directory: str) -> DataFrame:
    """(path) of all files below a directory; names are listed, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.load(_PATTERN.sub(r"\\\1", directory)).select("path")


def _exists(spark: SparkSession, directory: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def finished_groups(spark: SparkSession, output: str, key: str = "group_id") -> DataFrame:
    """Groups that have a folder ``key=group`` with files below ``output``: ``(group_id)``.

    An output that does not exist has none.
    """
    if not _exists(spark, output):
        return spark.createDataFrame([], "group_id string")
    # Folder names are escaped, except for a plus sign, which is itself.
    name = F.regexp_extract("path", f"/{re.escape(key)}=([^/]*)/[^/]*$", 1)
    found = _listed(spark, output).where(name != "").select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("group_id"))
    return found.distinct()


def pending_files(spark: SparkSession, directory: str, output: str, key: str = "group_id") -> list[str]:
    """Files of ``directory`` whose group, the file name without ``.txt``, has no output yet, in order.

    The names come to the driver, like those of any table that Spark reads.
    """
    if not _exists(spark, directory):
        return []
    files = _listed(spark, directory).withColumn("group_id", parse_group_id(F.col("path")))
    open_ = files.join(finished_groups(spark, output, key), "group_id", "left_anti")
    return sorted(r["path"] for r in open_.select("path").collect())


def read_pending_lines(spark: SparkSession, directory: str, output: str, key: str = "group_id") -> DataFrame:
    """Lines ``(group_id, doc_id, text)`` of the groups without output; the files of the others are never opened."""
    paths = pending_files(spark, directory, output, key)
    if not paths:
        return spark.createDataFrame([], "group_id string, doc_id bigint, text string")
    return read_grouped_lines(spark, [_PATTERN.sub(r"\\\1", p) for p in paths])
