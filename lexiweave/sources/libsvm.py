"""Labelled sparse vectors as libsvm text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    """Label and 1-based ``index:value`` pairs."""
    df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features")).write.format(
        "libsvm"
    ).save(path)


def read_libsvm(spark: SparkSession, path: str, size: int | None = None) -> DataFrame:
    """Label and vector; ``size`` saves a pass over the file."""
    reader = spark.read.format("libsvm")
    if size is not None:
        reader = reader.option("numFeatures", str(size))
    return reader.load(path)
