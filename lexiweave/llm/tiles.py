"""Compare the members of large buckets in tiles of bounded size.

A bucket is a set of rows that share a key. A small bucket is one tile. A large one is cut into
blocks by a hash of the row id, and every pair of blocks is a tile, so no task ever holds more
than two blocks of a bucket. Pairs are compared inside the tile and are not emitted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
# Packs of small buckets that one group call works through.
PACKS = 1 << 20


def block_counts(df: DataFrame, key: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, n_blocks) of the buckets with at least two rows."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(key, F.ceil(F.col("n") / block_rows).cast("int").alias("n_blocks"))
    )


def in_tiles(df: DataFrame, key: str, row: str) -> DataFrame:
    """Copy rows with ``n_blocks`` to the tiles they take part in: adds ``block`` and ``tile_a``, ``tile_b``.

    A row of block i goes to the tiles (j, i) for j up to i and (i, j) for j above, so every pair of
    rows of a bucket meets in exactly one tile.
    """
    block = F.pmod(F.xxhash64(F.lit(7), F.col(row)), F.col("n_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    return (
        df.withColumn("block", block)
        .withColumn("_other", other)
        .withColumn("tile_a", F.least("block", "_other"))
        .withColumn("tile_b", F.greatest("block", "_other"))
        .drop("_other")
    )
