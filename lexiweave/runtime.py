"""Shared plumbing: stored tables, size-checked joins and distributed numbering.

Every helper keeps the rows on the executors. The only values that reach the
driver are row counts and byte counts. Stored tables are left for the folder's own
clean-up, since a returned DataFrame may still read them; those of a loop that are
read for the last time inside it are released.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup table is broadcast only if its measured size is below this bound.
BROADCAST_BYTES = 8 * 1024 * 1024
# Whether the shuffle files of a query are removed at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """Folder for stored intermediate tables that all executors share.

    It is the one in ``spark.checkpoint.dir``, else a folder in the session's warehouse. Nothing is set
    on the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stored"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch root that nobody has used yet."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", schema: T.StructType | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the optimizer
    the true size of the table. ``schema`` overrides the schema on read. The shuffle
    files of the write go with its end, so they do not add up over the tables of a job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    stored = spark.read.schema(schema or df.schema).parquet(path)
    stored._is_stored = True
    stored._stored_path = path
    return stored


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are removed when it has ended; then the session is as before."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def release(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more, also none of the DataFrames that are returned."""
    for one in tables:
        path = one.sparkSession._jvm.org.apache.hadoop.fs.Path(one._stored_path)
        path.getFileSystem(one.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def task_count(spark: SparkSession) -> int:
    """Tasks for a stage whose input is small but whose work is large."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )


def _row_bytes(schema: T.StructType) -> Column:
    size = F.lit(24)
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            size = size + F.coalesce(F.octet_length(F.to_json(F.col(field.name))), F.lit(0))
        else:
            size = size + F.lit(8)
    return size


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` and tell whether it may be broadcast."""
    measured = df.agg(F.sum(_row_bytes(df.schema).cast("long")).alias("bytes")).first()["bytes"]
    return (measured or 0) <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join rows to a table with one row or few rows per key, whatever its size.

    ``right`` is stored unless it is a stored table already, so that it is worked out once, and then
    measured: small tables are broadcast and ``left`` is not shuffled at all; larger ones are shuffled.
    """
    stored = right if getattr(right, "_is_stored", False) else materialize(right, "lookup")
    return keyed_join(left, stored, on, spread_by, fits_broadcast(stored, max_bytes), how)


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    small: bool,
    how: str = "inner",
) -> DataFrame:
    """:func:`lookup_join` for a stored table whose size was measured before.

    The shuffled join reads ``left`` once. As both sides come straight from a shuffle, adaptive execution
    splits the rows of a hot key among tasks and gives each of them the few rows of the other side.
    ``spread_by`` names columns that tell the rows of a key apart, for the reader of the call.
    """
    return left.join(F.broadcast(right) if small else right, list(on), how)


def spread_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    combine,
    out: str,
) -> DataFrame:
    """Append a per-key aggregate to every row without gathering a key in one task.

    The rows are stored once. Partial aggregates are what is shuffled per key, and the totals are a stored
    table that is joined back, so adaptive execution can split a hot key.
    """
    stored = materialize(df, "rows")
    totals = materialize(stored.groupBy(*keys).agg(combine(value).alias(out)), "totals")
    return stored.join(totals, list(keys))


def dense_index(
    df: DataFrame,
    order_by: Sequence[Column],
    out: str = "idx",
    within: Sequence[str] = (),
) -> DataFrame:
    """Number rows 0, 1, 2, ... in a total order, without a one-task window.

    The rows are range-partitioned, sorted and stored once; a position is the
    offset of its partition plus its rank inside. With ``within`` (the leading
    order columns) numbering restarts in each group.
    """
    ordered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    return _number(materialize(ordered, "ordered"), out, within)


def _number(stored: DataFrame, out: str, within: Sequence[str] = ()) -> DataFrame:
    # One row per task of the stored table, so the window and the broadcast are
    # bounded by the number of shuffle partitions.
    parts = stored.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    numbered = stored.join(F.broadcast(offsets), "_part").withColumn(
        out, F.col("_offset") + F.col("_seq") - F.col("_first")
    )
    if within:
        first = numbered.groupBy(*within).agg(F.min(out).alias("_start"))
        numbered = lookup_join(numbered, first, within, ["_seq"]).withColumn(
            out, F.col(out) - F.col("_start")
        ).drop("_start")
    return numbered.drop("_part", "_seq", "_first", "_offset")
