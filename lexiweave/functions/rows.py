"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(df: DataFrame, keep: list, items: Column | str, out: str = "term") -> DataFrame:
    """Columns ``keep`` with one row per item of an array without nulls.

    A plain ``explode`` adds a filter on the size of the array, which evaluates a
    computed array a second time; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(items).alias(out)).where(F.col(out).isNotNull())
