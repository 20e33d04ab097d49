"""Column expressions for tagged records and delimited values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def extract_field(record: Column, tag: str) -> Column:
    """Text of the first ``<tag>...</tag>`` pair on one line; null if absent or empty."""
    return F.nullif(F.regexp_extract(record, f"<{tag}>(.*?)</{tag}>", 1), F.lit(""))


def class_flag(record: Column, marker: str) -> Column:
    """1 if the raw record holds the class marker, else 0."""
    return F.when(F.contains(record, F.lit(marker)), 1).otherwise(0)


def drop_empty(items: Column) -> Column:
    return F.array_remove(items, F.lit(""))


def split_values(value: Column, separator: str = ",") -> Column:
    """Delimited field as an array without empty items; null stays null."""
    return drop_empty(F.split(value, f"\\Q{separator}\\E"))


def profile_tag_array(
    record: Column,
    single: Sequence[str] = ("age", "sex", "area"),
    multi: Sequence[str] = ("group", "collection"),
    separator: str = ",",
) -> Column:
    """All tags of a profile record in field order; missing fields add nothing."""
    ones = F.array(*[extract_field(record, tag) for tag in single])
    lists = [
        F.coalesce(split_values(extract_field(record, tag), separator), F.array().cast("array<string>"))
        for tag in multi
    ]
    return F.array_compact(F.concat(ones, *lists))


def parse_group_id(path: Column) -> Column:
    """Last segment of a path, without a ``.txt`` ending."""
    return F.regexp_extract(path, r"([^/]+?)(\.txt)?$", 1)


def contains_term(text: Column, term: Column) -> Column:
    return F.contains(text, term)


def contains_both(text: Column, first: Column, second: Column) -> Column:
    return F.contains(text, first) & F.contains(text, second)
