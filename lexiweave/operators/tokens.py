"""From documents to words. Token tables have the columns (keys..., term)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rows import explode_once
from ..functions.text import blank_split, words
from ..runtime import lookup_join


def tokenize(df: DataFrame, text: str = "text", out: str = "terms") -> DataFrame:
    """Replace the text column by the array of its words."""
    return df.withColumn(out, words(F.col(text))).drop(text)


def whitespace_tokenize(df: DataFrame, text: str = "text", out: str = "terms") -> DataFrame:
    """Replace the text by its lower-cased parts between single blanks."""
    return Tokenizer(inputCol=text, outputCol=out).transform(df).drop(text)


def blank_tokenize(df: DataFrame, text: str = "text", out: str = "terms") -> DataFrame:
    """Same parts as :func:`whitespace_tokenize`, as a code-generated expression."""
    return df.withColumn(out, blank_split(F.col(text))).drop(text)


def explode_tokens(df: DataFrame, terms: str = "terms", position: bool = False) -> DataFrame:
    """One row per word, with its position on request."""
    keep = [F.col(c) for c in df.columns if c != terms]
    if position:
        return df.select(*keep, F.posexplode(terms).alias("pos", "term"))
    return explode_once(df, keep, terms)


def distinct_tokens(df: DataFrame, terms: str = "terms") -> DataFrame:
    """Each word once per record; works inside the row, without a shuffle."""
    return df.withColumn(terms, F.array_distinct(terms))


def keep_classes(
    tokens: DataFrame,
    lexicon: DataFrame,
    classes: Sequence[str],
    spread_by: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Keep words whose word class, looked up in ``lexicon(term, class)``, is wanted."""
    wanted = lexicon.where(F.col("class").isin(list(classes))).select("term").distinct()
    return lookup_join(tokens, wanted, ["term"], spread_by, how="left_semi")
