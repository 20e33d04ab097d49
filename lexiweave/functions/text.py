"""Column expressions that turn text into words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fields import drop_empty

WORD_BREAK = r"[^\p{L}\p{N}]+"
# Two ranges that cover all Han characters and little else; a cheap first test.
MAY_HOLD_HAN = r"[\u2E80-\uFAFF\x{16FE0}-\x{3FFFF}]"
# A Han character with its successor, the last one of a run, or a single one.
HAN_STEP = r"(\p{IsHan})(?=(\p{IsHan}))|(?<=\p{IsHan})\p{IsHan}|(\p{IsHan})"


def words(text: Column) -> Column:
    """Lower-cased words in order; runs of Han characters become character bigrams.

    A run ``ABC`` is rewritten to ``AB BC`` before the split, so the whole
    expression is code-generated; texts without such runs skip the rewriting.
    """
    lowered = F.lower(text)
    spaced = F.regexp_replace(lowered, HAN_STEP, " $1$2$3 ")
    prepared = F.when(F.rlike(text, F.lit(MAY_HOLD_HAN)), spaced).otherwise(lowered)
    return drop_empty(F.split(prepared, WORD_BREAK))


def blank_split(text: Column) -> Column:
    """Lower-cased parts between single blanks: inner empty parts stay, trailing ones go."""
    return F.split(F.regexp_replace(F.lower(text), r"\s+$", ""), r"\s")
