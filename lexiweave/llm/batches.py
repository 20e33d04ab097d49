"""Helpers for Arrow batches of texts: byte arrays, words and hashes of spans.

Everything works on whole texts of one slice of a batch at a time. A slice holds at
most ``SLICE_BYTES`` of text, or one text if that is longer, so the memory of a task
is bounded by the longest text and not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiweave.runtime import materialize

SLICE_BYTES = 1 << 20

# A fixed odd multiplier for span hashes and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOLS = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def held_out(doc_id: Column) -> Column:
    """Rows kept away from training: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def drawn(df: DataFrame, digest: Column, size: int, total: int) -> DataFrame:
    """About ``size`` of ``total`` rows, chosen by a hash, and never more than twice as many.

    The rate is set before rows are read, so a task gives its share and not ``size`` rows.
    """
    rate = min(1.0, size / max(total, 1))
    chosen = F.pmod(F.xxhash64(digest, F.lit(3)), F.lit(1 << 30)) < int(rate * (1 << 30))
    return df.where(chosen).limit(2 * size)


def _table(length: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < length:
        size = max(length, SLICE_BYTES + 1)
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers, _inverses


def scramble(x: np.ndarray) -> np.ndarray:
    """Mix the bits of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of unsigned 64-bit symbols, by prefix sums."""
    powers, inverses = _table(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers[: len(symbols)], out=sums[1:])
    return scramble((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def byte_symbols(data: np.ndarray) -> np.ndarray:
    """A fixed random 64-bit symbol for every byte."""
    return _SYMBOLS[data]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) of slices of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    count = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + count + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < count:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), count)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that are not ASCII white space: starts, ends, and the first word of each text.

    The third array has one entry more than there are texts.
    """
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(IS_SPACE[data], out=inside[:-1])
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    begins[cuts] |= inside[cuts]
    starts = np.flatnonzero(begins)
    stops = np.zeros(len(data) + 1, bool)
    stops[1:] = inside[:-1] & ~inside[1:]
    stops[cuts] |= inside[cuts - 1] & (cuts > 0)
    ends = np.flatnonzero(stops)
    return starts, ends, np.searchsorted(starts, offsets)


# Bytes of letters and digits, with all of UTF-8 beyond ASCII, and bytes that end a sentence.
_CORE = np.zeros(256, bool)
_CORE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?:;"]] = True


def cores(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words without punctuation around them: which words have a core, and its start and end."""
    n = len(data)
    place = np.arange(n)
    ahead = np.minimum.accumulate(np.where(_CORE[data], place, n)[::-1])[::-1]
    behind = np.maximum.accumulate(np.where(_CORE[data], place, -1))
    solid = np.flatnonzero(ahead[starts] < ends) if len(starts) else np.zeros(0, np.int64)
    return solid, ahead[starts[solid]], behind[ends[solid] - 1] + 1


def openings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a word opens a sentence: first of its text, after a stop or on a new line."""
    lines = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=lines[1:])
    opens = np.ones(len(starts), bool)
    opens[1:] = (text[1:] != text[:-1]) | _STOPS[data[ends[:-1] - 1]] | (lines[starts[1:]] > lines[starts[:-1]])
    return opens


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and the Latin-1 letters of UTF-8 text."""
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    low[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    return low


def char_places(data: np.ndarray) -> np.ndarray:
    """Code points before every byte, and before the end."""
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=place[1:])
    return place


def fresh(name: str, columns: list[str]) -> str:
    """A column name that is not in use."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut so that no group of the first ``n_keys`` columns is split."""
    rest: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        last = np.ones(len(columns[0]), bool)
        for c in columns[:n_keys]:
            last &= c == c[-1]
        cut = len(last) - int(last.sum())
        joined = rest and all(c[0] == r[-1] for c, r in zip(columns[:n_keys], rest[-1][:n_keys], strict=True))
        if cut == 0 and joined:
            rest.append(columns)
            continue
        if cut or rest:
            head = [c[:cut] for c in columns]
            yield [np.concatenate(x) for x in zip(*rest, head, strict=True)]
        rest = [[c[cut:] for c in columns]]
    if rest:
        yield [np.concatenate(x) for x in zip(*rest, strict=True)]


def one_row_per_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with one row of those that repeat an id; a table without such rows is not moved.

    Of different texts under one id the one with the smallest hash stays, whenever this is worked out.
    """
    repeated = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col)
    repeated = materialize(repeated, "repeated")
    if repeated.isEmpty():
        return docs
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = docs.join(repeated, id_col, "left_anti").select(*columns)
    row = fresh("_row", docs.columns)
    first = F.min_by(F.struct(*columns), F.xxhash64(text_col)).alias(row)
    chosen = docs.join(repeated, id_col, "left_semi").groupBy(id_col).agg(first).select(f"{row}.*")
    return single.unionByName(chosen)
