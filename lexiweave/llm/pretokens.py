"""Pieces of text as a byte-level BPE tokenizer cuts them, found for a whole slice at once.

The pieces are those of the pattern that goes with the rank files: contractions, runs of letters,
of digits and of other characters with one optional space before them, and runs of white space,
of which the last character is left to what follows. Characters are classed once by Unicode
category, pieces are then boundaries between classes.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from lexiweave.llm.batches import scramble, span_hashes, text_slices

_OTHER, _LETTER, _NUMBER, _SPACE, _UNKNOWN = 0, 1, 2, 3, 255
_classes = np.full(0x110000, _UNKNOWN, np.uint8)
# The characters with the White_Space property.
_WHITE = {*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}


def _class_of(code: int) -> int:
    if code in _WHITE:
        return _SPACE
    kind = unicodedata.category(chr(code))[0]
    return {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)


def classes(codes: np.ndarray) -> np.ndarray:
    """Class of every code point."""
    found = _classes[codes]
    if (found == _UNKNOWN).any():
        for code in np.unique(codes[found == _UNKNOWN]).tolist():
            _classes[code] = _class_of(code)
        found = _classes[codes]
    return found


def piece_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First code point of every piece; ``offsets`` bound the texts inside ``codes``."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes(codes)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = edge.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    # The last of a run of white space belongs to what follows, as its first character or alone.
    last = (kind == _SPACE) & start[1:] & ~edge[1:]
    at = np.flatnonzero(last)
    start[at] = True
    start[at[codes[at] == 32] + 1] = False
    # Contractions: an apostrophe that opens a piece and stands directly before letters.
    quote = np.flatnonzero((codes == 39) & start[:n])
    quote = quote[(quote + 1 < n)]
    quote = quote[(kind[quote + 1] == _LETTER) & ~edge[quote + 1]]
    if len(quote):
        one = codes[quote + 1]
        two = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], codes[np.minimum(quote + 2, n - 1)], 0)
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        length = np.where(single, 1, np.where(double, 2, 0))
        hit = quote[length > 0]
        start[hit + 1] = False
        start[hit + 1 + length[length > 0]] = True
    return np.flatnonzero(start[:n])


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, str]:
    """Code points of the joined texts, their offsets, and the joined text."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=offsets[1:])
    return codes, offsets, joined


class PieceTable:
    """Rows of integers for distinct pieces, computed once per worker and found by hash.

    ``make`` gives the rows for a list of new pieces. The table starts anew when it holds
    ``max_pieces``, so the memory of a worker is bounded; results never depend on that.
    """

    def __init__(self, make: Callable[[list[str]], list[np.ndarray]], dtype: type, max_pieces: int = 1 << 20):
        self.make, self.dtype, self.max_pieces = make, dtype, max_pieces
        self._reset()

    def _reset(self) -> None:
        self.count = 0
        # Hashes in order with the numbers of their rows: all but the latest, and the latest.
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        self.places = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.values = np.zeros(1 << 16, self.dtype)
        self.bounds = np.zeros(1 << 12, np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Row numbers of ordered hashes, -1 for new ones."""
        found = np.full(len(hashes), -1, np.int64)
        for keys, places in zip(self.keys, self.places, strict=True):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                found = np.where(keys[at] == hashes, places[at], found)
        return found

    def _remember(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Add ordered new hashes to the latest ones, and those to all others when they are many."""
        for level in (1, 0):
            keys = np.concatenate([self.keys[level], hashes])
            order = np.argsort(keys, kind="stable")
            self.keys[level] = keys[order]
            self.places[level] = np.concatenate([self.places[level], numbers.astype(np.int32)])[order]
            if level == 0 or len(keys) < 1 << 16:
                return
            hashes, numbers = self.keys[1], self.places[1]
            self.keys[1], self.places[1] = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def look_up(
        self, joined: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(first value, number of values) of every piece, as positions in ``values``."""
        if ends is None:
            ends = np.append(starts[1:], len(codes))
        symbols = scramble(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        hashes, first, back = np.unique(span_hashes(symbols, starts, ends), return_index=True, return_inverse=True)
        if self.count + len(hashes) > self.max_pieces and self.count:
            self._reset()
        slots = self._find(hashes)
        new = np.flatnonzero(slots < 0)
        if len(new):
            rows = self.make([joined[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            slots[new] = self._store(hashes[new], rows)
        slots = slots[back]
        return self.bounds[slots], self.bounds[slots + 1] - self.bounds[slots]

    def _store(self, hashes: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        count = self.count
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        stop = self.bounds[count] + np.cumsum(lengths)
        while len(self.bounds) < count + len(rows) + 1:
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        while len(self.values) < stop[-1]:
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[self.bounds[count] : stop[-1]] = np.concatenate(rows)
        self.bounds[count + 1 : count + 1 + len(rows)] = stop
        numbers = np.arange(count, count + len(rows))
        self._remember(hashes, numbers)
        self.count += len(rows)
        return numbers


def gather(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenate values[first : first + count] of all rows."""
    total = int(counts.sum())
    skip = np.cumsum(counts) - counts
    return values[np.arange(total) + np.repeat(first - skip, counts)]


def text_groups(column: pa.Array, limit: int = 1 << 19) -> Iterator[list[str]]:
    """Texts of a column in lists of at most ``limit`` bytes, or one longer text; null is empty."""
    for first, end, _, _ in text_slices(column, limit):
        yield [x or "" for x in column.slice(first, end - first).to_pylist()]
