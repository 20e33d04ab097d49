"""Exact token counts of every prefix of a text, by dynamic programming.

Within a piece, the encoding of a prefix ends in exactly one token whose neighbour on the left is the
last token of the encoding of what is before it. So one pass over the bytes gives the last token and
the count of every prefix from those of shorter ones. Distinct pieces are worked out once per worker,
and a text adds the counts of its pieces up. Where a cut changes the pieces themselves, in runs of white
space and in contractions, the count is that of the pieces of the cut text.

A text's counts answer questions on budgets and truncation without encoding again.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiweave.llm.pretokens import PieceTable, classes, code_points, gather, piece_starts, text_groups

LIMIT = 1024
_SPACE = 3
_counters: dict[str, PrefixCounter] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next free one."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(shown))
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class PrefixCounter:
    """Prefix counts by the vocabulary and merges of a byte-level tokenizer file."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        back = {c: b for b, c in enumerate(self.letters)}
        self.model = tokenizer.model
        self.vocab = {}
        for word, number in tokenizer.get_vocab(with_added_tokens=False).items():
            if all(c in back for c in word):
                self.vocab[bytes(back[c] for c in word)] = number
        self.words = {n: w for w, n in self.vocab.items()}
        self.longest = max(map(len, self.vocab))
        self.special = [x.content for x in tokenizer.get_added_tokens_decoder().values()]
        self.split = re.compile("|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.stand: dict[int, bool] = {}
        self.table = PieceTable(self._counts_of, np.int32)

    @classmethod
    def of(cls, path: str) -> PrefixCounter:
        if path not in _counters:
            _counters[path] = cls(path)
        return _counters[path]

    def _stand_together(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is these two tokens; left -1: of the right one alone."""
        key = (left << 32) | right
        known = self.stand.get(key)
        if known is None:
            both = (self.words[left] if left >= 0 else b"") + self.words[right]
            found = [x.id for x in self.model.tokenize("".join(self.letters[b] for b in both))]
            known = found == ([left, right] if left >= 0 else [right])
            if len(self.stand) >= 1 << 20:
                self.stand.clear()
            self.stand[key] = known
        return known

    def piece_counts(self, piece: bytes) -> tuple[list[int], list[int]]:
        """Last token and number of tokens of every byte prefix of a piece, from the empty one on."""
        vocab, longest, stand = self.vocab, self.longest, self.stand
        last, counts = [-1], [0]
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - longest), end):
                token = vocab.get(piece[start:end])
                if token is None:
                    continue
                left = last[start]
                known = stand.get((left << 32) | token)
                if known or known is None and self._stand_together(left, token):
                    last.append(token)
                    counts.append(counts[start] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return last, counts

    def _counts_of(self, pieces: list[str]) -> list[np.ndarray]:
        rows = []
        for piece in pieces:
            if piece in ("'re", "'ve", "'ll"):
                # Cut after two characters, the apostrophe and the letter are two pieces.
                rows.append(np.array([1, 2, self.piece_counts(piece.encode())[1][-1]], np.int32))
                continue
            raw = piece.encode()
            counts = np.array(self.piece_counts(raw)[1][1:], np.int32)
            if len(raw) != len(piece):
                data = np.frombuffer(raw, np.uint8)
                ends = np.append((data[1:] & 0xC0) != 0x80, True)
                counts = counts[ends]
            rows.append(counts)
        return rows

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts after every code point of all texts in one array, and the offsets of the texts."""
        codes, offsets, joined = code_points(texts)
        starts = piece_starts(codes, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), offsets
        first, length = self.table.look_up(joined, codes, starts)
        inside = gather(self.table.values, first, length).astype(np.int64)
        whole = self.table.values[first + length - 1].astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(whole)])
        text = np.searchsorted(offsets, starts, side="right") - 1
        base = sums[:-1] - sums[np.searchsorted(starts, offsets[text])]
        counts = inside + np.repeat(base, length)
        # A cut behind the last of several white-space characters leaves one run.
        kind = classes(codes)
        at = np.flatnonzero((kind[starts] == _SPACE) & (np.arange(len(starts)) > 0))
        at = at[(text[at] == text[at - 1]) & (kind[starts[at] - 1] == _SPACE)]
        if len(at):
            # The look-up may start the table anew, so everything above is taken from it before.
            begin, run = self.table.look_up(joined, codes, starts[at - 1], starts[at] + 1)
            counts[starts[at]] = base[at - 1] + self.table.values[begin + run - 1]
        return counts, offsets

    def counts(self, texts: list[str]) -> list[np.ndarray]:
        """Token counts of the prefixes of every text, from the empty one to the whole."""
        marked = [bool(self.special) and self.split.search(x) is not None for x in texts]
        flat, offsets = self.plain(["" if m else x for m, x in zip(marked, texts, strict=True)])
        rows = [np.concatenate([[0], flat[a:b]]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        for k in (k for k, m in enumerate(marked) if m):
            rows[k] = self._marked(texts[k])
        return rows

    def _marked(self, text: str) -> np.ndarray:
        """Counts for a text with added tokens: plain text up to their last character, then one token."""
        found, at, total, parts = list(self.split.finditer(text)), 0, 0, [np.zeros(1, np.int64)]
        for m in found:
            counts, _ = self.plain([text[at : m.end() - 1]])
            before = m.start() - at
            start = total + (int(counts[before - 1]) if before else 0)
            parts += [counts + total, np.array([start + 1])]
            at, total = m.end(), start + 1
        parts.append(self.plain([text[at:]])[0] + total)
        return np.concatenate(parts)


def stored(counts: np.ndarray) -> bytes:
    """Prefix counts as compressed differences."""
    return zlib.compress(np.diff(counts).astype("<i4").tobytes(), 1)


def restored(data: bytes) -> np.ndarray:
    """The prefix counts that :func:`stored` holds."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(zlib.decompress(data), "<i4"))])


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Most code points whose text has at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def token_counts(
    docs: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    with_prefixes: bool = False,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, limit_chars[, prefix_counts]) of every row.

    ``limit_chars`` is the length of the longest prefix of at most ``limit`` tokens. ``prefix_counts``
    holds the count at every prefix, see :func:`restored`. Null and empty texts have no tokens. Rows with
    null or repeated ids are counted like others, and an empty table gives an empty result.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    names = [id_col, "n_bytes", "n_tokens", "over_limit", "limit_chars", *["prefix_counts"] * with_prefixes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter.of(path)
        for batch in batches:
            at = 0
            for texts in text_groups(batch.column(1)):
                rows = counter.counts(texts)
                total = np.array([int(x[-1]) for x in rows], np.int64)
                columns = [
                    batch.column(0).slice(at, len(texts)),
                    pa.array([len(x.encode()) for x in texts], pa.int64()),
                    pa.array(total),
                    pa.array(total > limit),
                    pa.array([longest_prefix(x, limit) for x in rows], pa.int64()),
                ]
                if with_prefixes:
                    columns.append(pa.array([stored(x) for x in rows], pa.binary()))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean, limit_chars long"
    schema += ", prefix_counts binary" * with_prefixes
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def budget_prefixes(counted: DataFrame, budgets: Sequence[int], id_col: str = "doc_id") -> DataFrame:
    """(id, budget, chars) from stored ``prefix_counts``: the longest prefix of at most ``budget`` tokens.

    Nothing is encoded again. One row per row of ``counted`` and budget; an empty text has 0.
    """
    asked = list(budgets)
    names = [id_col, "budget", "chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data in batch.column(1).to_pylist():
                counts = restored(data)
                found += [longest_prefix(counts, b) for b in asked]
            rows = pa.array(np.repeat(np.arange(batch.num_rows), len(asked)))
            wanted = np.tile(np.array(asked, np.int64), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(wanted), pa.array(found, pa.int64())], names)

    kind = counted.schema[id_col].dataType.simpleString()
    return counted.select(F.col(id_col), "prefix_counts").mapInArrow(run, f"`{id_col}` {kind}, budget long, chars long")
