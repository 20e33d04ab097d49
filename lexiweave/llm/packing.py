"""Best-fit packing of token sequences with a two-for-one exchange.

Texts become token ids and an end id. A longer sequence is cut into full pieces behind one shorter
first piece. Pieces are dealt into groups by a hash of their document, so a group has a bounded
number of pieces whatever the input, and each group fills its sequences greedily with the longest
pieces that fit. Before a sequence is closed, its smallest piece is exchanged for the two unpacked
pieces that fill the widened gap more tightly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiweave.llm.pretokens import PieceTable, code_points, gather, piece_starts, text_groups
from lexiweave.runtime import materialize

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 1 << 15

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Token ids of whole texts by a byte-level tokenizer file; each distinct piece is encoded once."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {x.content: i for i, x in self.tokenizer.get_added_tokens_decoder().items()}
        self.table = PieceTable(self._encode, np.uint32)

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _encode(self, pieces: list[str]) -> list[np.ndarray]:
        return [np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, np.uint32) for x in pieces]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of every text."""
        special = [any(s in x for s in self.special) for x in texts]
        codes, offsets, joined = code_points(["" if s else x for s, x in zip(special, texts, strict=True)])
        starts = piece_starts(codes, offsets)
        first, counts = self.table.look_up(joined, codes, starts) if len(starts) else (starts, starts)
        flat = gather(self.table.values, first, counts)
        sums = np.concatenate([[0], np.cumsum(counts)])
        per_text = np.diff(sums[np.searchsorted(starts, offsets)])
        if not any(special):
            return flat, per_text
        # Texts that hold the string of an added token are left to the library as they are.
        rows = np.split(flat, np.cumsum(per_text)[:-1])
        for k in np.flatnonzero(special):
            rows[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, np.uint32)
        return np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))


def token_pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every text; null and empty texts are one end id."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            at = 0
            for texts in text_groups(batch.column(1)):
                flat, counts = encoder.ids(texts)
                # One end id after every text.
                flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
                total = counts + 1
                stop = np.cumsum(total)
                n_pieces = -(-total // capacity)
                row = np.repeat(np.arange(len(texts)), n_pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                head = (total - (n_pieces - 1) * capacity)[row]
                start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
                length = np.where(piece == 0, head, capacity)
                begin = (stop - total)[row] + start
                cuts = list(zip(begin.tolist(), (begin + length).tolist(), strict=True))
                sums = [zlib.crc32(flat[a:b]) for a, b in cuts]
                columns = [
                    batch.column(0).slice(at, len(texts)).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([flat[a:b].tolist() for a, b in cuts], pa.list_(pa.int64())))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


class _Stock:
    """Unpacked pieces by length: how many are left, and the longest that fits a gap."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        order = np.argsort(lengths, kind="stable")
        self.order = order
        counts = np.bincount(lengths, minlength=capacity + 1)
        self.next = np.cumsum(counts) - counts
        self.left = counts.tolist()
        self.open = np.flatnonzero(counts)
        self.fits = np.zeros(capacity + 1, np.int64)
        self._index()

    def _index(self) -> None:
        self.fits[:] = 0
        self.fits[self.open] = self.open
        np.maximum.accumulate(self.fits, out=self.fits)

    def take(self, length: int) -> int:
        row = int(self.order[self.next[length]])
        self.next[length] += 1
        self.left[length] -= 1
        if not self.left[length]:
            self.open = self.open[self.open != length]
            below = self.fits[length - 1]
            stop = int(np.searchsorted(self.open, length))
            stop = int(self.open[stop]) if stop < len(self.open) else len(self.fits)
            self.fits[length:stop] = below
        return row

    def give_back(self, length: int) -> None:
        self.next[length] -= 1
        self.left[length] += 1
        if self.left[length] == 1:
            self.open = np.sort(np.append(self.open, length))
            self._index()

    def best_pair(self, room: int) -> tuple[int, int]:
        """Two unpacked lengths with the largest sum up to ``room``; zeros if there are none."""
        longer = self.open[self.open < room]
        if not len(longer):
            return 0, 0
        shorter = self.fits[np.minimum(room - longer, longer)]
        # The same length twice needs two pieces of it.
        twice = shorter == longer
        if twice.any():
            short = twice & (np.array([self.left[x] for x in longer.tolist()]) < 2)
            shorter = np.where(short, self.fits[longer - 1], shorter)
        sums = np.where(shorter > 0, longer + shorter, 0)
        k = int(sums.argmax())
        return (int(longer[k]), int(shorter[k])) if sums[k] else (0, 0)


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and place of every length from 1 to ``capacity``, by best-two-fit."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stock, number, left = _Stock(lengths, capacity), 0, len(lengths)
    while left:
        held: list[tuple[int, int]] = []
        room = capacity
        while room and (length := int(stock.fits[room])):
            held.append((length, stock.take(length)))
            room -= length
        if room:
            smallest, row = held[-1]
            a, b = stock.best_pair(room + smallest)
            if a + b > smallest:
                held.pop()
                pair = [(a, stock.take(a)), (b, stock.take(b))]
                # The replaced piece is the last one taken of its length.
                stock.order[stock.next[smallest] - 1] = row
                stock.give_back(smallest)
                held += pair
        at = 0
        for length, row in held:
            sequence[row], offset[row] = number, at
            at += length
        number += 1
        left -= len(held)
    return sequence, offset


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all texts into sequences of at most ``capacity`` tokens.

    One row per piece: (id, piece, start, length, ids_crc32[, ids], sequence_id, offset). Null and
    empty texts are one piece of the end id. Rows with a null or a repeated id are packed like
    others; an empty table gives no sequences. Groups hold about ``group_pieces`` pieces and each
    leaves at most a few unfilled sequences.
    """
    pieces = token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids)
    pieces = materialize(pieces, "pieces")
    n_groups = max(1, -(-pieces.count() // group_pieces))
    group = F.pmod(F.xxhash64("id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(n_groups))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = pack_lengths(frame["length"].to_numpy(), capacity)
        return frame.assign(sequence_id=frame["group"] * (1 << 24) + sequence, offset=offset).drop(columns="group")

    fields = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in pieces.schema)
    packed = pieces.withColumn("group", group).groupBy("group").applyInPandas(run, f"{fields}, sequence_id long, offset long")
    return packed.withColumnRenamed("id", id_col)
