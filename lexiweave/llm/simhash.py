"""SimHash near-dedup: a byte-position inverted index with count filtering.

A fingerprint is 64 bits, one per position of the hashes of the word shingles of a text. Two
fingerprints with at most ``max_bits`` differing bits differ in at most ``max_bits`` of their eight
bytes, so they share at least ``8 - max_bits`` bytes at the same positions. Posting lists are kept
for combinations of byte positions of which every pair with that many matches must share one. The
pairs of a posting list tally their shared positional bytes, those that reach the guaranteed
minimum are verified by counting differing bits. Linked ids leave a task as a star, never as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiweave.llm.batches import one_row_per_id, whole_groups
from lexiweave.llm.components import components
from lexiweave.llm.tiles import BLOCK_ROWS, block_counts, in_tiles
from lexiweave.runtime import materialize, task_count

SHINGLE_WORDS = 4
MAX_BITS = 4
# Rows of the matrix that compares two blocks at a time.
_STRIPE = 256
# Tiles with at most this many rows are compared together, without a matrix each.
_SMALL = 64
_SUM_ROWS = 1 << 14


def fingerprint_of(data: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a UTF-8 text: words are split at ASCII white space, A-Z lower-cased."""
    parts = data.lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(parts) <= shingle_words:
        hashes = [digest(b" ".join(parts), 42)]
    else:
        joined = b" ".join(parts)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.cumsum(lengths + 1) - lengths - 1
        first = starts[: len(parts) - shingle_words + 1]
        last = (starts + lengths)[shingle_words - 1 :]
        hashes = [digest(joined[s:e], 42) for s, e in zip(first.tolist(), last.tolist(), strict=True)]
    values = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), _SUM_ROWS):
        bits = np.unpackbits(values[at : at + _SUM_ROWS].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(values)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fingerprint long) for every row; null and empty texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = np.fromiter(
                (fingerprint_of(x.as_py() or b"", shingle_words) for x in texts.cast(pa.binary())), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, fingerprint long")


def position_sets(max_bits: int, key_bytes: int = 2) -> list[tuple[int, ...]]:
    """Byte positions of the posting lists: every 8 - max_bits positions contain one of the sets.

    Positions are dealt into groups; by the pigeonhole principle one group holds at least
    ``key_bytes`` of the shared positions if there are few enough groups.
    """
    shared = 8 - max_bits
    if shared < 1:
        raise ValueError("max_bits must be below 8")
    key_bytes = min(key_bytes, shared)
    n_groups = max(1, (shared - 1) // (key_bytes - 1)) if key_bytes > 1 else 1
    if key_bytes == 1:
        return [(p,) for p in range(max_bits + 1)]
    groups = [range(g, 8, n_groups) for g in range(n_groups)]
    return [c for g in groups for c in combinations(g, key_bytes)]


def _star(a: np.ndarray, b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that every row of two blocks reaches over the links between them."""
    label_a, label_b = ids_a.copy(), ids_b.copy()
    while True:
        before = int(label_a.sum()) + int(label_b.sum())
        for at in range(0, len(a), _STRIPE):
            differ = a[at : at + _STRIPE, None] ^ b[None, :]
            i, j = np.nonzero(shared_bytes(differ) >= 8 - max_bits)
            good = np.bitwise_count(differ[i, j]) <= max_bits
            _spread(label_a, label_b, i[good] + at, j[good])
        if int(label_a.sum()) + int(label_b.sum()) == before:
            return label_a, label_b


def links(prints: DataFrame, max_bits: int = MAX_BITS, key_bytes: int = 2, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b) stars over linked fingerprints; ``prints`` has one row per (node, fingerprint).

    Within a bucket and within a tile each linked node is paired with the smallest node that it
    reaches there, so at most two rows per member leave a tile.
    """
    sets = position_sets(max_bits, key_bytes)
    value = F.col("fingerprint")

    def byte(p: int):
        return F.shiftrightunsigned(value, 56 - 8 * p).bitwiseAND(F.lit(255))

    keys = []
    for number, positions in enumerate(sets):
        key = F.lit(number).cast("long")
        for p in positions:
            key = key * 256 + byte(p)
        keys.append(key)
    posted = prints.select("node", "fingerprint", F.explode(F.array(*keys)).alias("key"))
    counts = materialize(block_counts(posted, "key", block_rows), "buckets")
    tiles = in_tiles(posted.join(counts, "key"), "key", "node")
    # Buckets are small on average, so a group call works through a pack of tiles.
    packs = max(task_count(prints.sparkSession) * 4, 1)
    pack = F.pmod(F.xxhash64("key", "tile_a", "tile_b"), F.lit(packs))
    packed = tiles.select("key", "tile_a", "tile_b", "block", "node", "fingerprint")
    return _linked(packed.repartition(packs, pack), max_bits).distinct()


def _linked(packed: DataFrame, max_bits: int) -> DataFrame:
    ordered = packed.sortWithinPartitions("key", "tile_a", "tile_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_groups(batches, 3):
            ids, labels = _batch_labels(columns, max_bits)
            moved = ids != labels
            if moved.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(labels[moved])], ["a", "b"])

    return ordered.mapInArrow(run, "a long, b long")


def _batch_labels(columns: list[np.ndarray], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    key, tile_a, tile_b, block, node, prints = columns
    prints = prints.view(np.uint64)
    change = (key[1:] != key[:-1]) | (tile_a[1:] != tile_a[:-1]) | (tile_b[1:] != tile_b[:-1])
    starts = np.concatenate([[0], np.flatnonzero(change) + 1])
    sizes = np.diff(np.append(starts, len(key)))
    labels = node.copy()
    # Pairs of all small tiles at once: row r of a tile meets the rows after it.
    small = (sizes <= _SMALL) & (tile_a[starts] == tile_b[starts])
    rows = np.flatnonzero(np.repeat(small, sizes))
    after = (np.repeat(starts + sizes, sizes)[rows] - rows - 1).astype(np.int64)
    for part in np.array_split(np.arange(len(rows)), max(1, int(after.sum()) >> 20)):
        i = np.repeat(rows[part], after[part])
        skip = np.cumsum(after[part]) - after[part]
        j = i + 1 + np.arange(len(i)) - np.repeat(skip, after[part])
        differ = prints[i] ^ prints[j]
        kept = shared_bytes(differ) >= 8 - max_bits
        i, j, differ = i[kept], j[kept], differ[kept]
        kept = np.bitwise_count(differ) <= max_bits
        _spread(labels, labels, i[kept], j[kept])
    for at in np.flatnonzero(~small).tolist():
        part = slice(starts[at], starts[at] + sizes[at])
        first = block[part] == tile_a[starts[at]]
        other = first if tile_a[starts[at]] == tile_b[starts[at]] else ~first
        label_a, label_b = _star(prints[part][first], prints[part][other], node[part][first], node[part][other], max_bits)
        mine = labels[part]
        mine[other] = np.minimum(mine[other], label_b)
        mine[first] = np.minimum(mine[first], label_a)
    return node, labels


def shared_bytes(differ: np.ndarray) -> np.ndarray:
    """Tally of the positions at which two fingerprints have the same byte, from their exclusive or."""
    low, high = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
    return 8 - np.bitwise_count((((differ & low) + low) | differ) & high).astype(np.int64)


def _spread(label_a: np.ndarray, label_b: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Carry the smallest label over links until nothing changes."""
    while len(i):
        least = np.minimum(label_a[i], label_b[j])
        np.minimum.at(label_a, i, least)
        np.minimum.at(label_b, j, least)
        open_ = label_a[i] != label_b[j]
        if not open_.any():
            break


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    key_bytes: int = 2,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, fingerprint string, component_id) of every row whose id is not null.

    ``component_id`` is the smallest id reachable over fingerprints with at most ``max_bits``
    differing bits. Rows with equal fingerprints are one node, whose number is their smallest id, so
    copies add no comparisons. Null and empty texts have fingerprint zero and link like others; a
    repeated id keeps its rows; an empty table gives an empty result. A larger ``key_bytes`` makes
    more and shorter posting lists, for very large inputs; the links are the same.
    """
    named = docs.where(F.col(id_col).isNotNull())
    prints = materialize(fingerprints(named, id_col, text_col, shingle_words).select(F.col("id").cast("long"), "fingerprint"), "prints")
    nodes = materialize(prints.groupBy("fingerprint").agg(F.min("id").alias("node")), "nodes")
    found = components(links(nodes, max_bits, key_bytes, block_rows))
    roots = materialize(
        nodes.join(found.withColumnRenamed("id", "node"), "node", "left").select(
            "fingerprint", F.coalesce("component_id", "node").alias("component_id")
        ),
        "roots",
    )
    # Both sides are stored tables, so adaptive execution can split a fingerprint with many copies.
    return prints.join(roots, "fingerprint").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id.

    Of rows that repeat an id one stays, unless all of them are near-duplicates of smaller ids. Rows with a
    null id cannot be named and stay.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    first = F.bool_or(F.col(id_col) == F.col("component_id")).alias("first")
    gone = materialize(found.groupBy(id_col).agg(first).where("not first").select(id_col), "gone")
    kept = docs.join(gone, id_col, "left_anti")
    return one_row_per_id(kept.select(*[F.col(f"`{c}`") for c in docs.columns]), id_col, text_col)
