"""Document fingerprints: SimHash of weighted terms, and block tables that find near fingerprints.

Terms of a text are its words and pairs of following words. The hash of a term votes on every bit with the
weight of the term, for or against; the signs of the sums are the fingerprint of 256 bits.

Fingerprints with at most ``radius`` differing bits have at least one of ``radius + 1`` blocks of bits in
common. A table per block holds the fingerprints permuted so that the block comes first; those with the same
leading block are compared in tiles of bounded size. So all pairs within the radius are found, each in the
first table that both share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiweave.llm.batches import SLICE_BYTES, byte_symbols, fold_case, scramble, span_hashes, whole_groups, words
from lexiweave.llm.components import components
from lexiweave.llm.tiles import BLOCK_ROWS, block_counts, in_tiles
from lexiweave.runtime import materialize, task_count

BITS = 256
RADIUS = 8
# Weights of a word and of a pair of words that occur once.
WORD_WEIGHT = 1
PAIR_WEIGHT = 3
_STREAMS = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xBF58476D1CE4E5B9)
# Terms whose votes are added at a time; sums of their weights are exact in single precision.
_VOTES = 4096
# Leading bits of a block that are the key of its table.
_KEY_BITS = 40
# Pairs compared at a time.
_PAIRS = 1 << 18


def weighted_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term hash, weight) of the distinct terms of UTF-8 texts, in order of texts.

    A term that occurs f times weighs 1 + floor(log2(f)) times as much as one that occurs once.
    """
    low = fold_case(data)
    starts, ends, first = words(low, offsets)
    hashes = span_hashes(byte_symbols(low), starts, ends)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    together = text[1:] == text[:-1]
    pairs = scramble(hashes[:-1] * _PAIR + hashes[1:])[together]
    owner = np.concatenate([text, text[1:][together]])
    term = np.concatenate([hashes, pairs])
    weight = np.repeat([WORD_WEIGHT, PAIR_WEIGHT], [len(hashes), len(pairs)])
    order = np.lexsort((term, owner))
    owner, term, weight = owner[order], term[order], weight[order]
    new = np.ones(len(term), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(term)))
    return owner[at], term[at], weight[at] * np.frexp(times.astype(np.float64))[1]


def fingerprints_of(texts: list[bytes]) -> np.ndarray:
    """Fingerprints of UTF-8 texts as rows of bytes; a text without words has only zero bits."""
    found = np.zeros((len(texts), BITS // 8), np.uint8)
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
            size += len(texts[end])
            end += 1
        data = np.frombuffer(b"".join(texts[at:end]), np.uint8)
        offsets = np.zeros(end - at + 1, np.int64)
        np.cumsum([len(t) for t in texts[at:end]], out=offsets[1:])
        owner, term, weight = weighted_terms(data, offsets)
        bounds = np.searchsorted(owner, np.arange(end - at + 1))
        for k in range(end - at):
            found[at + k] = _signs(term[bounds[k] : bounds[k + 1]], weight[bounds[k] : bounds[k + 1]])
        at = end
    return found


def _signs(term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    votes = np.zeros(BITS)
    for at in range(0, len(term), _VOTES):
        streams = scramble(term[at : at + _VOTES, None] + _STREAMS)
        bits = np.unpackbits(streams.view(np.uint8).reshape(len(streams), -1), axis=1)
        votes += weight[at : at + _VOTES].astype(np.float32) @ bits.astype(np.float32)
    return np.packbits(votes * 2 > weight.sum())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of fingerprints, row by row."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) / BITS


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROWS = (
    "part int, kind int, id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, text string"
)
_DONE, _HEAD, _TAIL = 0, 1, 2


def _answers(ids, texts: list[str], following: list[str], prints: np.ndarray, next_prints: np.ndarray) -> list[pa.Array]:
    """Columns from id to near_next of texts whose next texts are known."""
    changed = [edited(a, b).encode() for a, b in zip(texts, following, strict=True)]
    other = fingerprints_of(changed)
    return [
        ids,
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
        pa.array([p.tobytes().hex() for p in prints], pa.string()),
        pa.array([p.tobytes().hex() for p in other], pa.string()),
        pa.array(likeness(prints, other)),
        pa.array(likeness(prints, next_prints)),
    ]


def _in_order(ordered: DataFrame) -> DataFrame:
    """Answers for all but the last row of each task, and the first and last row of each task with its text."""
    kind = ordered.schema["id"].dataType.simpleString()
    names = [c.split()[0] for c in _ROWS.split(", ")]

    def marked(part: int, mark: int, one: pa.Array, text: str, shown: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(1, pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([mark], pa.int32()), one, pa.array([len(text)], pa.int64()), none,
             pa.array([shown.tobytes().hex()]), none, pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64()), pa.array([text])],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            prints = fingerprints_of([t.encode() for t in texts])
            if held is None:
                yield marked(part, _HEAD, ids[:1], texts[0], prints[0])
            else:
                ids = pa.concat_arrays([held[0], ids])
                texts, prints = [held[1], *texts], np.vstack([held[2][None], prints])
            last = len(texts) - 1
            if last:
                answers = _answers(ids[:last], texts[:last], texts[1:], prints[:last], prints[1:])
                mark = [pa.array(np.full(last, part, np.int32)), pa.array(np.full(last, _DONE, np.int32))]
                yield pa.RecordBatch.from_arrays([*mark, *answers, pa.nulls(last, pa.string())], names)
            held = ids[last:], texts[last], prints[last]
        if held is not None:
            yield marked(part, _TAIL, *held)

    return ordered.mapInArrow(run, _ROWS.format(kind=kind))


def _across(stored: DataFrame) -> DataFrame:
    """Answers for the last row of each task, whose next text is the first one of the next task with rows."""
    heads = stored.where(F.col("kind") == _HEAD)
    # One row per task, without texts.
    tasks = Window.orderBy("part")
    parts = materialize(heads.select("part"), "parts")
    first = parts.agg(F.min("part").alias("part")).select(F.lit(0).alias("_one"), F.col("part").alias("first"))
    follow = parts.withColumn("next_part", F.lead("part").over(tasks)).withColumn("_one", F.lit(0))
    follow = follow.join(first, "_one").select("part", F.coalesce("next_part", "first").alias("next_part"))
    tails = stored.where(F.col("kind") == _TAIL).select("part", "id", "text", "fingerprint").join(follow, "part")
    head = heads.select(F.col("part").alias("next_part"), F.col("text").alias("head"), F.col("fingerprint").alias("head_print"))
    pairs = tails.join(head, "next_part").select("id", "text", "fingerprint", "head", "head_print")
    kind = stored.schema["id"].dataType.simpleString()
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, texts, prints, following, next_prints = batch.columns
                told = _answers(ids, texts.to_pylist(), following.to_pylist(), _bytes(prints), _bytes(next_prints))
                yield pa.RecordBatch.from_arrays(told, names)

    return pairs.mapInArrow(
        run,
        f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _bytes(prints: pa.Array) -> np.ndarray:
    """Rows of bytes of fingerprints written in hexadecimal."""
    return np.frombuffer(bytes.fromhex("".join(prints.to_pylist())), np.uint8).reshape(-1, BITS // 8)


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    A text is compared with itself after its last half was replaced by the start of the next text in order of
    ids, and with that next text. Texts are range-partitioned by id and each meets the one behind it within
    its task; the ends of tasks are joined by the number of the task. A null text is empty. Rows with a null id come
    first, rows that repeat an id follow in order of a hash of their texts, the last row is followed by the first,
    and the only row of a table by itself. An empty table gives an empty result.
    """
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # The last key only tells equal rows apart, so that they can lie in different tasks.
    order = [F.asc("id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = keyed.select("id", "text", order[1].alias("_hash"), order[2].alias("_row"))
    order = [F.asc("id"), F.asc("_hash"), F.asc("_row")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    stored = materialize(_in_order(ordered), "answers")
    columns = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    whole = stored.where(F.col("kind") == _DONE).select(*columns).unionByName(_across(stored).select(*columns))
    return whole.withColumnRenamed("id", id_col)


def block_bounds(radius: int) -> list[tuple[int, int]]:
    """Bits [start, end) of the blocks, of which fingerprints within the radius share at least one."""
    if not 0 <= radius < BITS:
        raise ValueError("radius must be from 0 to 255")
    cuts = [k * BITS // (radius + 1) for k in range(radius + 2)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def table_keys(prints: np.ndarray, radius: int) -> np.ndarray:
    """Key of every fingerprint in the table of each block: table number and the leading bits of the block."""
    bits = np.unpackbits(prints, axis=1)
    keys = np.empty((len(prints), radius + 1), np.int64)
    for table, (start, end) in enumerate(block_bounds(radius)):
        leading = bits[:, start : min(end, start + _KEY_BITS)]
        powers = 1 << np.arange(leading.shape[1], dtype=np.int64)[::-1]
        keys[:, table] = leading.astype(np.int64) @ powers + (table << _KEY_BITS)
    return keys


def _tables(nodes: DataFrame, radius: int) -> DataFrame:
    """(key, node, print): every fingerprint once per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                prints = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, BITS // 8)
                keys = table_keys(prints, radius)
                rows = pa.array(np.repeat(np.arange(len(prints)), radius + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), batch.column(0).take(rows), batch.column(1).take(rows)], ["key", "node", "print"]
                )

    return nodes.select("node", "print").mapInArrow(run, "key long, node long, print binary")


def _pairs_of(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j), i before j, of all pairs within groups, about ``_PAIRS`` at a time."""
    rows = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    after = np.repeat(starts + sizes, sizes) - rows - 1
    done = np.cumsum(after)
    at = 0
    while at < len(rows):
        base = done[at] - after[at]
        end = max(int(np.searchsorted(done, base + _PAIRS, side="right")), at + 1)
        count = after[at:end]
        i = np.repeat(rows[at:end], count)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        at = end


def _in_groups(columns: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, smallest node it reaches in its tile, near nodes) of sorted whole tiles."""
    key, tile_a, tile_b, block, node, raw = columns
    prints = np.frombuffer(b"".join(raw.tolist()), np.uint8).reshape(-1, BITS // 8)
    change = (key[1:] != key[:-1]) | (tile_a[1:] != tile_a[:-1]) | (tile_b[1:] != tile_b[:-1])
    starts = np.concatenate([[0], np.flatnonzero(change) + 1])
    sizes = np.diff(np.append(starts, len(key)))
    keys = table_keys(prints, radius)
    table = key >> _KEY_BITS
    quads = prints.view(np.uint64)
    near, left, right = np.zeros(len(node), np.int64), [], []
    for i, j in _pairs_of(sizes, starts):
        # Two blocks meet across them only; a block meets itself in its own tile.
        apart = (tile_a[i] == tile_b[i]) | (block[i] != block[j])
        i, j = i[apart], j[apart]
        close = np.bitwise_count(quads[i] ^ quads[j]).sum(axis=1, dtype=np.int64) <= radius
        i, j = i[close], j[close]
        first = (keys[i] == keys[j]).argmax(axis=1) == table[i]
        i, j = i[first], j[first]
        np.add.at(near, i, 1)
        np.add.at(near, j, 1)
        left.append(i)
        right.append(j)
    label = node.copy()
    if left:
        i, j = np.concatenate(left), np.concatenate(right)
        while len(i):
            least = np.minimum(label[i], label[j])
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            if (label[i] == label[j]).all():
                break
    return node, label, near


def neighbourhoods(nodes: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, n_near, group_id) of distinct fingerprints ``(node, print)``, for nodes with a near one.

    ``n_near`` counts the other fingerprints within ``radius`` bits and ``group_id`` is the smallest node
    reachable over them. Fingerprints that share a block with very many are compared in tiles of two blocks of
    rows; pairs stay in their tile.
    """
    posted = _tables(nodes, radius)
    counts = materialize(block_counts(posted, "key", block_rows), "buckets")
    tiles = in_tiles(posted.join(counts, "key"), "key", "node")
    packs = max(task_count(nodes.sparkSession) * 4, 1)
    pack = F.pmod(F.xxhash64("key", "tile_a", "tile_b"), F.lit(packs))
    packed = tiles.select("key", "tile_a", "tile_b", "block", "node", "print").repartition(packs, pack)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_groups(batches, 3):
            found = _in_groups(columns, radius)
            kept = found[2] > 0
            if kept.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in found], ["node", "label", "near"])

    ordered = packed.sortWithinPartitions("key", "tile_a", "tile_b")
    stored = materialize(ordered.mapInArrow(run, "node long, label long, near long"), "near")
    near = stored.groupBy("node").agg(F.sum("near").alias("n_near"))
    groups = components(stored.select(F.col("node").alias("a"), F.col("label").alias("b")).distinct())
    return near.join(groups.select(F.col("id").alias("node"), F.col("component_id").alias("group_id")), "node")


def near_groups(prints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``prints`` with n_near and group_id, from its whole-number id and ``fingerprint`` columns.

    ``n_near`` is the number of other distinct fingerprints within ``radius`` bits, ``group_id`` the smallest id
    reachable over equal and near fingerprints. Rows with a null id take no part, unless their fingerprint also
    has an id; alone they have null in both. The fingerprints of an id that repeats are one node, in one group.
    """
    stored = prints if getattr(prints, "_is_stored", False) else materialize(prints, "prints")
    known = stored.groupBy("fingerprint").agg(F.min(F.col(f"`{id_col}`").cast("long")).alias("node"))
    nodes = materialize(known.select("node", "fingerprint", F.unhex("fingerprint").alias("print")), "nodes")
    found = neighbourhoods(nodes.where("node is not null"), radius, block_rows)
    told = nodes.join(found, "node", "left").select(
        "fingerprint",
        F.when(F.col("node").isNotNull(), F.coalesce("n_near", F.lit(0))).alias("n_near"),
        F.coalesce("group_id", "node").alias("group_id"),
    )
    # Both sides are stored tables, so adaptive execution can split a fingerprint of very many copies.
    return stored.join(materialize(told, "groups"), "fingerprint")


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """:func:`edit_likeness` of every row, with :func:`near_groups` of the fingerprints."""
    told = materialize(edit_likeness(docs, id_col, text_col), "fingerprints")
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near", "group_id"]
    return near_groups(told, id_col, radius).select(F.col(f"`{id_col}`"), *names)
