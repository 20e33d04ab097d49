"""Spelling variants: words at one edit from each other, found through Bloom filters.

The vocabulary is counted over all texts. A blocked Bloom filter per word length (a block is one 64-bit
word, so a probe reads one) is built by a grouped bitwise OR and sent to all tasks. Every word generates its
deletions and replacements; the hash of an edited word follows from the hash of the word, so only those that
pass the filter of their length become strings. They are joined exactly to the vocabulary, which removes the
false positives. Insertions are the deletions of the other word. The filters sent at once have a fixed bound in
bytes; larger vocabularies take further rounds, each with the filters of other lengths or parts of a length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiweave.llm.batches import scramble
from lexiweave.runtime import materialize, task_count

LEAST_LENGTH = 5
LEAST_COUNT = 3
ALTERED = 97
# A form must occur this many times as often as the word.
FORM_FACTOR = 2
# Bits of the filters per word, and bits set for a word.
FILTER_BITS = 24
PROBES = 5
# Filters that are sent to the tasks at once.
FILTER_BYTES = 16 * 1024 * 1024
# Words of this length and above share a filter.
LONG = 256
# Distinct words that a task holds before it hands on their counts.
_HELD = 1 << 17
_HELD_CHARS = 1 << 22
# Edits that are hashed at a time.
_EDITS = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_LETTERS = np.random.default_rng(20250712).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def words_of(doc_id: str | None, text: str, run: re.Pattern, altered: int = ALTERED) -> Counter:
    """Counts of the runs of letters of a text, with A-Z in lower case.

    A run loses one letter if ``altered`` divides its checksum with the id; with a null id none does.
    """
    # Lower case of bytes is that of ASCII alone.
    counts = Counter(run.findall(text.encode().lower().decode()))
    if doc_id is None:
        return counts
    base, lost = zlib.crc32(f"{doc_id}:".encode()), []
    for one in counts:
        mark = zlib.crc32(one.encode(), base)
        if mark % altered == 0:
            lost.append((one, mark % len(one)))
    moved = [(one[:at] + one[at + 1 :], counts.pop(one)) for one, at in lost]
    for one, n in moved:
        counts[one] += n
    return counts


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    # Shorter runs cannot give a word, since a run can only lose a letter.
    letters = re.compile(f"[a-z\u00c0-\u00ff]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        size = 0

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in words_of(doc_id, text, letters).items():
                    if len(word) >= least_length:
                        size += 0 if word in held else len(word)
                        held[word] += n
                if len(held) > _HELD or size > _HELD_CHARS:
                    yield handed()
                    held.clear()
                    size = 0
        if held:
            yield handed()

    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counts = texts.where("text is not null").mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _powers(length: int) -> np.ndarray:
    steps = np.full(max(length, 1), _BASE, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _codes(some: list[str]) -> np.ndarray:
    """Latin-1 codes of words of one length, a row per word."""
    return np.frombuffer("".join(some).encode("latin-1"), np.uint8).reshape(len(some), -1)


def hashes_of(codes: np.ndarray) -> np.ndarray:
    """Hashes of words of one length: sums of letter symbols times powers, so that an edit is a small change."""
    return (_LETTERS[codes] * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


@dataclass(frozen=True)
class Shard:
    """Place of the filter of a length, or of a part of it, in the array of a round."""

    shard: int
    offset: int
    blocks: int
    pieces: int
    piece: int

    def places(self, mixed: np.ndarray) -> np.ndarray:
        """Block of every mixed hash, -1 where the word belongs to another part."""
        place = ((mixed >> np.uint64(32)) % np.uint64(self.blocks)).astype(np.int64) + self.offset
        if self.pieces > 1:
            place[scramble(mixed ^ np.uint64(0x55)) % np.uint64(self.pieces) != self.piece] = -1
        return place


def masks_of(mixed: np.ndarray) -> np.ndarray:
    """The bits that are set in the block of a word."""
    found = np.zeros(len(mixed), np.uint64)
    for k in range(PROBES):
        found |= np.uint64(1) << ((mixed >> np.uint64(6 * k)) & np.uint64(63))
    return found


def plan_rounds(counts: dict[int, int], filter_bytes: int = FILTER_BYTES) -> list[dict[int, Shard]]:
    """Filters of all lengths, dealt into rounds of at most ``filter_bytes``; one part of a length per round."""
    most = filter_bytes // 8
    rounds: list[dict[int, Shard]] = []
    room = 0
    for shard, n in sorted(counts.items()):
        blocks = max(1, -(-n * FILTER_BITS // 64))
        pieces = -(-blocks // most)
        size = -(-blocks // pieces)
        for piece in range(pieces):
            if not rounds or room < size or shard in rounds[-1]:
                rounds.append({})
                room = most
            rounds[-1][shard] = Shard(shard, most - room, size, pieces, piece)
            room -= size
    return rounds


def _by_length(some: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, codes) of the words of each length."""
    lengths = np.fromiter(map(len, some), np.int64, len(some))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield rows, _codes([some[k] for k in rows.tolist()])


def build_filter(vocab: DataFrame, shards: dict[int, Shard]) -> np.ndarray:
    """The filters of a round as one array of 64-bit blocks, ORed together by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in _by_length(batch.column(0).to_pylist()):
                shard = shards.get(min(codes.shape[1], LONG))
                if shard is None:
                    continue
                mixed = scramble(hashes_of(codes))
                place = shard.places(mixed)
                kept = place >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[kept]), pa.array(masks_of(mixed[kept]).view(np.int64))], ["block", "mask"]
                )

    wanted = vocab.where(F.least(F.length("word"), F.lit(LONG)).isin(list(shards)))
    parts = wanted.select("word").mapInArrow(run, "block long, mask long").groupBy("block").agg(F.bit_or("mask").alias("mask"))
    blocks = max(s.offset + s.blocks for s in shards.values())
    table = np.zeros(blocks, np.uint64)
    found = parts.toArrow()
    table[found["block"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return table


def _passing(mixed: np.ndarray, shard: Shard, table: np.ndarray) -> np.ndarray:
    place = shard.places(mixed)
    mask = masks_of(mixed)
    return (place >= 0) & (table[place] & mask == mask)


def probe_edits(codes: np.ndarray, shards: dict[int, Shard], table: np.ndarray, letters: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Edits of words of one length that pass the filters: (kind, word row, position, letter).

    Kind 0 is a replacement by the letter and kind 1 a deletion; of equal letters in a row the last is deleted.
    """
    m, length = codes.shape
    powers = _powers(length)
    symbols = _LETTERS[codes] * powers
    whole = symbols.sum(axis=1, dtype=np.uint64)
    same, shorter = shards.get(min(length, LONG)), shards.get(min(length - 1, LONG))
    if same is not None:
        step = max(1, _EDITS // max(len(letters) * m, 1))
        for at in range(0, length, step):
            here = np.arange(at, min(at + step, length))
            rest = whole[:, None] - symbols[:, here]
            made = rest[:, :, None] + powers[here][None, :, None] * _LETTERS[letters][None, None, :]
            shape = made.shape
            passed = _passing(scramble(made.ravel()), same, table).reshape(shape)
            passed &= codes[:, here][:, :, None] != letters[None, None, :]
            word, place, letter = np.nonzero(passed)
            if len(word):
                yield 0, word, here[place], letters[letter]
    if shorter is not None:
        # The letters behind the deleted one move one place to the front.
        before = np.zeros((m, length), np.uint64)
        np.cumsum(symbols[:, :-1], axis=1, out=before[:, 1:])
        made = before + (whole[:, None] - before - symbols) * _INVERSE
        passed = _passing(scramble(made.ravel()), shorter, table).reshape(made.shape)
        passed[:, :-1] &= codes[:, :-1] != codes[:, 1:]
        word, place = np.nonzero(passed)
        if len(word):
            yield 1, word, place, np.zeros(len(word), np.uint8)


def candidates(vocab: DataFrame, shards: dict[int, Shard], letters: dict[int, str]) -> DataFrame:
    """(word, n, kind, edit) of the edits that the filters of a round let pass."""
    spark = vocab.sparkSession
    sent = spark.sparkContext.broadcast(build_filter(vocab, shards))
    alphabet = {shard: np.frombuffer(some.encode("latin-1"), np.uint8) for shard, some in letters.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            some, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for rows, codes in _by_length(some):
                chars = alphabet.get(min(codes.shape[1], LONG), np.zeros(0, np.uint8))
                step = max(1, _EDITS // max(len(chars) * codes.shape[1], 1))
                for at in range(0, len(codes), step):
                    for kind, word, place, letter in probe_edits(codes[at : at + step], shards, table, chars):
                        own = rows[word + at]
                        made = []
                        for w, p, c in zip(own.tolist(), place.tolist(), letter.tolist(), strict=True):
                            old = some[w]
                            made.append(old[:p] + (chr(c) if kind == 0 else "") + old[p + 1 :])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(own)), pa.array(n[own]), pa.array(np.full(len(own), kind, np.int32)), pa.array(made, pa.string())],
                            ["word", "n", "kind", "edit"],
                        )

    shard = F.least(F.length("word"), F.lit(LONG))
    below = F.least(F.length("word") - 1, F.lit(LONG))
    asked = vocab.where(shard.isin(list(shards)) | below.isin(list(shards)))
    return asked.select("word", "n").mapInArrow(run, "word string, n long, kind int, edit string")


def near_words(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n), both ways, of the words of a stored vocabulary that differ by one edit.

    The vocabulary is spread over all tasks, since a word costs hundreds of probes and few bytes.
    """
    shard = F.least(F.length("word"), F.lit(LONG))
    counts = {r["shard"]: r["n"] for r in vocab.groupBy(shard.alias("shard")).agg(F.count("*").alias("n")).collect()}
    # At most 257 lengths of at most 90 letters.
    chars = vocab.select(shard.alias("shard"), F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''")
    found = chars.groupBy("shard").agg(F.array_join(F.sort_array(F.collect_set("letter")), "").alias("letters"))
    letters = {r["shard"]: r["letters"] for r in found.collect()}
    every = None
    for shards in plan_rounds(counts, filter_bytes):
        asked = materialize(candidates(vocab, shards, letters), "edits")
        every = asked if every is None else every.unionByName(asked)
    if every is None:
        return vocab.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    known = vocab.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    met = materialize(every.join(known, "edit"), "near")
    there = met.select("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n"))
    back = met.where("kind = 1").select(
        F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    return there.unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word reached from each word of ``(word, form)``.

    Every round joins the reached words to their own, which doubles the steps taken; a form is always more
    frequent than its word, so there are no circles.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = reached.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        moved = materialize(moved, "roots")
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    factor: int = FORM_FACTOR,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary of all texts.

    Words are runs of A-Z, a-z and the code points from U+00C0 to U+00FF; only A-Z are lower-cased. A run whose
    checksum with the id of its row is divisible by 97 loses one letter. ``n_near`` counts the words at exactly
    one inserted, deleted or replaced letter; ``form`` is the most frequent of them, of equally frequent ones the
    first in the order of code points, if it occurs at least ``factor`` (2 or more) times as often as the word.
    Null and empty texts have no words, a null id alters no run, repeated rows count again, very long words are
    compared like others, and an empty table gives an empty result.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more")
    counted = materialize(vocabulary(docs, id_col, text_col, least_length, least_count), "counted")
    spread = F.pmod(F.xxhash64("word"), F.lit(1 << 20))
    vocab = materialize(counted.repartition(task_count(docs.sparkSession), spread), "vocabulary")
    near = near_words(vocab, filter_bytes)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near"))).alias("best")
    )
    told = vocab.join(best, "word", "left")
    good = -F.col("best.neg") >= factor * F.col("n")
    told = materialize(
        told.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(good, F.col("best.near")).alias("form"),
            F.when(good, -F.col("best.neg")).alias("form_n"),
        ),
        "forms",
    )
    found = roots(told.where("form is not null").select("word", "form"))
    return told.join(found, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
