"""Benchmark decontamination by templates.

Numbers, units and names of a text become typed placeholders, everything else is lower-cased words.
Windows of template tokens are hash-joined to the windows of the benchmark items, and the values
behind the placeholders must be replaced consistently: within one alignment of a document with an
item, a value of the item always stands for the same value of the document. So a question with
other numbers or names is still found, and a chance match of templates is not. Items without a window
of enough literal words are found by windows that hash the values as well, so only verbatim.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiweave.llm.batches import byte_symbols, cores, fold_case, fresh, openings, scramble, span_hashes, text_slices, words
from lexiweave.runtime import fits_broadcast, keyed_join, lookup_join, materialize

WINDOW = 8
LEAST_LITERALS = 4
MIN_COVERAGE = 0.2
MIN_CONSISTENCY = 0.85

# Units that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft feet foot yd yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds "
    "oz ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour "
    "hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur percent degree degrees "
    "celsius fahrenheit watt watts volt volts kb mb gb tb byte bytes meter meters metre metres kilometer kilometers"
).split()

# Words that open sentences without being names, in the languages of the corpus.
OPENERS = (
    "a about after all also although an and another any are as at because before both but by can could did do does during each either "
    "every few finally first for from had has have he her here his how however i if in into is it its last later let many may more most "
    "much my neither next no nor not now of often on once one only or our out over please second several she should since so some soon "
    "such suppose than that the their them then there these they third this those though through thus to today two under until up "
    "was we were what when where whether which while who whom whose why will with would yes yet you your "
    "add answer apply assume calculate choose classify compare complete compute consider convert count define derive describe determine "
    "discuss divide draw estimate evaluate explain express factor fill find give given identify imagine list make mention multiply name "
    "note order pick predict prove rank read recall rewrite round say select show simplify solve sort state subtract sum summarize take tell "
    "translate true try use using verify what's write well "
    "aber alle als also am an auf aus bei bis da das dass dem den denn der des die dies diese dieser doch du durch ein eine einem einen "
    "einer er es für gib haben hat ich ihr im ist jede jeder kann man mit nach nenne nicht noch nun nur ob oder schon sein sie sind so "
    "und unter vom von vor wann warum was welche welcher wenn wer wie wieviel wir wird wo zu zum zur berechne bestimme erkläre finde "
    "au aux avec ce ces cet cette chaque combien comme comment dans de des donc du elle elles en est et il ils je la le les leur mais "
    "ne nous on où ou par pas pour pourquoi qu quand que quel quelle qui sa sans se ses si son sont sur tous tout un une vous "
    "al como con cuando cuántas cuánto cuántos cuál de del donde dónde el ella ellos en entre es esa ese esta este hay la las lo los "
    "más muy no para pero por porque que qué quién se si sin sobre son su sus también todo todos un una unos y ya yo calcula encuentra"
).split()

# A table of 2**24 bits tells which windows can occur in the benchmark. Its size is fixed; it only
# spares the join rows that cannot match, whatever the size of the benchmark.
_FILTER_BITS = 24
_MULTIPLIER = np.uint64(0xC2B2AE3D27D4EB4F)
# Tells the hashes of windows with values from those of templates.
_SHORT = 1 << 20
_NUMBER, _UNIT, _NAME = (scramble(np.array([x], np.uint64))[0] for x in (101, 102, 103))


def _word_set(found: list[str]) -> np.ndarray:
    coded = [x.encode() for x in found]
    data = np.frombuffer(b"".join(coded), np.uint8)
    ends = np.cumsum([len(x) for x in coded])
    starts = np.concatenate([[0], ends[:-1]])
    return np.sort(span_hashes(byte_symbols(data), starts, ends))


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _split_unspaced(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words cut into characters where their script has no spaces: the word of each part, its start and end.

    These are Han, kana, Thai, Lao, Khmer and Burmese; their punctuation is left out.
    """
    word = np.arange(len(begin))
    if not (data >= 0xE0).any():
        return word, begin, end
    one, two = np.append(data[1:], 0), np.append(data[2:], [0, 0])[: len(data)]
    mark = (data == 0xE3) & (one == 0x80) & (two != 0x85) & (two != 0x86) & (two != 0x87) | (data == 0xEF) & (one == 0xBC) & ((two <= 0x8F) | (two >= 0x9A) & (two <= 0xA0)) | (data == 0xEF) & (one == 0xBD) & (two >= 0xA1) & (two <= 0xA5)
    three = mark | (data == 0xE3) | (data >= 0xE4) & (data <= 0xE9) | (data == 0xE0) & (one >= 0xB8) & (one <= 0xBB) | (data == 0xE1) & ((one >= 0x80) & (one <= 0x82) | (one == 0x9E) | (one == 0x9F)) | (data == 0xEF) & (one >= 0xA4) & (one <= 0xAB)
    four = (data == 0xF0) & (one >= 0xA0) & (one <= 0xB3)
    single = np.flatnonzero(three | four)
    after = single + np.where(four[single], 4, 3)
    cuts = np.unique(np.concatenate([begin, single, after]))
    own = np.searchsorted(begin, cuts, side="right") - 1
    inside = (own >= 0) & (cuts < end[np.maximum(own, 0)]) if len(begin) else np.zeros(len(cuts), bool)
    cuts, own = cuts[inside], own[inside]
    stop = np.minimum(np.append(cuts[1:], len(data)), end[own])
    real = ~mark[cuts]
    return own[real], cuts[real], stop[real]


def templates(data: np.ndarray, offsets: np.ndarray, units: np.ndarray, openers: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, token hash, value hash, hash of all values, literal?) of the template tokens of a slice, in order."""
    starts, ends, first = words(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    opening = openings(data, starts, ends, text)
    solid, begin, end = cores(data, starts, ends)
    text, opening = text[solid], opening[solid]
    word, begin, end = _split_unspaced(data, begin, end)
    text, opening = text[word], opening[word] & np.append(True, word[1:] != word[:-1])[: len(word)]
    low = fold_case(data)
    values = span_hashes(byte_symbols(low), begin, end) if len(begin) else np.zeros(0, np.uint64)
    head = data[begin]
    number = (head >= 48) & (head <= 57)
    limit = max(len(data) - 1, 0)

    def capital(at: np.ndarray) -> np.ndarray:
        here, after = data[np.minimum(at, limit)], np.minimum(at + 1, limit)
        return (here >= 65) & (here <= 90) | (here == 0xC3) & (low[after] != data[after])

    # Words in capitals are ordinary words, as are single letters.
    second = begin + np.where(head == 0xC3, 2, 1)
    name = capital(begin) & (second < end) & ~capital(second) & ~number
    # A word that opens a sentence is a name unless it is known as another word.
    name &= ~(opening & _member(values, openers))
    follows = np.zeros(len(begin), bool)
    follows[1:] = number[:-1] & (text[1:] == text[:-1])
    unit = follows & ~number & _member(values, units)
    name &= ~unit
    tokens = values.copy()
    tokens[number], tokens[unit], tokens[name] = _NUMBER, _UNIT, _NAME
    # Names in a row are one name, within a sentence.
    kept = np.ones(len(begin), bool)
    kept[1:] = ~(name[1:] & name[:-1] & (text[1:] == text[:-1]) & ~opening[1:])
    literal = ~(number | unit | name)
    # All names in a row count where values are compared exactly.
    heads = np.flatnonzero(kept)
    place = np.arange(len(begin)) - heads[np.cumsum(kept) - 1] if len(heads) else np.zeros(0, np.int64)
    whole = np.add.reduceat(scramble(values + place.astype(np.uint64)), heads) if len(heads) else values
    return text[kept], tokens[kept], values[kept], whole, literal[kept]


def window_hashes(text: np.ndarray, tokens: np.ndarray, literal: np.ndarray, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and hashes of the windows of ``size`` tokens that hold enough literal words, or with ``short`` too few."""
    count = len(tokens) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.full(count, size + (_SHORT if short else 0), np.uint64)
    for k in range(size):
        value = value * _MULTIPLIER + tokens[k : k + count]
    sums = np.concatenate([[0], np.cumsum(literal)])
    enough = sums[size:] - sums[:count] >= min(LEAST_LITERALS, size)
    good = (text[:count] == text[size - 1 :]) & (~enough if short else enough)
    first = np.flatnonzero(good)
    return first, scramble(value[first])


def _windows(source: DataFrame, id_col: str, text_col: str, sizes: list[int] | None, table: np.ndarray | None, window: int) -> DataFrame:
    """(id, key, size, pos, hash, slots) of the template windows; with ``table`` only those that can match."""
    units, openers = _word_set(UNITS), _word_set(OPENERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, end_row, data, offsets in text_slices(batch.column(1)):
                text, tokens, values, whole, literal = templates(data, offsets, units, openers)
                begins = np.searchsorted(text, np.arange(end_row - first_row))
                lengths = np.bincount(text, minlength=end_row - first_row)
                for size in sizes or range(LEAST_LITERALS, window + 1):
                    at, hashes = window_hashes(text, tokens, literal, size)
                    short, exact = window_hashes(text, whole, literal, size, short=True)
                    if sizes is None:
                        # An item has windows of the full size, or one window if it is shorter.
                        fits = np.minimum(lengths[text[at]], window) == size
                        at, hashes = at[fits], hashes[fits]
                        # Only items without a template are found by their values.
                        fits = (np.minimum(lengths[text[short]], window) == size) & ~np.isin(text[short], text[at])
                        short, exact = short[fits], exact[fits]
                    at, hashes = np.concatenate([at, short]), np.concatenate([hashes, exact])
                    if table is not None:
                        bit = hashes >> np.uint64(64 - _FILTER_BITS)
                        hit = (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
                        at, hashes = at[hit > 0], hashes[hit > 0]
                    if not len(at):
                        continue
                    slots = [values[i : i + size][~literal[i : i + size]].view(np.int64) for i in at.tolist()]
                    rows = pa.array(first_row + text[at])
                    columns = [
                        batch.column(0).take(rows),
                        batch.column(2).take(rows),
                        pa.array(np.full(len(at), size, np.int32)),
                        pa.array(at - begins[text[at]]),
                        pa.array(hashes.view(np.int64)),
                        pa.array(slots, pa.list_(pa.int64())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "key", "size", "pos", "hash", "slots"])

    kind = source.schema[id_col].dataType.simpleString()
    text = F.col(text_col)
    return source.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("key")).mapInArrow(
        run, f"id {kind}, key long, size int, pos long, hash long, slots array<long>"
    )


def _filter_table(items: DataFrame) -> np.ndarray:
    """The bits of the window hashes, packed by Spark into at most 2**18 numbers."""
    bit = F.shiftrightunsigned("hash", 64 - _FILTER_BITS)
    packed = (
        items.select(F.shiftrightunsigned(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast((shiftrightunsigned(hash, {64 - _FILTER_BITS}) & 63) as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    table = np.zeros(1 << (_FILTER_BITS - 6), np.uint64)
    table[packed["word"].to_numpy().astype(np.int64)] = packed["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return table


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_coverage: float = MIN_COVERAGE,
    min_consistency: float = MIN_CONSISTENCY,
) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    Columns: id, text_key (a hash of the text), item_id, n_windows matched, item_windows, coverage, and
    consistency of the worst alignment that counts. A pair is reported if at least ``min_coverage`` of
    the windows of the item match in alignments whose values are replaced consistently. Items with
    fewer than ``window`` template tokens are one window; items without a window of four literal words
    match only with the same values. Items of fewer than four tokens cannot be told from other text and
    match nothing. Characters of scripts without spaces are tokens. Null and empty texts and empty tables give no
    pairs. Rows that repeat are reported once per id and text.
    """
    items = materialize(_windows(benchmark, item_col, item_text_col, None, None, window), "items")
    sizes = sorted(x["size"] for x in items.select("size").distinct().collect())
    totals = items.groupBy("id").agg(F.count_distinct("pos").alias("item_windows"))
    if not sizes:
        sizes = [window]
    found = _windows(docs, id_col, text_col, sizes, _filter_table(items), window)
    found = materialize(found.distinct(), "windows")
    known = items.select(F.col("id").alias("item_id"), "hash", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    known = materialize(known, "known")
    pairs = keyed_join(found, known, ["hash"], ["id", "pos"], fits_broadcast(known))
    # One alignment is one distance between the positions, so it has no more rows than the item has windows.
    aligned = (
        pairs.groupBy("id", "key", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(
            F.collect_set("item_pos").alias("places"),
            F.flatten(F.collect_list(F.arrays_zip("item_slots", "slots"))).alias("values"),
        )
        .withColumn("n_pairs", F.size(F.array_distinct("values")))
        .withColumn("n_values", F.size(F.array_distinct("values.item_slots")))
        .withColumn("consistency", F.when(F.col("n_pairs") == 0, 1.0).otherwise(F.col("n_values") / F.col("n_pairs")))
        .where(F.col("consistency") >= min_consistency)
    )
    matched = (
        aligned.select("id", "key", "item_id", "consistency", F.explode("places").alias("place"))
        .groupBy("id", "key", "item_id")
        .agg(F.count_distinct("place").alias("n_windows"), F.min("consistency").alias("consistency"))
    )
    totals = materialize(totals.withColumnRenamed("id", "item_id"), "totals")
    covered = lookup_join(matched, totals, ["item_id"], ["id"]).withColumn("coverage", F.col("n_windows") / F.col("item_windows"))
    return covered.where(F.col("coverage") >= min_coverage).select(
        F.col("id").alias(id_col), F.col("key").alias("text_key"), "item_id", "n_windows", "item_windows", "coverage", "consistency"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, with the columns they came with."""
    dirty = leaks(docs, benchmark, id_col, text_col, **options)
    key = fresh("_key", docs.columns)
    dirty = materialize(dirty.select(F.col("text_key").alias(key)).distinct(), "leaks")
    keyed = docs.withColumn(key, F.xxhash64(F.col(text_col)))
    return lookup_join(keyed, dirty, [key], [id_col], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
