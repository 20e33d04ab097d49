"""Secret scans by fixed patterns and a linear-chain conditional random field.

The patterns give the base spans. The field tags every white-space token of a text as secret begin,
inside or outside from the shape of the token, its neighbouring words and features of the file, and
the best tag sequence is found by Viterbi. It is trained on the base spans of a bounded sample. The shape
tells how long a token is and how often digits, small and capital letters take turns in it, but not whether it
is hexadecimal, and the words around are withheld in half of the windows, so the field also finds secrets
of other alphabets without a key word. Its spans are added as far as no base span covers them and they hold
a letter or digit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiweave.llm.batches import byte_symbols, cores, span_hashes, text_slices, words

# The patterns of the base spans and the least length of what they find.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_LEAST_ASSIGN, _LEAST_ACCESS = 6, 20
# What may stand beside a base span in its token and is no part of a secret.
_AROUND = " \t\n\v\f\r\"'`,;.()[]{}<>"
KINDS = ("assign", "access", "hex", "crf")

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
# Tables of the field: token shapes, hashed neighbouring words, file features.
_SHAPES, _WORDS, _FILES = 512, 1024, 16
# Texts of the training sample, half of them with base spans; texts it is drawn from; tokens of a text that are used.
SAMPLE_TEXTS = 1200
POOL_TEXTS = 40000
_TRAIN_TOKENS = 40
# Tables that tell what stands around a token.
_CONTEXT = ("before", "after", "shape_before")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points of what the patterns find, in order."""
    found = []
    lower = text.lower()
    if any(w in lower for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def spans_text(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


# Classes of bytes: digit, lower, upper, other letter, assignment mark; the others have class 0.
_CLASS = np.zeros(256, np.uint8)
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91], _CLASS[128:] = 1, 2, 3, 4
_CLASS[[ord(c) for c in "=:"]] = 5
# Lengths from which a token counts as longer.
_LENGTHS = np.array([4, 8, 12, 16, 20, 28, 40])


def _sums(what: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(what) + 1, np.int32)
    np.cumsum(what, out=sums[1:])
    return sums


def token_features(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Tokens of a slice with their shape, hashed word and the file feature of their text.

    The shape is that of the token without punctuation around it: its length, the share of neighbouring
    characters of different classes, and whether it holds digits, letters beyond ASCII, an assignment mark or
    other marks. A token of punctuation alone has shape 0.
    """
    starts, ends, first = words(data, offsets)
    kind = _CLASS[data]
    solid, begin, end = cores(data, starts, ends)
    turns = np.zeros(len(data), bool)
    turns[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & (kind[1:] < 4) & (kind[:-1] < 4)
    digits, high, marks, others, turned = (_sums(x) for x in (kind == 1, kind == 4, kind == 5, kind == 0, turns))
    length = (end - begin).astype(np.int32)
    share = (turned[end] - turned[np.minimum(begin + 1, end)]) * 8 // np.maximum(length, 1)
    parts = (
        (np.minimum(share, 2), 3), (digits[end] > digits[begin], 2), (high[end] > high[begin], 2),
        (marks[end] > marks[begin], 2), (others[end] - others[begin] > 2, 2),
    )
    core = np.searchsorted(_LENGTHS, length, side="right").astype(np.int64)
    for part, width in parts:
        core = core * width + part.astype(np.int64)
    shape = np.zeros(len(starts), np.int64)
    shape[solid] = core + 1
    hashes = span_hashes(byte_symbols(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    total = np.maximum(np.diff(offsets), 1)
    marked = (digits + marks)[offsets[1:]] - (digits + marks)[offsets[:-1]]
    file = np.minimum(marked * 100 // total, 3) * 4 + np.minimum(np.log10(total).astype(np.int64), 3)
    return {
        "start": starts, "end": ends, "first": first, "text": text, "shape": shape,
        "word": (hashes % np.uint64(_WORDS)).astype(np.int64), "file": file[text],
    }


class Field:
    """Weights of the field: emission tables by feature, and tag transitions."""

    names = ("shape", "shape_before", "before", "after", "file", "move")

    def __init__(self):
        self.shape = np.zeros((_SHAPES, 3))
        self.shape_before = np.zeros((_SHAPES, 3))
        self.before = np.zeros((_WORDS + 1, 3))
        self.after = np.zeros((_WORDS + 1, 3))
        self.file = np.zeros((_FILES, 3))
        self.move = np.zeros((3, 3))

    def columns(self, t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Index of every feature table for every token; the edge of a text has its own word."""
        n = len(t["shape"])
        same = np.zeros(n + 1, bool)
        same[1:n] = t["text"][1:] == t["text"][:-1]
        back = np.maximum(np.arange(n) - 1, 0)
        ahead = np.minimum(np.arange(n) + 1, max(n - 1, 0))
        return {
            "shape": t["shape"],
            "shape_before": np.where(same[:-1], t["shape"][back], 0),
            "before": np.where(same[:-1], t["word"][back], _WORDS),
            "after": np.where(same[1:], t["word"][ahead], _WORDS),
            "file": t["file"],
        }

    def emissions(self, at: dict[str, np.ndarray]) -> np.ndarray:
        return sum(getattr(self, k)[v] for k, v in at.items())

    def fit(self, at: dict[str, np.ndarray], tags: np.ndarray, mask: np.ndarray, steps: int = 150, rate: float = 0.4) -> None:
        """Adagrad on the mean log-likelihood by forward-backward; arrays are (sequence, position)."""
        n, length = tags.shape
        pace = {k: np.full_like(getattr(self, k), 1e-6) for k in self.names}
        for _ in range(steps):
            score = self.emissions(at)
            ahead, behind = np.zeros((length, n, 3)), np.zeros((length, n, 3))
            ahead[0] = score[:, 0]
            for p in range(1, length):
                moved = _logsum(ahead[p - 1][:, :, None] + self.move, 1) + score[:, p]
                ahead[p] = np.where(mask[:, p, None], moved, ahead[p - 1])
            for p in range(length - 2, -1, -1):
                moved = _logsum(self.move[None] + (score[:, p + 1] + behind[p + 1])[:, None, :], 2)
                behind[p] = np.where(mask[:, p + 1, None], moved, behind[p + 1])
            whole = _logsum(ahead[-1], 1)
            chance = np.exp(ahead + behind - whole[None, :, None]).transpose(1, 0, 2)
            slope = (np.eye(3)[tags] - chance) * mask[:, :, None]
            grads = {}
            for k, index in at.items():
                grads[k] = np.zeros_like(getattr(self, k))
                np.add.at(grads[k], index[mask], slope[mask])
            steps_seen = np.zeros((3, 3))
            for p in range(1, length):
                both = ahead[p - 1][:, :, None] + self.move + (score[:, p] + behind[p])[:, None, :] - whole[:, None, None]
                on = mask[:, p]
                steps_seen -= np.exp(both[on]).sum(axis=0)
                np.add.at(steps_seen, (tags[on, p - 1], tags[on, p]), 1)
            grads["move"] = steps_seen
            for k, g in grads.items():
                w = getattr(self, k)
                g = g / n - 0.0003 * w
                pace[k] += g * g
                w += rate * g / np.sqrt(pace[k])

    def decode(self, score: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Viterbi tags of the token sequences of all texts of a slice.

        A token whose score for outside leads by more than any change of its two transitions can
        gain is outside on every best path. The recursion runs over the stretches between such
        tokens, all stretches at once, and gives the same tags as a run over all tokens.
        """
        tags = np.zeros(len(score), np.int64)
        move = self.move
        # Gain of tag y between two tags, against outside between them.
        gain = move[:, 1:, None] + move[None, 1:, :] - move[:, :1, None] - move[None, :1, :]
        ends_gain = max(float(gain.max()), float((move[:, 1:] - move[:, :1]).max()), float((move[1:] - move[:1]).max()))
        unsure = np.flatnonzero(score[:, OUTSIDE] - score[:, 1:].max(axis=1) <= max(ends_gain, 0.0))
        if not len(unsure):
            return tags
        cut = np.flatnonzero((np.diff(unsure) != 1) | (text[unsure][1:] != text[unsure][:-1])) + 1
        first = unsure[np.concatenate([[0], cut])]
        size = np.diff(np.concatenate([[0], cut, [len(unsure)]]))
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        last = first + size - 1
        before = (first > 0) & (text[np.maximum(first - 1, 0)] == text[first])
        after = (last + 1 < len(score)) & (text[np.minimum(last + 1, len(score) - 1)] == text[last])
        best = score[first] + np.where(before[:, None], move[OUTSIDE], 0.0)
        came = []
        for p in range(1, int(size[0])):
            on = int(np.searchsorted(-size, -p, side="left"))
            reach = best[:on, :, None] + move
            came.append(reach.argmax(axis=1))
            best[:on] = reach.max(axis=1) + score[first[:on] + p]
        tag = (best + np.where(after[:, None], move[:, OUTSIDE], 0.0)).argmax(axis=1)
        for p in range(int(size[0]) - 1, -1, -1):
            on = int(np.searchsorted(-size, -p, side="left"))
            tags[first[:on] + p] = tag[:on]
            if p:
                tag[:on] = came[p - 1][np.arange(on), tag[:on]]
        return tags


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _char_positions(data: np.ndarray) -> np.ndarray | None:
    """Code points before every byte; None where all bytes are ASCII."""
    if not (data >= 128).any():
        return None
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=place[1:])
    return place


def _tagged(features: dict[str, np.ndarray], k: int, spans: list[tuple[int, int, int]], place) -> np.ndarray:
    """Tags of the tokens of text k that overlap the spans."""
    lo, hi = features["first"][k], features["first"][k + 1]
    s, e = place(features["start"][lo:hi]), place(features["end"][lo:hi])
    tags = np.zeros(hi - lo, np.int64)
    for a, kind, b in spans:
        # The key word of an assignment is context; its value is the secret.
        over = np.flatnonzero((e > a) & (s < b))
        if kind == 0 and len(over) > 1:
            over = over[-1:]
        tags[over[:1]] = BEGIN
        tags[over[1:]] = INSIDE
    return tags


def train(docs: DataFrame, text_col: str = "text", sample_texts: int = SAMPLE_TEXTS, pool_texts: int = POOL_TEXTS) -> Field:
    """Fit the field on at most ``sample_texts`` texts, half of them with base spans if there are enough.

    They come from about ``pool_texts`` texts that are chosen by a hash, at rates that follow from the measured
    number of rows. Of a text, the tokens around its first base span are used, or around a hashed place. An
    empty table, or one without texts, gives a field that tags nothing.
    """
    text = F.col(text_col)
    pattern = r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
    size = 2400
    digest = F.xxhash64(text)
    known = docs.where(text.isNotNull()).select(text.alias("t"), digest.alias("d"))
    total = max(known.count(), 1)
    pool = known.where(F.pmod(F.xxhash64("d", F.lit(3)), F.lit(total)) < pool_texts)
    # A window of the text around what the pattern finds, so long texts cost no more than short ones.
    spot = F.regexp_instr("t", F.lit(pattern))
    start = F.when(spot > 0, F.greatest(spot - size // 2, F.lit(1))).otherwise(
        F.pmod("d", F.greatest(F.length("t") - size, F.lit(1))) + 1
    )
    windows = pool.select(F.substring("t", start.cast("int"), F.lit(size)).alias("t"), "d", (spot > 0).alias("marked"))
    half = sample_texts // 2
    few = F.pmod(F.xxhash64("d", F.lit(9)), F.lit(min(total, pool_texts))) < sample_texts
    rows = windows.where("marked").limit(half).collect() + windows.where(~F.col("marked") & few).limit(half).collect()
    field = Field()
    texts = [x["t"] for x in sorted(rows, key=lambda x: (x["d"], x["t"]))]
    if not texts:
        return field
    columns: dict[str, list[np.ndarray]] = {k: [] for k in field.names[:-1]}
    all_tags, rng = [], np.random.default_rng(9)
    for _, _, data, offsets in text_slices(pa.array(texts)):
        features = token_features(data, offsets)
        at = field.columns(features)
        place = _char_positions(data)
        for k in range(len(offsets) - 1):
            lo, hi = int(features["first"][k]), int(features["first"][k + 1])
            if hi == lo:
                continue
            whole = data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8")
            begin = 0 if place is None else place[offsets[k]]
            tags = _tagged(features, k, base_spans(whole), (lambda x, o=offsets[k]: x - o) if place is None else (lambda x, b=begin: place[x] - b))
            on = np.flatnonzero(tags)
            middle = int(on[0]) if len(on) else int(rng.integers(0, hi - lo))
            a = max(0, min(middle - _TRAIN_TOKENS // 2, hi - lo - _TRAIN_TOKENS))
            b = min(hi - lo, a + _TRAIN_TOKENS)
            all_tags.append(tags[a:b])
            withheld = rng.random() < 0.5
            for name, index in at.items():
                part = index[lo + a : lo + b].copy()
                if withheld and name in _CONTEXT:
                    part[:] = 0 if name == "shape_before" else _WORDS
                columns[name].append(part)
    if not all_tags:
        return field
    n = len(all_tags)
    tags, mask = np.zeros((n, _TRAIN_TOKENS), np.int64), np.zeros((n, _TRAIN_TOKENS), bool)
    padded = {k: np.zeros((n, _TRAIN_TOKENS), np.int64) for k in columns}
    for k, x in enumerate(all_tags):
        tags[k, : len(x)], mask[k, : len(x)] = x, True
        for name in columns:
            padded[name][k, : len(x)] = columns[name][k]
    field.fit(padded, tags, mask)
    return field


def _added(tags: np.ndarray, features: dict[str, np.ndarray]) -> list[tuple[int, int, int]]:
    """(text, first byte, last byte + 1) of the tagged stretches of a slice."""
    on = np.flatnonzero(tags)
    if not len(on):
        return []
    opens = (tags[on] == BEGIN) | np.append(True, (np.diff(on) != 1) | (features["text"][on][1:] != features["text"][on][:-1]))
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(on)) - 1
    return list(zip(features["text"][on[first]].tolist(), features["start"][on[first]].tolist(), features["end"][on[last]].tolist(), strict=True))


def _remains(text: str, start: int, end: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What ordered base spans leave of a span, without white space, quotes and punctuation at the cuts.

    A part without a letter or digit is left out.
    """
    inside = [(x, y) for x, _, y in base if x < end and y > start]
    parts, at = [], start
    for x, y in [*inside, (end, end)]:
        if x > at:
            part = text[at:x]
            a, b = at + len(part) - len(part.lstrip(_AROUND)), at + len(part.rstrip(_AROUND))
            if any(c.isalnum() for c in text[a:b]):
                parts.append((a, b))
        at = max(at, y)
    return parts


def _scan(column: pa.Array, field: Field) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, all spans) of every text of a column."""
    for _, _, data, offsets in text_slices(column):
        features = token_features(data, offsets)
        tags = field.decode(field.emissions(field.columns(features)), features["text"])
        extra: dict[int, list[tuple[int, int]]] = {}
        for text, s, e in _added(tags, features):
            extra.setdefault(text, []).append((s, e))
        for k in range(len(offsets) - 1):
            raw = data[offsets[k] : offsets[k + 1]].tobytes()
            whole = raw.decode("utf-8")
            base = base_spans(whole)
            found = list(base)
            for s, e in extra.get(k, ()):
                a = len(raw[: s - offsets[k]].decode("utf-8"))
                b = a + len(raw[s - offsets[k] : e - offsets[k]].decode("utf-8"))
                found += [(x, 3, y) for x, y in _remains(whole, a, b, base)]
            yield base, sorted(found)


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans, n_crf.

    Spans are kind:start:end in code points, end exclusive. Null and empty texts have none. Rows that
    repeat and ids that are null are scanned like others, and an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for base, found in _scan(batch.column(1), field):
                counts.append([sum(k == kind for _, k, _ in found) for kind in range(4)])
                digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                spans.append(spans_text(found))
            by_kind = np.array(counts, np.int64).reshape(-1, 4)
            columns = [
                batch.column(0),
                *[pa.array(by_kind[:, k]) for k in range(3)],
                pa.array(digests, pa.string()),
                pa.array(spans, pa.string()),
                pa.array(by_kind[:, 3]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long"
    names = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"]
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def redact(docs: DataFrame, field: Field, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; other columns are left alone.

    Spans that overlap or touch are one. A null text stays null, and an empty table gives an empty one.
    """
    schema = docs.schema
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, changed, texts = batch.column(place), np.zeros(batch.num_rows, bool), []
            for k, (_, found) in enumerate(_scan(column, field)):
                if found and column[k].is_valid:
                    changed[k] = True
                    texts.append(_without(column[k].as_py(), found, mark))
            if texts:
                column = pc.replace_with_mask(column, pa.array(changed), pa.array(texts, column.type))
            columns = [column if c == place else x for c, x in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def _without(text: str, found: list[tuple[int, int, int]], mark: str) -> str:
    parts, at = [], 0
    for s, _, e in found:
        if s > at or not parts:
            parts += [text[at:s], mark]
        at = max(at, e)
    return "".join([*parts, text[at:]])
