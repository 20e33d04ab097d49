"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text as bytes in windows, forwards and backwards, and gives every position a
distribution over the languages; a text gets the mean of its positions. Its weights are trained in
numpy by backpropagation through time on a bounded sample of labelled windows and travel to the
tasks as a few kilobytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiweave.llm.batches import fresh, text_slices

HIDDEN = 8
# Bytes that the network reads before its state starts anew. Every byte of a text is read.
WINDOW = 96
UNKNOWN = "und"
# Windows drawn per language for training, from as many documents: the bound of the sample.
SAMPLE_WINDOWS = 1500
# Labels with the most documents that are learned; a table with more languages needs a larger value.
MAX_LANGUAGES = 200


class BiGru:
    """Weights of both directions, stacked in the first axis: 0 reads forwards, 1 backwards."""

    names = ("wz", "wr", "wn", "uz", "ur", "un", "out", "bias")

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.classes, self.hidden = classes, hidden
        for name in ("wz", "wr", "wn"):
            setattr(self, name, (0.3 * rng.standard_normal((2, 256, hidden))).astype(np.float32))
        for name in ("uz", "ur", "un"):
            setattr(self, name, (rng.standard_normal((2, hidden, hidden)) / hidden**0.5).astype(np.float32))
        self.out = (0.3 * rng.standard_normal((2, hidden, len(classes)))).astype(np.float32)
        self.bias = np.zeros(len(classes), np.float32)

    def train(self, data: np.ndarray, labels: np.ndarray, steps: int = 260, batch: int = 128, rate: float = 0.02) -> None:
        """Adam on the mean cross-entropy of all positions; ``data`` is (windows, bytes)."""
        rng = np.random.default_rng(5)
        first = {k: np.zeros_like(getattr(self, k)) for k in self.names}
        second = {k: np.zeros_like(getattr(self, k)) for k in self.names}
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(data), batch)
            slope = self.gradients(data[rows], labels[rows])[1]
            norm = float(np.sqrt(sum((g * g).sum() for g in slope.values())))
            pace = rate * (1 - 0.9 * step / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in slope.items():
                g = g / max(1.0, norm)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                getattr(self, k)[...] -= pace * first[k] / (np.sqrt(second[k]) + 1e-8)

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions and its slopes, by backpropagation through time."""
        n, length = data.shape
        reads = np.stack([data, data[:, ::-1]])
        way = np.arange(2)[:, None]
        state, kept = np.zeros((2, n, self.hidden), np.float32), []
        states = np.zeros((length, 2, n, self.hidden), np.float32)
        for t in range(length):
            byte = reads[:, :, t]
            z = _sigmoid(self.wz[way, byte] + state @ self.uz)
            r = _sigmoid(self.wr[way, byte] + state @ self.ur)
            new = np.tanh(self.wn[way, byte] + (r * state) @ self.un)
            kept.append((state, z, r, new, byte))
            state = state + z * (new - state)
            states[t] = state
        scores = states[:, 0] @ self.out[0] + states[::-1, 1] @ self.out[1] + self.bias
        p = _softmax(scores)
        at = (np.arange(length)[:, None], np.arange(n)[None, :], labels[None, :])
        loss = float(-np.log(p[at] + 1e-9).mean())
        p[at] -= 1
        p /= n * length
        slope = {k: np.zeros_like(getattr(self, k)) for k in self.names}
        slope["bias"] = p.sum(axis=(0, 1))
        slope["out"][0] = np.einsum("tnh,tnc->hc", states[:, 0], p)
        slope["out"][1] = np.einsum("tnh,tnc->hc", states[::-1, 1], p)
        above = np.stack([p @ self.out[0].T, (p @ self.out[1].T)[::-1]], axis=1)
        carry = np.zeros_like(state)
        for t in range(length - 1, -1, -1):
            state, z, r, new, byte = kept[t]
            grad = above[t] + carry
            d_new = grad * z * (1 - new * new)
            d_z = grad * (new - state) * z * (1 - z)
            back = d_new @ self.un.transpose(0, 2, 1)
            d_r = back * state * r * (1 - r)
            carry = grad * (1 - z) + back * r + d_z @ self.uz.transpose(0, 2, 1) + d_r @ self.ur.transpose(0, 2, 1)
            turned = state.transpose(0, 2, 1)
            slope["uz"] += turned @ d_z
            slope["ur"] += turned @ d_r
            slope["un"] += (r * state).transpose(0, 2, 1) @ d_new
            for name, d in (("wz", d_z), ("wr", d_r), ("wn", d_new)):
                for k in (0, 1):
                    np.add.at(slope[name][k], byte[k], d[k])
        return loss, slope

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (position, window, class) of windows (window, position)."""
        length, n = data.shape[1], data.shape[0]
        columns = np.ascontiguousarray(data.T).astype(np.intp)
        scores = np.empty((length, n, len(self.classes)), np.float32)
        for way, order in ((0, range(length)), (1, range(length - 1, -1, -1))):
            # Half of a sigmoid's argument goes through tanh: sigmoid(x) = tanh(x / 2) / 2 + 1 / 2.
            wz, wr, wn = self.wz[way] / 2, self.wr[way] / 2, self.wn[way]
            uz, ur, un, out = self.uz[way] / 2, self.ur[way] / 2, self.un[way], self.out[way]
            state = np.zeros((n, self.hidden), np.float32)
            z, r, new, part = (np.empty_like(state) for _ in range(4))
            for t in order:
                byte = columns[t]
                np.matmul(state, uz, out=part)
                np.take(wz, byte, axis=0, out=z, mode="clip")
                z += part
                np.tanh(z, out=z)
                np.matmul(state, ur, out=part)
                np.take(wr, byte, axis=0, out=r, mode="clip")
                r += part
                np.tanh(r, out=r)
                r += 1
                r *= state
                r *= 0.5
                np.matmul(r, un, out=part)
                np.take(wn, byte, axis=0, out=new, mode="clip")
                new += part
                np.tanh(new, out=new)
                new -= state
                z += 1
                z *= new
                z *= 0.5
                state += z
                if way:
                    scores[t] += state @ out
                else:
                    np.matmul(state, out, out=scores[t])
        scores += self.bias
        return _softmax(scores)

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean of the position probabilities of every text in a slice; empty texts get zeros."""
        lengths = np.diff(offsets)
        n_windows = -(-lengths // WINDOW)
        total = np.zeros((len(lengths), len(self.classes)))
        row = np.repeat(np.arange(len(lengths)), n_windows)
        number = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        begin = offsets[row] + number * WINDOW
        size = np.minimum(WINDOW, offsets[row + 1] - begin)
        reach = np.arange(WINDOW)
        for at in range(0, len(row), _READ):
            some = slice(at, at + _READ)
            inside = reach < size[some][:, None]
            # Short windows end in blanks, as in training, so a text is read alike whatever stands beside it.
            read = np.where(inside, data[np.minimum(begin[some][:, None] + reach, len(data) - 1)], 32).astype(np.uint8)
            np.add.at(total, row[some], np.einsum("tnc,nt->nc", self.positions(read), inside.astype(np.float32)))
        return total / np.maximum(lengths, 1)[:, None]


# Windows that are read at a time.
_READ = 1024


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * 0.5) * 0.5 + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


def train(
    docs: DataFrame,
    usable: Column | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_windows: int = SAMPLE_WINDOWS,
    max_languages: int = MAX_LANGUAGES,
    hidden: int = HIDDEN,
    steps: int = 260,
) -> BiGru | None:
    """Fit the network on at most ``sample_windows`` windows per language; None without labelled text.

    More languages than ``max_languages`` are an error, so none gets the name of another one.

    A window is taken at a place of the text that depends on the text's hash. Rows are chosen by that
    hash as well, at a rate that follows the count of their language, so only the sample is sent.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    if usable is not None:
        labelled = labelled.where(usable)
    labelled = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = labelled.groupBy("lang").count().limit(max_languages + 1).collect()
    if not counts:
        return None
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages have labels; raise max_languages")
    classes = sorted(x["lang"] for x in counts)
    digest = F.xxhash64("text")
    rate = F.create_map(*[F.lit(x) for c in counts for x in (c["lang"], sample_windows / c["count"])])
    start = F.pmod(F.xxhash64(digest), F.greatest(F.length("text") - WINDOW, F.lit(1))) + 1
    window = F.substring(F.col("text"), start.cast("int"), F.lit(WINDOW)).cast("binary")
    drawn = (
        labelled.where(F.pmod(F.xxhash64(digest, F.lit(3)), F.lit(1 << 20)) < F.try_element_at(rate, F.col("lang")) * (1 << 20))
        .select(window.alias("window"), "lang", digest.alias("digest"))
        .orderBy("digest")
        .limit(2 * sample_windows * len(classes))
        .collect()
    )
    data = np.full((len(drawn), WINDOW), 32, np.uint8)
    for k, x in enumerate(drawn):
        found = np.frombuffer(bytes(x["window"])[:WINDOW], np.uint8)
        data[k, : len(found)] = found
    if not len(data):
        return None
    number = {c: k for k, c in enumerate(classes)}
    labels = np.array([number[x["lang"]] for x in drawn])
    # As many windows of every language in the batches.
    weight = 1 / np.bincount(labels, minlength=len(classes))[labels]
    rows = np.random.default_rng(3).choice(len(data), len(data), p=weight / weight.sum())
    model = BiGru(classes, hidden)
    model.train(data[rows], labels[rows], steps=steps)
    return model


def predict(docs: DataFrame, model: BiGru | None, text_col: str = "text") -> DataFrame:
    """Append ``lang_pred`` and ``score``, the pooled probability of that language.

    Texts that are null or have no letter are ``und`` with score 0, as is every text without a model.
    All other columns pass through, except earlier ones of these two names.
    """
    docs = docs.drop("lang_pred", "score")
    flag = fresh("_letters", docs.columns)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    source = docs.select(*kept, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias(flag))
    place = docs.columns.index(text_col)
    schema = docs.schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            letters = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            if model is not None:
                for first, end, data, offsets in text_slices(batch.column(place)):
                    chances = model.pooled(data, offsets)
                    best = chances.argmax(axis=1)
                    for k in np.flatnonzero(letters[first:end]).tolist():
                        labels[first + k] = model.classes[best[k]]
                        scores[first + k] = min(1.0, float(chances[k, best[k]]))
            columns = [*batch.columns[:-1], pa.array(labels, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return source.mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: BiGru | None, text_col: str = "text", min_score: float = 0.3) -> DataFrame:
    """Rows whose language is known with at least ``min_score``, with the columns they came with.

    Null texts and texts without a letter go. Without a model every text with a letter stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if model is None:
        return docs.where(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    renamed = {c: fresh(f"_{c}", docs.columns) for c in ("lang_pred", "score")}
    found = predict(docs.withColumnsRenamed(renamed), model, text_col)
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({v: k for k, v in renamed.items()}).select(*columns)
