"""Toxicity by multiple-instance learning.

A text is a bag of sentences. Each sentence has a logistic score of its words, and the text is toxic
if at least one sentence is: the scores combine by noisy-or. Only texts have labels, so training
follows the slope of the text's likelihood through the noisy-or to the sentences. The scores of the
sentences then tell where a text offends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiweave.llm.batches import byte_symbols, char_places, cores, drawn, fold_case, openings, span_hashes, text_slices, words

BUCKETS = 1 << 18
THRESHOLD = 0.3
# Bound of the training sample: labelled texts, and the longest of them in characters.
SAMPLE_TEXTS = 6000
SAMPLE_CHARS = 16000
# A word counts if it occurs in this share of the texts of the rarer label in the sample, as a number
# of texts that is at least the first and at most the second.
LEAST_SHARE = 0.025
LEAST_TEXTS = (2, 8)


def bags(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Words of a slice by sentence: hashed word or first letters, sentence, and text and bounds of the sentences."""
    starts, ends, first = words(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    opens = openings(data, starts, ends, text) if len(starts) else np.zeros(0, bool)
    sentence = np.cumsum(opens) - 1
    head = np.flatnonzero(opens)
    tail = np.append(head[1:], len(starts)) - 1 if len(head) else head
    solid, begin, end = cores(data, starts, ends)
    # A word counts as itself and by its first letters, so inflected forms share what is learned.
    symbols = byte_symbols(fold_case(data))
    found = [span_hashes(symbols, begin, np.minimum(end, begin + n)) + np.uint64(k) for k, n in enumerate((4, 5, 6, len(data) + 1))] if len(solid) else []
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return {
        "word": (hashes % np.uint64(BUCKETS)).astype(np.int64), "sentence": np.tile(sentence[solid], 4),
        "text": text[head], "start": starts[head], "end": ends[tail],
    }


@dataclass
class Part:
    """Texts of a training slice: the number of the first one, its words by sentence and texts of the sentences."""

    first: int
    word: np.ndarray
    sentence: np.ndarray
    text: np.ndarray


class Model:
    """Word weights and the bias of a sentence."""

    def __init__(self):
        self.weights = np.zeros(BUCKETS, np.float32)
        self.bias = -6.0

    def sentences(self, bag: dict[str, np.ndarray]) -> np.ndarray:
        """Logit of every sentence."""
        return self.bias + np.bincount(bag["sentence"], self.weights[bag["word"]], len(bag["text"]))

    def texts(self, logits: np.ndarray, bag: dict[str, np.ndarray], count: int) -> np.ndarray:
        """Noisy-or of the sentences of every text; a text without sentences has that of one without words."""
        silent = np.bincount(bag["text"], np.logaddexp(0, logits), count)
        none = np.bincount(bag["text"], minlength=count) == 0
        silent[none] = np.logaddexp(0, self.bias)
        return -np.expm1(-silent)

    def shift(self, parts: list[Part], labels: np.ndarray, weights: np.ndarray) -> None:
        """Move the bias until the weighted mean of the scores is that of the labels."""
        wanted = float((weights * labels).sum())
        sums = [np.bincount(p.sentence, self.weights[p.word], len(p.text)) for p in parts]
        low, high = self.bias - 40.0, self.bias + 40.0
        for _ in range(60):
            middle, total = (low + high) / 2, 0.0
            for part, sentence in zip(parts, sums, strict=True):
                count = int(part.text[-1]) + 1
                silent = np.bincount(part.text, np.logaddexp(0, middle + sentence), count)
                total += float((weights[part.first : part.first + count] * -np.expm1(-silent)).sum())
            low, high = (low, middle) if total > wanted else (middle, high)
        self.bias = (low + high) / 2

    def fit(self, parts: list[Part], labels: np.ndarray, steps: int = 120, rate: float = 0.25, decay: float = 2e-4) -> None:
        """Adagrad on the mean likelihood of the texts' labels, through the noisy-or.

        ``parts`` hold the words of some texts each, so that only one of them is worked on at a time.
        """
        n = len(labels)
        sentences = sum(len(p.text) for p in parts)
        share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(share / max(1.0, sentences / n)))
        pace, bias_pace = np.full(BUCKETS, 1e-8), 1e-8
        for _ in range(steps):
            grad, bias_grad = decay * self.weights.astype(np.float64), 0.0
            for part in parts:
                count = int(part.text[-1]) + 1 if len(part.text) else 0
                logits = self.bias + np.bincount(part.sentence, self.weights[part.word], len(part.text))
                silent = np.bincount(part.text, np.logaddexp(0, logits), count)
                loud = np.exp(-silent) / np.maximum(-np.expm1(-silent), 1e-9)
                toward = np.where(labels[part.first : part.first + count] == 1, -loud, 1.0)
                slope = np.exp(-np.logaddexp(0, -logits)) * toward[part.text] / n
                grad += np.bincount(part.word, slope[part.sentence], BUCKETS)
                bias_grad += slope.sum()
            pace += grad**2
            self.weights -= (rate * grad / np.sqrt(pace)).astype(np.float32)
            bias_pace += bias_grad**2
            self.bias -= rate * bias_grad / np.sqrt(bias_pace)


def _shares(counts: dict[int, int], size: int) -> dict[int, int]:
    """Texts of each label in a sample of ``size``: half for each, more if the other has fewer."""
    have = {k: counts.get(k, 0) for k in (0, 1)}
    return {k: min(have[k], max(size // 2, size - have[1 - k])) for k in (0, 1)}


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_texts: int = SAMPLE_TEXTS,
    sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """Fit the model on at most about ``sample_texts`` labelled texts, chosen by a hash of their id.

    Each label has up to half of them, and what the rarer one leaves goes to the other. If their shares
    then differ from those of all labels, the bias is moved until the mean score is right for these.
    ``usable`` is a condition on the labels. A sampled text longer than ``sample_chars`` is left out.
    Null labels are left out; without labels the model scores every text alike.
    """
    known = labels.where(F.col(label_col).isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy(id_col).agg((F.max(label_col) > 0).cast("int").alias("label"))
    texts = docs.where(F.length(text_col) <= sample_chars).select(id_col, F.col(text_col).alias("text"))
    # Ids are reduced to the sample first, so that only its texts are moved.
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = _shares(counts, sample_texts)
    sample = drawn(known.where("label = 0"), F.col(id_col), share[0], counts.get(0, 0)).unionByName(
        drawn(known.where("label = 1"), F.col(id_col), share[1], counts.get(1, 0))
    )
    rows = texts.join(F.broadcast(sample), id_col).select("text", "label").limit(2 * sample_texts).toPandas()
    rows = rows.sort_values(["text", "label"], ignore_index=True)
    model = Model()
    if not len(rows):
        return model
    parts, texts_with = [], np.zeros(BUCKETS, np.int64)
    for first, _, data, offsets in text_slices(pa.array(rows["text"])):
        bag = bags(data, offsets)
        if not len(bag["text"]):
            continue
        pairs = np.unique(bag["text"][bag["sentence"]] * BUCKETS + bag["word"])
        texts_with += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
        parts.append(Part(first, bag["word"].astype(np.int32), bag["sentence"].astype(np.int32), bag["text"].astype(np.int32)))
    # Only words that occur often enough move.
    labels_ = rows["label"].to_numpy()
    rarer = int(min(labels_.sum(), len(labels_) - labels_.sum()))
    known = texts_with >= int(np.clip(round(LEAST_SHARE * rarer), *LEAST_TEXTS))
    for part in parts:
        used = known[part.word]
        part.word, part.sentence = part.word[used], part.sentence[used]
    if parts:
        model.fit(parts, labels_)
        if any(share[k] < counts.get(k, 0) for k in share) and 0 < labels_.sum() < len(labels_):
            # What one text of each label stands for.
            stands = np.array([counts[k] / (labels_ == k).sum() for k in (0, 1)])
            model.shift(parts, labels_, stands[labels_])
    return model


def score(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, score, predicted, offending) of every row.

    ``offending`` lists start, end and score of the sentences that reach ``threshold``, in code points.
    Null and empty texts have the score of a text without words. Rows with null or repeated ids are
    scored like others.
    """
    places = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, found = [], [[] for _ in range(batch.num_rows)]
            for first, end, data, offsets in text_slices(batch.column(1)):
                bag = bags(data, offsets)
                logits = model.sentences(bag)
                scores.append(model.texts(logits, bag, end - first))
                chance = np.exp(-np.logaddexp(0, -logits))
                hot = np.flatnonzero(chance >= threshold)
                if len(hot):
                    place, text = char_places(data), bag["text"][hot]
                    base = place[offsets[text]]
                    cells = zip(text.tolist(), (place[bag["start"][hot]] - base).tolist(), (place[bag["end"][hot]] - base).tolist(), chance[hot].tolist(), strict=True)
                    for t, s, e, p in cells:
                        found[first + t].append({"start": s, "end": e, "score": p})
            chances = np.clip(np.concatenate(scores), 0, 1) if scores else np.zeros(0)
            columns = [batch.column(0), pa.array(chances), pa.array((chances >= threshold).astype(np.int32)), pa.array(found, places)]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "score", "predicted", "offending"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, score double, predicted int, offending array<struct<start: long, end: long, score: double>>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
