"""Quality by hierarchical empirical Bayes.

A document classifier gives every text a likelihood ratio for good quality. Grouped sums of its
probabilities give the posterior of every path of a site, shrunk toward the posterior of its host,
which is shrunk toward the global rate. How strongly they shrink is estimated from how much hosts and
paths differ beyond what their counts explain, so sparse sites lean on what is above them. The
posterior of a document joins its own evidence to the prior of its path without itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiweave.llm.batches import IS_SPACE, byte_symbols, drawn, span_hashes, text_slices, words
from lexiweave.runtime import lookup_join, materialize

THRESHOLD = 0.5
# Bound of the training sample: labelled texts whose features are sent to the driver.
SAMPLE_TEXTS = 20000
# Least and largest number of documents that a prior weighs as much as.
_STRENGTH = (2.0, 10000.0)

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_PLAIN = np.zeros(256, bool)
_IS_PLAIN[[ord(c) for c in ".,;:!?'\"()-"]] = True
FEATURES = 14


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, feature): length, shares of kinds of bytes, word lengths, repeated words and lines."""
    count = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first)
    many = np.maximum(n_words, 1)
    text = np.repeat(np.arange(count), n_words)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    odd = ~(_IS_LETTER | _IS_DIGIT | _IS_PLAIN | IS_SPACE)
    length = (ends - starts).astype(float)
    symbols = byte_symbols(data)
    hashes = span_hashes(symbols, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    distinct = np.bincount(_first_of_kind(text, hashes), minlength=count) / many
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:] |= data == 10
    bounds = np.flatnonzero(edge)
    begin, end = bounds[:-1], bounds[1:]
    line_text = np.searchsorted(offsets, begin, side="right") - 1
    n_lines = np.maximum(np.bincount(line_text, minlength=count), 1) if len(begin) else np.ones(count)
    lines = span_hashes(symbols, begin, end) if len(begin) else np.zeros(0, np.uint64)
    new_lines = np.bincount(_first_of_kind(line_text, lines), minlength=count) / n_lines
    ends_odd = odd[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    columns = [
        np.log1p(n_words), np.log1p(n_words) ** 2 / 10, share(_IS_LETTER[data]), share(_IS_UPPER[data]),
        share(_IS_DIGIT[data]), share(odd[data]), share(_IS_PLAIN[data]), share(data == 124),
        np.bincount(text, length, count) / many, np.bincount(text, length**2, count) / many / 10,
        distinct, new_lines, np.log1p(n_lines), np.bincount(text, ends_odd, count) / many,
    ]
    return np.stack(columns, axis=1)


def _first_of_kind(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Texts of the distinct (text, hash) pairs."""
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return t[new]


class Classifier:
    """Logistic regression on standardised features and their squares."""

    def __init__(self):
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.weights, self.rate = np.zeros(2 * FEATURES + 1), 0.5

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z / 4, np.ones((len(z), 1))], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> None:
        """Newton steps on the ridge-penalised likelihood."""
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        self.rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        z = self._inputs(x)
        for _ in range(rounds):
            p = np.exp(-np.logaddexp(0, -z @ self.weights))
            slope = z.T @ (y - p) - ridge * self.weights
            curve = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(z.shape[1])
            step = np.linalg.solve(curve, slope)
            self.weights += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of good quality: the logit without the rate of the sample."""
        return np.clip(self._inputs(x) @ self.weights - np.log(self.rate / (1 - self.rate)), -12, 12)


def _with_features(docs: DataFrame, text_col: str, extra: list[str], make, out: str, kind: str) -> DataFrame:
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(features(data, offsets)) for _, _, data, offsets in text_slices(batch.column(0))]
            column = [v for part in made for v in part.tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(column, pa.list_(pa.float64()) if kind != "double" else pa.float64())], [*extra, out])

    return docs.select(F.col(text_col), *extra).mapInArrow(run, f"{fields}, {out} {kind}")


def train(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_texts: int = SAMPLE_TEXTS,
) -> Classifier:
    """Fit the classifier on the features of about ``sample_texts`` labelled texts; null labels are left out."""
    known = labels.where(F.col(label_col).isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy(id_col).agg((F.max(label_col) > 0).cast("int").alias("label"))
    sample = drawn(known, F.col(id_col), sample_texts, known.count())
    joined = docs.select(id_col, text_col).join(F.broadcast(sample), id_col)
    rows = _with_features(joined, text_col, ["label"], lambda x: x, "x", "array<double>").limit(4 * sample_texts).toPandas()
    model = Classifier()
    if len(rows):
        model.fit(np.array(rows["x"].tolist()), rows["label"].to_numpy().astype(float))
    return model


def _strength(rate: Column, total: Column, n: Column, above: Column) -> Column:
    """Weight of a prior in documents, by moments: spread of the group rates beyond their sampling noise."""
    noise = F.sum(above * (1 - above))
    spread = F.sum(n * (rate - above) ** 2)
    between = F.greatest((spread - noise) / F.greatest(F.sum(n), F.lit(1.0)), F.lit(1e-9))
    mean = F.sum(total) / F.sum(n)
    return F.least(F.greatest(mean * (1 - mean) / between - 1, F.lit(_STRENGTH[0])), F.lit(_STRENGTH[1]))


def posteriors(
    docs: DataFrame, model: Classifier, host_col: str, path_col: str, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, evidence, host_rate, path_rate, score, kept) of every row.

    Rows with a null host or path share one site. Null and empty texts are scored by their features
    like others; null and repeated ids are scored as separate documents. An empty table gives no rows.
    """
    sited = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).alias("host"),
        F.coalesce(F.col(path_col).cast("string"), F.lit("\0")).alias("path"),
    )
    scored = _with_features(sited, "text", ["id", "host", "path"], model.evidence, "evidence", "double")
    rate = float(np.log(model.rate / (1 - model.rate)))
    chance = 1 / (1 + F.exp(-(F.col("evidence") + rate)))
    scored = materialize(scored.withColumn("p", chance), "evidence")
    paths = materialize(scored.groupBy("host", "path").agg(F.sum("p").alias("good"), F.count("*").cast("double").alias("n")), "paths")
    hosts = materialize(paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "hosts")
    whole = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    mean = (whole["good"] + 1) / (whole["n"] + 2) if whole["n"] else 0.5
    weight = hosts.agg(_strength(F.col("good") / F.col("n"), F.col("good"), F.col("n"), F.lit(mean)).alias("k")).first()["k"]
    weight = weight or _STRENGTH[0]
    hosts = hosts.select("host", ((F.col("good") + weight * mean) / (F.col("n") + weight)).alias("host_rate"))
    paths = materialize(lookup_join(paths, materialize(hosts, "host_rates"), ["host"], ["path"]), "path_counts")
    inner = paths.agg(_strength(F.col("good") / F.col("n"), F.col("good"), F.col("n"), F.col("host_rate")).alias("k")).first()["k"]
    inner = inner or _STRENGTH[0]
    found = lookup_join(scored, paths, ["host", "path"], ["id", "evidence"])
    # The prior of a document is that of its path without the document's own share.
    path_rate = (F.col("good") - F.col("p") + inner * F.col("host_rate")) / (F.col("n") - 1 + inner)
    path_rate = F.least(F.greatest(path_rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(path_rate / (1 - path_rate)))))
    return found.select(
        F.col("id").alias(id_col), "evidence", "host_rate", path_rate.alias("path_rate"), score.alias("score"), (score >= threshold).alias("kept")
    )
