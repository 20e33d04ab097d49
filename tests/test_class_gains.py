"""Scores of classes over blocks of rows."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexiweave.operators import models as M
from lexiweave.operators.class_gains import block_gains


@pytest.mark.parametrize("chunk", [1, 40, 1 << 21])
def test_gains_of_a_block_equal_a_plain_loop(chunk):
    rng = random.Random(chunk)
    terms = {i: [(c, rng.random()) for c in sorted(rng.sample(range(9), rng.randrange(1, 9)))] for i in rng.sample(range(100), 60)}
    entries = [(f"d{rng.randrange(30)}", rng.randrange(100), float(rng.randrange(1, 5))) for _ in range(500)]
    want = {}
    for doc, idx, value in entries:
        for label, more in terms.get(idx, ()):
            want[doc, label] = want.get((doc, label), 0.0) + value * more
    left = pa.table({"doc": [e[0] for e in entries], "idx": [e[1] for e in entries], "value": [e[2] for e in entries], "block": [0] * len(entries)})
    right = pa.table({"term": list(terms), "labels": [[c for c, _ in t] for t in terms.values()], "more": [[m for _, m in t] for t in terms.values()]})
    got = {(r["doc"], r["label"]): r["gain"] for r in block_gains("doc", chunk)(left, right).to_pylist()}
    assert got == pytest.approx(want)
    assert len(block_gains("doc", chunk)(left, right.slice(0, 0))) == 0


@pytest.mark.parametrize("entries", [1 << 21, 50])
def test_no_row_is_made_per_entry_and_class(spark, entries, monkeypatch):
    monkeypatch.setattr(M, "SCORE_ENTRIES", entries)
    n_docs, n_terms, n_classes = 40, 12, 5
    long = spark.range(n_docs).select(F.col("id").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.lit(n_terms - 1))).alias("idx"), F.lit(2.0).alias("value"))
    seen = [(float(c), i, 0.5 * c + i) for c in range(n_classes) for i in range(n_terms) if (c + i) % 3]
    model = M.NaiveBayesTables(
        spark.createDataFrame(seen, "label double, idx int, log_prob double"),
        spark.createDataFrame([(float(c), 0.0, 0.25) for c in range(n_classes)], "label double, log_prior double, unseen double"),
    )
    found = M._gains(model, long, "doc_id")
    want = {c: sum(2 * (p - 0.25) for k, i, p in seen if k == c) for c in range(n_classes)}
    assert rows(found.select("doc_id", "label", F.round("gain", 9))) == [(d, float(c), round(want[c], 9)) for d in range(n_docs) for c in range(n_classes)]
    # Entries meet the classes of their term in a task; no join has a row per entry and class.
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()
