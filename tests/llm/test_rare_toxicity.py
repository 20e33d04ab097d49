"""Toxicity where toxic texts are rare, and on small tables."""

import random

import pytest

from lexiweave.llm import toxicity


def text(rng, words, bad):
    parts = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(4)]
    if bad:
        parts[rng.randrange(4)] += " nasty fool"
    return ". ".join(parts) + "."


@pytest.mark.parametrize("n,every,sample", [(6000, 200, 300), (60, 10, 6000)])
def test_words_of_rare_toxic_texts_are_learned(spark, n, every, sample):
    rng, words = random.Random(5), [f"{a}{b}ord" for a in "bcdfgklmn" for b in ("ab", "ec", "id", "of", "ug")]
    rows = [(k, text(rng, words, k % every == 0)) for k in range(n)]
    labels = spark.createDataFrame([(k, int(k % every == 0)) for k in range(n)], "doc_id bigint, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, "doc_id bigint, text string"), labels, sample_texts=sample)
    asked = [(k, text(rng, words, k % 5 == 0)) for k in range(200)]
    got = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(asked, "doc_id bigint, text string"), model).collect()}
    assert sum(got[k] for k in got if k % 5 == 0) >= 36
    assert sum(got[k] for k in got if k % 5) <= 4


def test_shares_of_a_sample():
    assert toxicity._shares({0: 10_000, 1: 30}, 6000) == {0: 5970, 1: 30}
    assert toxicity._shares({0: 10_000, 1: 9000}, 6000) == {0: 3000, 1: 3000}
    assert toxicity._shares({0: 10}, 6000) == {0: 10, 1: 0}
