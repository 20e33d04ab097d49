"""More languages than the bound."""

import pytest

from lexiweave.llm import langid


def test_languages_beyond_the_bound_are_an_error(spark):
    rows = [(f"text of language {k}", f"l{k % 3}") for k in range(9)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    with pytest.raises(ValueError, match="more than 2"):
        langid.train(docs, max_languages=2)
    assert langid.train(docs, max_languages=3, steps=1).classes == ["l0", "l1", "l2"]
