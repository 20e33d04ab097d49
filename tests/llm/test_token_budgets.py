"""Budgets answered from stored prefix counts, and empty tables."""

import public_tokenizers
from tokenizers import Tokenizer

from lexiweave.llm import tokencounts


def test_budgets_equal_the_library_at_every_prefix(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", None, "one two  three's é 日本語 " * 4, "a", "  \n\n x<|endoftext|>y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counted = tokencounts.token_counts(docs, with_prefixes=True)
    budgets = (0, 1, 5, 12, 1000)
    got = {(r.doc_id, r.budget): r.chars for r in tokencounts.budget_prefixes(counted, budgets).collect()}
    for i, text in enumerate(texts):
        sizes = [len(library.encode((text or "")[:k], add_special_tokens=False).ids) for k in range(len(text or "") + 1)]
        for b in budgets:
            assert got[i, b] == max(k for k, n in enumerate(sizes) if n <= b), (i, b)
    assert len(got) == len(texts) * len(budgets)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    counted = tokencounts.token_counts(docs, with_prefixes=True)
    assert counted.count() == 0 and tokencounts.budget_prefixes(counted, (5,)).count() == 0
