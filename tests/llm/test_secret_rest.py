"""Secrets that go on past what the patterns find."""

import numpy as np

from lexiweave.llm import secrets


def test_rest_of_a_secret_is_kept_and_redacted(spark):
    field = secrets.Field()
    # Every token is inside of one stretch.
    field.file[:, secrets.INSIDE] = 9.0
    hexes = "0123456789abcdef" * 2
    texts = ["password=hunter2!Zq9$Lm", f'"token": "{hexes}",', f"{hexes} Xy77 zz", "é x", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [r.spans for r in secrets.scan(docs, field).collect()]
    assert got == ["assign:0:16,crf:16:23", "assign:1:42,hex:10:42", "hex:0:32,crf:33:40", "crf:0:3", "", ""]
    clean = [r.text for r in secrets.redact(docs, field).collect()]
    assert clean == ["<secret>", '"<secret>",', "<secret> <secret>", "<secret>", None, ""]


def test_parts_between_base_spans():
    text = "ab password=hunter2 cd token=abcdefg ef"
    base = secrets.base_spans(text)
    assert [text[a:b] for a, b in secrets._remains(text, 0, len(text), base)] == ["ab", "cd", "ef"]
    assert secrets._remains(text, 0, 2, base) == [(0, 2)]
    assert np.all([b > a for a, b in secrets._remains(text, 3, 21, base)])
