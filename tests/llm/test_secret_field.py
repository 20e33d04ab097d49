"""What the trained field finds beyond the patterns, and what it leaves alone."""

import random
import string

import pytest

from lexiweave.llm import secrets

LETTERS = string.ascii_letters + string.digits


def word(rng):
    return "".join(rng.choice(["an", "er", "tion", "ou", "th", "ble", "é", "de"]) for _ in range(rng.randrange(1, 8)))


def prose(rng, n):
    parts = []
    for _ in range(n):
        w = word(rng)
        odd = rng.random()
        if odd < 0.02:
            w = f"{word(rng)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.org"
        elif odd < 0.04:
            w = ".".join(str(rng.randrange(256)) for _ in range(4))
        elif odd < 0.05:
            w = str(rng.randrange(10**15, 10**16))
        elif odd < 0.06:
            w = f"https://{word(rng)}.example.com/{word(rng)}/{rng.randrange(2000)}"
        elif odd < 0.08:
            w = rng.choice(["2024-05-17", "12:30", "ISO-8859-1", "x86_64", "COVID19", "3,141.59"])
        elif odd < 0.1:
            w = w.capitalize() + rng.choice([".", "###", "!!", "&&&", ","])
        parts.append(w)
    return parts


@pytest.fixture(scope="module")
def field(spark):
    rng, rows = random.Random(8), []
    for k in range(400):
        parts = prose(rng, rng.randrange(40, 200))
        if k % 3 == 0:
            value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            at = rng.randrange(len(parts))
            parts[at:at] = rng.choice([["token", "=", f'"{value}"'], ["token", "=", f'"{value}"###'], ["AKIA" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(16))], [f"password={value}"]])
        rows.append((k, " ".join(parts)))
    return secrets.train(spark.createDataFrame(rows, "doc_id bigint, text string"))


def spans(spark, field, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in secrets.scan(docs, field).collect()}
    return [got[k] for k in range(len(texts))]


@pytest.mark.parametrize("before", ["credential ", "pwd: ", "bearer ", "ghp_", "private_key = ", ""])
def test_secrets_outside_the_patterns_are_found(spark, field, before):
    rng, texts, want = random.Random(9), [], []
    while len(texts) < 10:
        value = "".join(rng.choice(LETTERS) for _ in range(40))
        head = " ".join(prose(rng, 20))
        text = f"{head} {before}{value} {' '.join(prose(rng, 20))}"
        if not secrets.base_spans(text):
            texts.append(text)
            want.append((text.index(value), text.index(value) + len(value)))
    got = spans(spark, field, texts)
    found = [any(s.startswith("crf") and int(s.split(":")[1]) <= a and b <= int(s.split(":")[2]) for s in r.spans.split(",")) for r, (a, b) in zip(got, want, strict=True)]
    assert sum(found) >= 8
    assert all(r.n_assign + r.n_access + r.n_hex == 0 for r in got)


def test_clean_texts_are_left_alone(spark, field):
    rng = random.Random(10)
    got = spans(spark, field, [" ".join(prose(rng, 100)) for _ in range(1000)])
    assert sum(r.n_crf for r in got) <= 1


def test_punctuation_alone_is_no_span(spark, field):
    value = "0123456789abcdef" * 2
    got = spans(spark, field, [f'token = "{value}"###', f"token = '{value}'!!", "### !! ###", f"&&& {value} &&&"])
    assert [r.n_crf for r in got] == [0, 0, 0, 0]


def test_empty_table_and_very_long_text(spark, field):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert secrets.scan(docs, secrets.train(docs)).count() == 0
    assert secrets.redact(docs, field).count() == 0
    rng = random.Random(11)
    long = " ".join(prose(rng, 200_000)) + " token=abcdef0123"
    row = spans(spark, field, [long])[0]
    assert row.n_assign == 1 and row.spans.endswith(f"assign:{len(long) - 16}:{len(long)}")
