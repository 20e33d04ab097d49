"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from lexiweave.llm import spelling


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "keep", 7) for i, t in rows], "doc_id bigint, text string, word string, n int")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = (a, b) if len(a) < len(b) else (b, a)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, told = {}, {}
    for w, n in vocab.items():
        others = [v for v in vocab if near(w, v)]
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 2 * n else None
        told[w] = (n, len(others))
    out = set()
    for w, (n, n_near) in told.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, n_near, vocab.get(form[w])))
    return out


def found(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def texts(seed, size):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé×") for _ in range(rng.choice([4, 5, 6, 9]))) for _ in range(40)]
    rows = []
    for i in range(size):
        parts = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.15)), 39)]
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abÉ") + w[k:], w[:k] + "d" + w[k + 1 :]])
            parts.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", ",", "7"]).join(parts)))
    return rows


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 256])
def test_variants_equal_brute_force(spark, filter_bytes):
    rows = texts(2, 120) + [(None, "hello hello hellp hello hellp hellp"), (500, None), (501, ""), (3, "hello world")]
    assert found(spelling.variants(docs_of(spark, rows), filter_bytes=filter_bytes)) == brute(rows)


def test_long_words_and_repeated_letters(spark):
    long = "ab" * 400
    rows = [(None, f"{long} {long}b {long[:-1]}x " * 3 + "aaaaaa aaaaaaa aaaaaaaa " * 4)]
    assert found(spelling.variants(docs_of(spark, rows))) == brute(rows)


def test_chains_ties_and_empty_tables(spark):
    # aaaab -> aaabb -> aabbb by counts 3, 6, 12; ccccc has two forms of equal counts.
    rows = [(None, "aaaab " * 3 + "aaabb " * 6 + "aabbb " * 12 + "ccccc " * 3 + "ccccd " * 6 + "cccce " * 6)]
    got = found(spelling.variants(docs_of(spark, rows)))
    assert ("aaaab", "aaabb", "aabbb", 3, 1, 6) in got and ("ccccc", "ccccd", "ccccd", 3, 2, 6) in got
    assert got == brute(rows)
    assert found(spelling.variants(docs_of(spark, []))) == set()
    assert found(spelling.variants(docs_of(spark, [(1, None), (2, "")]))) == set()


def test_rounds_hold_every_word_and_keep_their_bound():
    counts = {5: 4000, 6: 10, 7: 300}
    rounds = spelling.plan_rounds(counts, 1024)
    assert len(rounds) > 2
    for shards in rounds:
        assert sum(s.blocks for s in shards.values()) * 8 <= 1024
    pieces = {k: sorted(r[k].piece for r in rounds if k in r) for k in counts}
    assert all(pieces[k] == list(range(next(r[k] for r in rounds if k in r).pieces)) for k in counts)
