"""Weighted SimHash fingerprints: likeness of edited texts, and near fingerprints against brute force."""

import hashlib
import random

import numpy as np

from lexiweave.llm import fingerprints


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "keep", 7) for i, t in rows], "doc_id bigint, text string, part string, kind int")


def sentence(rng, n):
    return " ".join(f"w{int(rng.expovariate(0.004))}" for _ in range(n))


def plain(text):
    """Votes of the terms of a text one by one."""
    data = np.frombuffer(text.encode(), np.uint8)
    owner, term, weight = fingerprints.weighted_terms(data, np.array([0, len(data)]))
    votes = [0] * fingerprints.BITS
    for t, w in zip(term.tolist(), weight.tolist(), strict=True):
        streams = [fingerprints.scramble(np.array([t], np.uint64) + s)[0] for s in fingerprints._STREAMS]
        bits = "".join(f"{b:08b}" for s in streams for b in int(s).to_bytes(8, "little"))
        votes = [v + (w if b == "1" else -w) for v, b in zip(votes, bits, strict=True)]
    return f"{int(''.join('1' if v > 0 else '0' for v in votes), 2):064x}"


def test_rows_follow_in_order_of_ids(spark):
    rng = random.Random(5)
    rows = [(3 * k, sentence(rng, rng.choice([0, 1, 5, 80]))) for k in range(60)]
    rows += [(1000, None), (1001, "é" * 9 + " 🙂🙂"), (1002, sentence(rng, 30000))]
    mixed = rng.sample(rows, len(rows))
    got = {r.doc_id: r for r in fingerprints.edit_likeness(docs_of(spark, mixed).repartition(5)).collect()}
    assert len(got) == len(rows)
    texts = [t or "" for _, t in sorted(rows)]
    for k, (i, _) in enumerate(sorted(rows)):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        other = text[: len(text) - half] + after[:half]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        if len(text) < 1000:
            assert row.fingerprint == plain(text) and row.edited_fingerprint == plain(other)
        equal = 256 - (int(row.fingerprint, 16) ^ int(row.edited_fingerprint, 16)).bit_count()
        assert row.near_edited == equal / 256
        equal = 256 - (int(row.fingerprint, 16) ^ int(got[sorted(rows)[(k + 1) % len(rows)][0]].fingerprint, 16)).bit_count()
        assert row.near_next == equal / 256


def test_edited_texts_are_nearer_than_other_texts(spark):
    rng = random.Random(6)
    rows = [(k, sentence(rng, rng.choice([40, 100, 300]))) for k in range(150)]
    got = fingerprints.edit_likeness(docs_of(spark, rows)).collect()
    assert sum(r.near_edited > r.near_next for r in got) >= 145
    assert min(r.near_edited for r in got) > 0.55


def test_edge_cases(spark):
    one = fingerprints.edit_likeness(docs_of(spark, [(4, "a b c d")])).collect()
    assert [(r.doc_id, r.near_next, r.edited_sha256) for r in one] == [(4, 1.0, hashlib.sha256(b"a b a b").hexdigest())]
    assert fingerprints.edit_likeness(docs_of(spark, [])).count() == 0
    assert fingerprints.document_fingerprints(docs_of(spark, [])).count() == 0
    rows = [(None, "x y"), (None, None), (5, "same text"), (5, "same text"), (6, "same text"), (7, "")]
    got = fingerprints.document_fingerprints(docs_of(spark, rows)).collect()
    assert len(got) == 6 and len({r.fingerprint for r in got if r.doc_id in (5, 6)}) == 1
    assert {r.group_id for r in got if r.doc_id in (5, 6)} == {5}
    empty = [r for r in got if r.n_chars == 0]
    assert {r.fingerprint for r in empty} == {"0" * 64} and {r.group_id for r in empty} == {7}
    assert [(r.n_near, r.group_id) for r in got if r.n_chars == 3] == [(None, None)]


def test_block_tables_find_every_pair_within_the_radius(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(256) for _ in range(6)]
    prints = set(base)
    for b in base:
        for _ in range(40):
            for at in rng.sample(range(256), rng.randrange(12)):
                b ^= 1 << at
            prints.add(b)
    prints = sorted(prints)
    rows = [(k, f"{p:064x}") for k, p in enumerate(prints)] + [(999, f"{prints[4]:064x}")]
    for radius, block_rows in ((8, 2048), (3, 16), (0, 2048)):
        near = [[j for j, q in enumerate(prints) if j != i and (p ^ q).bit_count() <= radius] for i, p in enumerate(prints)]
        group = list(range(len(prints)))
        while True:
            new = [min([group[i], *[group[j] for j in near[i]]]) for i in range(len(prints))]
            if new == group:
                break
            group = new
        table = spark.createDataFrame(rows, "doc_id bigint, fingerprint string")
        got = {r.doc_id: r for r in fingerprints.near_groups(table, radius=radius, block_rows=block_rows).collect()}
        assert [(got[k].n_near, got[k].group_id) for k in range(len(prints))] == [(len(n), g) for n, g in zip(near, group, strict=True)]
        assert (got[999].n_near, got[999].group_id) == (len(near[4]), group[4])
