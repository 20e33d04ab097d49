"""Whitening by bit planes against exact whole numbers and a dense decomposition."""

import math

import numpy as np
import pytest

from lexiweave.llm import whitening


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 5, "keep") for i, v in rows], "vec_id bigint, embedding array<double>, n int, x string")


def test_scatter_is_exact():
    rng = np.random.default_rng(4)
    for high in (2, 900, 1 << 20, 1 << 45):
        block = rng.integers(-high, high, (150, 5))
        sums, products = whitening.scatter(block)
        exact = block.astype(object)
        assert (sums == exact.sum(axis=0)).all()
        assert (products == exact.T @ exact).all()


def whole(vector):
    return [math.floor(1024 * v) + 100000 for v in vector]


def test_whitening_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(10, 10))
    vectors = (rng.normal(size=(300, 10)) @ mix).tolist()
    rows = [(k, v) for k, v in enumerate(vectors)] + [(7, vectors[7]), (None, vectors[3])]
    bad = [(900, None), (901, [1.0, None] + [0.0] * 8), (902, [float("nan")] * 10), (903, [float("-inf")] + [0.0] * 9), (904, [])]
    got = whitening.whiten(table_of(spark, rows + bad)).collect()
    x = [whole(v) for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    assert len(got) == n * 8 and {r.n for r in got} == {n}
    deviation = {(i, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for (i, _), v in zip(rows, x, strict=True)}
    assert {(r.vec_id, r.deviation) for r in got} == deviation
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    want = centred @ axes / np.sqrt(values)
    by_id = {(r.vec_id, r.component): r for r in got}
    for k in range(8):
        mine = np.array([by_id[i, k + 1].whitened for i, _ in rows])
        sign = np.sign(mine @ want[:, k])
        assert np.allclose(mine, sign * want[:, k], atol=1e-8)
        assert by_id[0, k + 1].explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
    assert max(r.identity_error for r in got) < 1e-9


def test_lengths_and_components_without_variance(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [0.5]), (4, [0.5]), (5, [1e30, 0.0])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(table_of(spark, rows)).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1)}
    assert abs(got[1, 1].whitened) == pytest.approx(1.0) and got[1, 2].whitened is None
    assert got[1, 1].explained == pytest.approx(1.0) and got[3, 1].explained == 0.0
    assert got[3, 1].whitened is None and got[3, 1].n == 2 and got[3, 1].deviation == 0
    assert got[1, 1].deviation == 1024**2 and got[1, 1].identity_error < 1e-9


def test_large_entries_and_empty_table(spark):
    rows = [(k, [float(k % 3) * 4e9, float(k)]) for k in range(9)]
    got = whitening.whiten(table_of(spark, rows)).collect()
    assert len(got) == 18 and all(r.deviation is None for r in got if r.vec_id % 3 != 1)
    assert max(r.identity_error for r in got) < 1e-6
    assert whitening.whiten(table_of(spark, [])).count() == 0
    assert whitening.whiten(table_of(spark, [(1, None)])).count() == 0
