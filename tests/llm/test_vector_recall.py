"""Links of many vectors against all cosines, with partners planted near the bound."""

import numpy as np
import pytest

from lexiweave.llm import multiindex


def planted(seed, n, partners):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    turn = rng.normal(size=(partners, 64))
    turn -= (turn * base[:partners]).sum(axis=1, keepdims=True) * base[:partners]
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    cosine = rng.uniform(0.9, 0.96, (partners, 1))
    return np.concatenate([base, cosine * base[:partners] + np.sqrt(1 - cosine**2) * turn]).astype(np.float32)


@pytest.mark.parametrize("codewords,block_rows", [(None, 8192), (12, 8192), (4, 300)])
def test_recall_against_all_cosines(spark, codewords, block_rows):
    vectors = planted(1, 4500, 1500)
    units = vectors.astype(np.float64) / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
    near = units @ units.T >= 0.9
    np.fill_diagonal(near, False)
    table = spark.createDataFrame([(k, v) for k, v in enumerate(vectors.tolist())], "vec_id bigint, embedding array<float>")
    got = {r.vec_id: r for r in multiindex.near_duplicates(table, codewords=codewords, block_rows=block_rows).collect()}
    counts, want = np.array([got[k].n_links for k in range(len(vectors))]), near.sum(axis=1)
    # None below the bound, and nearly all above it.
    assert (counts <= want).all() and counts.sum() >= 0.97 * want.sum() and want.sum() > 2900
    for k in range(len(vectors)):
        if counts[k]:
            linked = {int(j) for j in np.flatnonzero(near[k])}
            assert got[k].component_id in linked | {k}


def test_one_large_group_of_near_vectors_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    vectors = [(k, (centre + 0.01 * rng.normal(size=16)).tolist()) for k in range(700)]
    vectors += [(1000 + k, rng.normal(size=16).tolist()) for k in range(50)]
    vectors += [(5, vectors[5][1]), (2000, vectors[5][1]), (2001, [2 * x for x in vectors[5][1]])]
    table = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    rows = multiindex.near_duplicates(table, codewords=2, block_rows=64).collect()
    assert len(rows) == len(vectors)
    group = [r for r in rows if r.vec_id < 1000 or r.vec_id >= 2000]
    assert {r.n_links for r in group} == {702} and {r.component_id for r in group} == {0}


def test_codewords_follow_the_number_of_vectors():
    assert multiindex.codewords_for(10) == 2 and multiindex.codewords_for(4096 * 100) == 10
    assert multiindex.codewords_for(10**9) ** 2 * multiindex.CELL_MEMBERS >= 10**9
