"""Vectors of several lengths in one table."""

import numpy as np

from lexiweave.llm import multiindex


def test_every_length_has_links_of_its_own(spark):
    rng = np.random.default_rng(8)
    values = []
    for length in (64, 32, 8, 1):
        for _ in range(10):
            centre = rng.normal(size=length)
            values += [(centre + 0.02 * rng.normal(size=length) * np.abs(centre)).tolist() for _ in range(3)]
    values += [[1.0, 2.0, 3.0], [2.0, 4.0, 6.0]]
    table = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in multiindex.near_duplicates(table, codewords=4, target_recall=1.0).collect()}
    units = [np.array(v) / np.linalg.norm(v) for v in values]
    for k, u in enumerate(units):
        near = [j for j, w in enumerate(units) if len(w) == len(u) and u @ w >= 0.9]
        assert got[k].n_links == len(near) - 1 and got[k].component_id == near[0], k
