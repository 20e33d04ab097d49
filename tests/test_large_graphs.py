"""Groups in one task and in rounds, waves of tiles, and tables that are not kept."""

import os
import random

import numpy as np
import pytest
from conftest import rows
from test_graph import EDGES, POSTINGS, brute, clique, modularity_of, noisy, planted, random_postings

from lexiweave import runtime
from lexiweave.operators import graph as G
from lexiweave.operators import index as I
from lexiweave.operators import pairs as P
from lexiweave.operators import whole_parts as W


def plain_gain(edges, group):
    """Largest rise of the modularity by a move of one vertex to the community of a neighbour."""
    q, best = modularity_of(edges, group), 0.0
    for _, a, b, _ in edges:
        for v, u in ((a, b), (b, a)):
            best = max(best, modularity_of(edges, {**group, v: group[u]}) - q)
    return best


def test_groups_are_searched_in_one_task_or_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(G, "WHOLE_EDGES", 70)
    vertices, edges = planted(spark)
    got = {(r.group_id, r.term): r.community for r in G.communities(vertices, edges).collect()}
    assert got == {(r.group_id, r.term): r.term if r.term in ("alone", "only") else f"{r.term[0]}0" for r in vertices.collect()}
    # With 70 the one group is large and the other one is not.
    mixed = noisy(3, 24, 0.8, 0.1, 8) + clique("h", ["p0", "p1", "p2"], 4)
    assert sum(e[0] == "g" for e in mixed) > 70
    terms = sorted({(g, v) for g, a, b, _ in mixed for v in (a, b)})
    found = G.communities(spark.createDataFrame(terms, "group_id string, term string"), spark.createDataFrame(mixed, EDGES))
    group = {r.term: r.community for r in found.collect()}
    assert len(group) == len(terms) and len({group[f"p{i}"] for i in range(3)}) == 1
    one = [e for e in mixed if e[0] == "g"]
    assert modularity_of(one, group) >= modularity_of(one, {v: int(v[1:]) // 8 for _, v in terms if v[0] == "v"}) - 0.02


def test_no_vertex_of_a_level_gains_by_a_move(monkeypatch):
    monkeypatch.setattr(W, "STEP", 64)
    edges = noisy(7, 40, 0.7, 0.2, 8)
    names = sorted({v for _, a, b, _ in edges for v in (a, b)})
    number = {v: 3 * i for i, v in enumerate(names)}
    columns = [np.array(x) for x in zip(*((number[a], number[b], float(w)) for _, a, b, w in edges))]
    import pyarrow as pa

    half = len(edges) // 2
    batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(len(range(*s.indices(len(edges)))), np.int64)), *[pa.array(c[s]) for c in columns]], ["part", "v", "u", "w"])
               for s in (slice(0, half), slice(half, None))]
    monkeypatch.setattr(W, "PACK_EDGES", 10)
    packs = [tuple(x) for b in W._packs(iter(batches)) for _, *x in zip(*(c.to_pylist() for c in b.columns))]
    ids, graph = W._laid_out(list(packs))
    assert ids.tolist() == sorted(number.values())
    comm = W._settled(graph, 1e-9)
    first = {v: int(comm[np.searchsorted(ids, number[v])]) for v in names}
    assert plain_gain(edges, first) < 1e-9
    ids, last = W.settled_levels(list(packs), 1e-9)
    group = dict(zip(names, last.tolist()))
    assert modularity_of(edges, group) >= modularity_of(edges, first) - 1e-12
    # A community has the number of its first vertex.
    assert all(group[v] == min(number[u] for u in names if group[u] == group[v]) for v in names)
    level = W._contracted(graph, np.unique(comm, return_inverse=True)[1])
    inner = sum(2 * w for _, a, b, w in edges if first[a] == first[b])
    assert level[3].sum() == inner and level[2].sum() + inner == sum(2 * w for *_, w in edges)


@pytest.mark.parametrize("weights, kind", [([3, 65535, 7, 9, 2, 65536, 4, 200_000] + [1] * 12, 0), ([1 << 20, 1, 1 << 22], 1), ([0.5, 2], 1), ([1 / 3, 2], 2)])
def test_weights_travel_unchanged(weights, kind):
    import pyarrow as pa

    columns = [[5] * len(weights), range(5, 5 + len(weights)), [50] * len(weights), map(float, weights)]
    packs = list(W._packs(iter([pa.RecordBatch.from_arrays([pa.array(list(c)) for c in columns], ["part", "v", "u", "w"])])))
    (n, found, data), = zip(*(packs[0].column(i).to_pylist() for i in (1, 2, 3)))
    v, u, w = W._unpacked(n, found, data)
    assert found == kind and set(u.tolist()) == {45}
    assert np.bincount(v, w).tolist() == [float(x) for x in weights]


@pytest.mark.parametrize("copies", [1, 2, 5])
def test_pairs_in_waves_equal_brute_force(spark, monkeypatch, copies):
    monkeypatch.setattr(I, "PAIR_BLOCK", 3)
    monkeypatch.setattr(P, "WAVE_COPIES", copies)
    found = random_postings(copies, 30, 14)
    zero = spark.createDataFrame([("g0", 0.0), ("g1", 0.0)], "group_id string, theta double")
    edges = I.cooccurrence(spark.createDataFrame(found, POSTINGS), zero).collect()
    assert len(edges) == len(brute(found)) and {tuple(r)[:3]: r.w for r in edges} == brute(found)


def test_places_of_lists_come_back(monkeypatch):
    draw = random.Random(3)
    for blocks, n in ((1, 50), (5, 400), (2, 300_000)):
        lists = [draw.sample(range(n), draw.randint(1, 30)) for _ in range(12)]
        offsets = np.cumsum([0, *map(len, lists)])
        cut = P._blocks_of(offsets, np.concatenate(lists).astype(np.int32), blocks)
        for k, block in enumerate(cut):
            want = [sorted(x // blocks for x in one if x % blocks == k) for one in lists]
            assert block[0].tolist() == [len(x) for x in want] and block[1].tolist() == sum(want, [])
            sizes, places = P._shared(block, block)[:2]
            back = P._unpacked(*P._packed(sizes, places))
            assert back[0].tolist() == sizes.tolist() and back[1].tolist() == places.tolist()


def test_shuffle_files_go_with_the_write_and_the_session_stays(spark, tmp_path):
    before = spark.conf.get(runtime.SHUFFLE_CLEANUP, None)
    stored = runtime.materialize(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    assert spark.conf.get(runtime.SHUFFLE_CLEANUP, None) == before
    assert sum(r["count"] for r in stored.collect()) == 1000
    kept = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    known = kept.shuffleStatuses().size()
    for _ in range(3):
        runtime.materialize(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    assert kept.shuffleStatuses().size() <= known
    path = stored._stored_path
    assert os.path.isdir(path.removeprefix("file:"))
    runtime.release(stored)
    assert not os.path.exists(path.removeprefix("file:"))
    spark.conf.set(runtime.SHUFFLE_CLEANUP, "false")
    try:
        runtime.materialize(spark.range(3), "few")
        assert spark.conf.get(runtime.SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(runtime.SHUFFLE_CLEANUP)


def test_documents_of_an_index_are_shuffled_as_numbers_once(spark, monkeypatch):
    from lexiweave.plans import term_clusters as C

    monkeypatch.setattr(C, "BLOCK_ENTRIES", 7)
    monkeypatch.setattr(C, "TASK_ENTRIES", 1)
    monkeypatch.setattr(C, "STEP", 3)
    found = sorted(set(random_postings(4, 12, 9)))
    numbered, lists = C.document_lists(spark.createDataFrame([*found, (None, "t01", 1), ("g0", "t01", None), ("g0", None, 1)], POSTINGS))
    number = {r.term: r.v for r in numbered.collect()}
    docs = {}
    for g, t, d in found:
        docs.setdefault((g, d), set()).add(number[t])
    assert {(r.group_id, r.doc_id): set(r.vs) for r in lists.collect()} == docs
    sizes = {v: sum(len(x) for x in docs.values() if v in x) for v in number.values()}
    assert {r.v: r.n for r in C.row_sums(lists).collect()} == sizes
    blocks = C._document_blocks(lists, True)
    assert blocks.packed.count() > 1
    vectors = spark.createDataFrame([(v, 0.5, float(v + 1)) for v in number.values()], "v bigint, s double, q double")
    want = {v: 0.5 * sum(sum(0.5 * (u + 1) for u in x) for x in docs.values() if v in x) for v in number.values()}
    assert {r.v: r.z for r in C._spread(blocks, vectors, ["q"], ["z"]).collect()} == pytest.approx(want)
