import itertools
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lexiweave.operators import index as I
from lexiweave.operators.graph import (
    communities,
    community_edges,
    community_nodes,
    filter_communities,
    group_theta,
    modularity,
    refine_large,
    simplify,
    threshold_edges,
)
from lexiweave.plans.word_graph import index_vocabulary, word_graph

POSTINGS = "group_id string, term string, doc_id bigint"
EDGES = "group_id string, src string, dst string, w bigint"


def comments(spark):
    return spark.createDataFrame(
        [
            ("f1", 0, "the cat sat"),
            ("f1", 1, "a catalog of cats"),
            ("f1", 2, "the cat sat"),
            ("f1", 3, ""),
            ("f2", 0, "x-ray cat"),
        ],
        "group_id string, doc_id bigint, text string",
    )


def test_token_postings_merge_copies(spark):
    docs = comments(spark)
    vocabulary = index_vocabulary(docs)
    got = rows(I.postings(docs, vocabulary), "group_id", "term", "doc_id")
    assert ("f1", "cat", 0) in got and ("f1", "cat", 2) not in got and ("f1", "cat", 1) not in got
    assert ("f1", "a", 1) not in got
    every = rows(I.postings(docs, vocabulary, merge_copies=False), "group_id", "term", "doc_id")
    assert ("f1", "cat", 2) in every


def test_substring_postings_equal_brute_force(spark):
    letters = random.Random(3)
    docs = [
        (f"g{i % 2}", i, " ".join("".join(letters.choice("ab1-") for _ in range(letters.randint(1, 9))) for _ in range(6)))
        for i in range(40)
    ]
    terms = [(g, t) for g in ("g0", "g1") for t in ("ab", "ba1", "a", "1a", "b-a", "-", "aaaa")]
    df = spark.createDataFrame(docs, "group_id string, doc_id bigint, text string")
    vocabulary = spark.createDataFrame(terms, "group_id string, term string")
    want = sorted((g, t, d) for g, d, text in docs for h, t in terms if g == h and t in text.lower())
    assert rows(I.substring_postings(df, vocabulary), "group_id", "term", "doc_id") == want


def random_postings(seed, n_docs=60, n_terms=40):
    rng = random.Random(seed)
    found = []
    for g in ("g0", "g1"):
        for d in range(n_docs):
            size = n_terms if d == 0 else rng.randint(0, 9)
            found += [(g, f"t{t:02d}", d) for t in rng.sample(range(n_terms), size)]
        found += [(g, t, 1000 + i) for i in range(30) for t in ("t01", "t02", "t03")]
    return found


def brute(found):
    docs, weights = {}, {}
    for g, t, d in found:
        docs.setdefault((g, d), set()).add(t)
    for (g, _), terms in docs.items():
        for pair in itertools.combinations(sorted(terms), 2):
            weights[(g, *pair)] = weights.get((g, *pair), 0) + 1
    return weights


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_cooccurrence_equals_brute_force(spark, monkeypatch, ranges):
    monkeypatch.setattr(I, "PAIR_RANGES", ranges)
    found = random_postings(ranges)
    df = spark.createDataFrame(found, POSTINGS)
    want = brute(found)
    zero = spark.createDataFrame([("g0", 0.0), ("g1", 0.0)], "group_id string, theta double")
    assert {tuple(r)[:3]: r.w for r in I.cooccurrence(df, zero).collect()} == want
    theta = spark.createDataFrame([("g0", 2.0), ("g1", 20.0)], "group_id string, theta double")
    limits = {"g0": 2, "g1": 20}
    assert {tuple(r)[:3]: r.w for r in I.cooccurrence(df, theta).collect()} == {
        k: w for k, w in want.items() if w > limits[k[0]]
    }


def test_large_tables_take_the_salted_joins(spark, monkeypatch):
    monkeypatch.setattr("lexiweave.runtime.BROADCAST_BYTES", 0)
    monkeypatch.setattr(I, "fits_broadcast", lambda df: False)
    found = random_postings(5, 20, 12)
    df = spark.createDataFrame(found, POSTINGS)
    zero = spark.createDataFrame([("g0", 0.0), ("g1", 0.0)], "group_id string, theta double")
    assert {tuple(r)[:3]: r.w for r in I.cooccurrence(df, zero).collect()} == brute(found)


def test_thresholds_and_simplify(spark):
    edges = spark.createDataFrame([("g", "a", "b", 5), ("g", "b", "c", 6)], EDGES)
    theta = spark.createDataFrame([("g", 5.0)], "group_id string, theta double")
    assert rows(threshold_edges(edges, theta), "src", "dst") == [("b", "c")]
    raw = spark.createDataFrame([("g", "a", "b", 1), ("g", "b", "a", 2), ("g", "a", "a", 9)], EDGES)
    assert rows(simplify(raw), "group_id", "src", "dst", "w") == [("g", "a", "b", 3)]


def test_group_theta_counts_terms(spark):
    found = [("s", f"t{i}", 0) for i in range(9)] + [("m", f"t{i}", 0) for i in range(10)] + [("l", f"t{i}", 0) for i in range(100)]
    got = {r.group_id: r.theta for r in group_theta(spark.createDataFrame(found, POSTINGS)).collect()}
    assert got["s"] == 0 and got["m"] == 1 and got["l"] == pytest.approx(5.0)


def clique(group, names, w):
    return [(group, a, b, w) for a, b in itertools.combinations(sorted(names), 2)]


def planted(spark):
    ring = [[f"{c}{i}" for i in range(5)] for c in "abcd"]
    edges = [e for names in ring for e in clique("g", names, 10)]
    edges += [("g", "a0", "b0", 1), ("g", "b1", "c0", 1), ("g", "c1", "d0", 1), ("g", "a1", "d1", 1)]
    # A second group whose two halves hang together by one weak edge.
    edges += clique("h", ["p0", "p1", "p2"], 4) + clique("h", ["q0", "q1", "q2"], 4) + [("h", "p0", "q0", 1)]
    terms = {(g, t) for g, a, b, _ in edges for t in (a, b)} | {("g", "alone"), ("lonely", "only")}
    return spark.createDataFrame(sorted(terms), "group_id string, term string"), spark.createDataFrame(edges, EDGES)


def test_communities_find_planted_groups(spark):
    vertices, edges = planted(spark)
    found = communities(vertices, edges)
    got = {(r.group_id, r.term): r.community for r in found.collect()}
    assert got == {
        (g, t): t if t in ("alone", "only") else f"{t[0]}0" for g, t in ((r.group_id, r.term) for r in vertices.collect())
    }
    quality = {r.group_id: r.modularity for r in modularity(edges, found).collect()}
    single = {r.group_id: r.modularity for r in modularity(edges, vertices.withColumn("community", F.col("term"))).collect()}
    assert all(quality[g] >= single[g] for g in quality)
    assert quality["h"] == pytest.approx(2 * (12 / 25) - 2 * (25 / 50) ** 2)


def test_communities_with_salted_joins_are_the_same(spark, monkeypatch):
    edges = spark.createDataFrame(clique("g", "abc", 4) + clique("g", "xyz", 4) + [("g", "a", "x", 1)], EDGES)
    vertices = spark.createDataFrame([("g", t) for t in "abcxyz"], "group_id string, term string")
    want = rows(communities(vertices, edges))
    monkeypatch.setattr("lexiweave.operators.graph.fits_broadcast", lambda df: False)
    assert rows(communities(vertices, edges)) == want


def test_no_edges_leaves_single_terms(spark):
    vertices = spark.createDataFrame([("g", "a"), ("g", "b")], "group_id string, term string")
    got = communities(vertices, spark.createDataFrame([], EDGES))
    assert rows(got, "term", "community") == [("a", "a"), ("b", "b")]


def test_refine_splits_large_communities_only(spark):
    left, right = [f"l{i}" for i in range(6)], [f"r{i}" for i in range(6)]
    weak = [("g", a, b, 3) for a in left for b in right]
    edges = spark.createDataFrame(clique("g", left, 20) + clique("g", right, 20) + weak + clique("g", ["x0", "x1", "x2"], 9), EDGES)
    terms = [("g", t, "l0") for t in left + right] + [("g", t, "x0") for t in ("x0", "x1", "x2")]
    membership = spark.createDataFrame(terms, "group_id string, term string, community string")
    theta = spark.createDataFrame([("g", 2.0)], "group_id string, theta double")
    refined = refine_large(edges, membership, theta)
    got = {r.term: r.part for r in refined.collect()}
    assert got == {**{t: "l0" for t in left}, **{t: "r0" for t in right}, "x0": None, "x1": None, "x2": None}
    kept = filter_communities(refined, membership)
    assert kept.count() == 15
    frequency = spark.createDataFrame([("g", t, 7) for _, t, _ in terms], "group_id string, term string, df bigint")
    nodes = community_nodes(kept, frequency, slots=2)
    assert rows(nodes.groupBy("slot").count()) == [(0, 9), (1, 6)]
    assert sorted(r.node for r in nodes.collect()) == list(range(15))
    assert community_edges(nodes, edges).count() == edges.count()


def test_small_parts_are_dropped(spark):
    refined = spark.createDataFrame(
        [("g", "a", "a", "a"), ("g", "b", "a", "a"), ("g", "c", "c", None), ("g", "d", "c", None), ("g", "e", "e", None)],
        "group_id string, term string, community string, part string",
    )
    assert rows(filter_communities(refined, refined), "term") == [("c",), ("d",)]


def test_word_graph_of_one_term_is_empty(spark):
    index = spark.createDataFrame([("g", "only", 1)], POSTINGS)
    nodes, edges = word_graph(index)
    assert nodes.count() == 0 and edges.count() == 0


def test_long_runs_and_long_terms_are_found(spark, monkeypatch):
    monkeypatch.setattr(I, "SEGMENT", 20)
    monkeypatch.setattr(I, "LONGEST", 8)
    letters = random.Random(6)
    docs = [("g", i, "".join(letters.choice("abc") for _ in range(300))) for i in range(6)]
    docs += [("g", 10, "x" * 50), ("g", 11, "q" * 9 + "!" + "q" * 7), ("h", 12, "abcabc"), ("g", 13, None)]
    terms = [docs[i][2][a : a + n] for i in range(6) for a, n in ((0, 3), (17, 8), (100, 9), (140, 40), (292, 8), (5, 1), (9, 2))]
    terms += ["x" * 50, "x" * 51, "q" * 8, "q" * 9, "q!q", "qq!" + "q" * 7, "cc", "zzz"]
    df = spark.createDataFrame(docs, "group_id string, doc_id bigint, text string")
    vocabulary = spark.createDataFrame(sorted({("g", t) for t in terms}), "group_id string, term string")
    want = sorted((g, t, d) for g, d, text in docs for t in set(terms) if g == "g" and t in (text or ""))
    assert rows(I.substring_postings(df, vocabulary), "group_id", "term", "doc_id") == want


def test_a_run_of_a_million_letters(spark):
    letters = random.Random(7)
    run = "".join(letters.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    terms = [run[a : a + n] for a, n in ((0, 12), (510, 40), (777_777, 64), (999_990, 10), (123_456, 200))] + ["zqzqzqzq"]
    df = spark.createDataFrame([("g", 1, run)], "group_id string, doc_id bigint, text string")
    vocabulary = spark.createDataFrame([("g", t) for t in terms], "group_id string, term string")
    assert rows(I.substring_postings(df, vocabulary), "term") == sorted((t,) for t in terms if t in run)


def test_copies_of_a_text_and_of_a_row(spark):
    docs = [("g", 3, "x y"), ("g", 1, "x y"), ("g", 1, "x y"), ("g", 2, "x z"), ("h", 5, "x y"), ("g", 1, "w"), ("g", 7, None)]
    df = spark.createDataFrame(docs, "group_id string, doc_id bigint, text string")
    got = sorted((r.group_id, r.doc_id, r.text or "") for r in I.distinct_texts(df).collect())
    assert got == [("g", 1, "w"), ("g", 1, "x y"), ("g", 2, "x z"), ("g", 7, ""), ("h", 5, "x y")]
    vocabulary = spark.createDataFrame([(g, t) for g in "gh" for t in "wxyz"], "group_id string, term string")
    found = rows(I.postings(df, vocabulary), "group_id", "term", "doc_id")
    assert found == [("g", "w", 1), ("g", "x", 1), ("g", "x", 2), ("g", "y", 1), ("g", "z", 2), ("h", "x", 5), ("h", "y", 5)]


def noisy(seed, n, p_in, p_out, size):
    rng = random.Random(seed)
    names = [f"v{i:03d}" for i in range(n)]
    return [("g", a, b, rng.randint(1, 9)) for i, a in enumerate(names) for j, b in list(enumerate(names))[i + 1 :]
            if rng.random() < (p_in if i // size == j // size else p_out)]


def modularity_of(edges, group):
    m2, degree, inner = 0.0, {}, 0.0
    for _, a, b, w in edges:
        m2 += 2 * w
        degree[a], degree[b] = degree.get(a, 0) + w, degree.get(b, 0) + w
        inner += 2 * w if group[a] == group[b] else 0
    share = {}
    for v, k in degree.items():
        share[group[v]] = share.get(group[v], 0) + k
    return inner / m2 - sum((x / m2) ** 2 for x in share.values())


@pytest.mark.parametrize("seed,n,p_in,p_out,size", [(1, 36, 0.8, 0.08, 9), (2, 24, 0.9, 0.6, 8)])
def test_no_vertex_gains_by_a_move(spark, seed, n, p_in, p_out, size):
    edges = noisy(seed, n, p_in, p_out, size)
    names = sorted({v for _, a, b, _ in edges for v in (a, b)})
    found = communities(spark.createDataFrame([("g", v) for v in names], "group_id string, term string"), spark.createDataFrame(edges, EDGES))
    group = {r.term: r.community for r in found.collect()}
    assert sorted(group) == names
    q = modularity_of(edges, group)
    assert q >= modularity_of(edges, {v: v for v in names})
    # At the last level no two communities gain by a union.
    for a, b in itertools.combinations(sorted(set(group.values())), 2):
        assert modularity_of(edges, {v: a if c == b else c for v, c in group.items()}) <= q + 1e-9
    planted = {v: int(v[1:]) // size for v in names}
    assert q >= modularity_of(edges, planted) - 0.02


def test_moves_of_a_round_never_lower_the_modularity(spark):
    from lexiweave.operators import graph as G

    edges = noisy(4, 40, 0.8, 0.3, 10)
    names = sorted({v for _, a, b, _ in edges for v in (a, b)})
    number = {v: i for i, v in enumerate(names)}
    both = [(0, number[a], number[b], float(w)) for _, a, b, w in edges] + [(0, number[b], number[a], float(w)) for _, a, b, w in edges]
    adjacency = spark.createDataFrame(both, "part bigint, v bigint, u bigint, w double").cache()
    state = G._start(adjacency, True).cache()
    coded = [("g", number[a], number[b], w) for _, a, b, w in edges]
    group = {i: i for i in number.values()}
    for turn in range(4):
        proposals = G._proposals(adjacency, state, True)
        moves = {r.v: r.next for r in G._moves(adjacency, proposals, turn, True).collect()}
        if not moves:
            break
        after = {**group, **moves}
        assert modularity_of(coded, after) > modularity_of(coded, group)
        group = after
        new = spark.createDataFrame(sorted(group.items()), "v bigint, next bigint")
        state = state.join(new, "v").select("part", "v", F.col("next").alias("comm"), "k", "r", F.lit(True).alias("active")).cache()


def test_refinement_on_the_coded_graph_is_the_same(spark):
    from lexiweave.operators.graph import code_graph

    edges = noisy(5, 24, 0.9, 0.25, 8) + [("h", "a", "b", 3)]
    names = sorted({(g, v) for g, a, b, _ in edges for v in (a, b)})
    vertices = spark.createDataFrame(names, "group_id string, term string")
    df = spark.createDataFrame(edges, EDGES)
    theta = spark.createDataFrame([("g", 2.0), ("h", 0.0)], "group_id string, theta double")
    graph = code_graph(vertices, df)
    first = communities(vertices, df, graph=graph)
    refined = rows(refine_large(df, first, theta, max_size=5, graph=graph))
    assert refined == rows(refine_large(df, first, theta, max_size=5)) and len(refined) == len(names)
    sizes = {}
    for _, _, c, _ in refined:
        sizes[c] = sizes.get(c, 0) + 1
    assert all((p is not None) == (sizes[c] > 5) for _, _, c, p in refined)


@pytest.mark.parametrize("block, step", [(1, 1), (3, 7), (2048, 1 << 17)])
def test_pairs_of_small_blocks_equal_brute_force(spark, monkeypatch, block, step):
    monkeypatch.setattr(I, "PAIR_BLOCK", block)
    monkeypatch.setattr("lexiweave.operators.pairs.STEP", step)
    found = random_postings(block, 30, 12)
    found += found[:5] + [("g0", found[0][1], None), ("g0", found[1][1], None)]
    df = spark.createDataFrame(found, POSTINGS)
    zero = spark.createDataFrame([("g0", 0.0), ("g1", 0.0)], "group_id string, theta double")
    edges = I.cooccurrence(df, zero)
    assert {tuple(r)[:3]: r.w for r in edges.collect()} == brute(found)
    # Pairs are counted in arrays and are no rows of a table.
    assert "Generate" not in edges._jdf.queryExecution().executedPlan().toString()


def test_places_of_two_blocks_are_paired_per_list(monkeypatch):
    from lexiweave.operators import pairs as P

    for step in (1, 2, 100):
        monkeypatch.setattr(P, "STEP", step)
        table = np.zeros((2, 3), np.int64)
        P._add_pairs(table, *[np.array(x) for x in ([2, 0, 1], [0, 1, 1], [2, 1, 3], [0, 2, 1, 0, 1, 2])])
        assert table.tolist() == [[1, 0, 1], [2, 1, 2]]


def test_a_round_over_blocks_gives_the_best_moves(spark, monkeypatch):
    import random

    from lexiweave.operators import edge_blocks as E
    from lexiweave.operators import graph as G

    monkeypatch.setattr(E, "BLOCK_EDGES", 150)
    draw = random.Random(5)
    weight = {(a, b): float(draw.randint(1, 4)) for a in range(40) for b in range(a + 1, 40) if draw.random() < 0.4}
    weight |= {(3, 3): 2.0, (7, 7): 5.0}
    both = [(0, 2 * a, 2 * b, w) for (a, b), w in weight.items()] + [(0, 2 * b, 2 * a, w) for (a, b), w in weight.items() if a != b]
    adjacency = spark.createDataFrame(both, "part bigint, v bigint, u bigint, w double")
    blocks = E.edge_blocks(adjacency, True)
    # A vertex is sent once to a block, whatever the edges to it.
    n_blocks = blocks.packed.count()
    assert n_blocks > 2 and blocks.needs.count() == blocks.needs.distinct().count() <= 40 * n_blocks < len(both)
    comm = {2 * v: 2 * draw.randrange(8) for v in range(40)}
    active, moved = {0, 14, 22}, {8}
    degree, near = dict.fromkeys(comm, 0.0), {v: {} for v in comm}
    for _, v, u, w in both:
        degree[v] += w
        near[v][u] = w
    m2 = sum(degree.values())
    tot = {c: sum(degree[v] for v in comm if comm[v] == c) for c in set(comm.values())}
    wanted = {}
    for v in comm:
        if v not in active and not any(u in moved for u in near[v]):
            continue
        win = {comm[v]: 0.0}
        for u, w in near[v].items():
            if u != v:
                win[comm[u]] = win.get(comm[u], 0.0) + w
        score = {c: x - degree[v] / m2 * (tot[c] - (degree[v] if c == comm[v] else 0.0)) for c, x in win.items()}
        best = min((-s, c) for c, s in score.items() if c != comm[v])
        if -best[0] - score[comm[v]] > 1e-9:
            wanted[v] = (best[1], round(-best[0] - score[comm[v]], 6))
    state = [(0, v, comm[v], degree[v], degree[v] / m2, v in active, v in moved) for v in comm]
    state = spark.createDataFrame(state, "part bigint, v bigint, comm bigint, k double, r double, active boolean, moved boolean")
    for small in (True, False):
        found = G._proposals(blocks, state, small).collect()
        assert wanted and {r.v: (r.next, round(r.gain, 6)) for r in found} == wanted


def test_shared_documents_of_asked_pairs_are_counted_in_one_reading(spark, tmp_path):
    from lexiweave.operators.index import posting_intersection_size

    held = [("g", t, d) for t, d in (("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 3), ("c", 3), ("a", None), ("b", None))]
    held += [(None, "a", 1), (None, "b", 1), ("h", "a", 5), ("h", "b", 5), ("h", "b", 5), ("h", "z", 6)]
    spark.createDataFrame(held, "group_id string, term string, doc_id bigint").write.parquet(f"{tmp_path}/postings")
    postings = spark.read.parquet(f"{tmp_path}/postings")
    asked = [("g", "a", "b"), ("g", "a", "b"), ("g", "b", "c"), ("g", "a", "c"), ("g", "b", "b"), (None, "a", "b"), ("h", "a", "b"), ("h", "z", "y")]
    found = posting_intersection_size(postings, spark.createDataFrame(asked, "group_id string, src string, dst string"))
    assert rows(found, "group_id", "src", "dst", "w") == [("g", "a", "b", 2), ("g", "b", "b", 3), ("g", "b", "c", 1), ("h", "a", "b", 2)]
    # The postings are not joined to themselves.
    assert not any("/postings/" in name for name in found.inputFiles())
