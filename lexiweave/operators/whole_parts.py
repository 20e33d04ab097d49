"""Communities of parts whose edges fit one task: all levels of a part in one reading, without rounds of jobs.

Edges are packed where they lie and sent to the task of their part, a few bytes each. There the vertices take turns,
each moving to the community of its neighbours that gains most, so every move raises the modularity of the part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import dense_index, keyed_join, materialize, task_count

# Edges of a pack, and of a step in which arrays are worked out.
PACK_EDGES = 1 << 16
STEP = 1 << 21

_PACKED = "part long, n int, kind int, data binary"
_TYPES = ("<u2", "<f4", "<f8")
# Counts above it are split into parallel edges.
_MOST = (1 << 16) - 1

# First entry of each vertex and the end, other ends, weights, and the weights of loops in both directions.
Csr = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (part, v, u, w) as compressed bytes, with the ends as differences to the part."""
    names = [c.split()[0] for c in _PACKED.split(", ")]

    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        part, v, u, w = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(part, kind="stable")
        part, v, u, w = part[order], v[order], u[order], w[order]
        # Two bytes hold counts, and single precision is used where it holds every weight of the pack.
        kind = 1 if (w == w.astype("<f4")).all() else 2
        if kind == 1 and (w >= 1).all() and (w == np.floor(w)).all():
            times = -(-w.astype(np.int64) // _MOST)
            if times.sum() <= len(w) * 5 // 4:
                kind, last = 0, np.cumsum(times) - 1
                part, v, u, rest = (np.repeat(x, times) for x in (part, v, u, w - (times - 1) * _MOST))
                w = np.full(len(part), float(_MOST))
                w[last] = rest[last]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
        data = [
            pa.compress(b"".join([(v[a:b] - part[a]).astype("<i8").tobytes(), (u[a:b] - part[a]).astype("<i8").tobytes(), w[a:b].astype(_TYPES[kind]).tobytes()]), codec="zstd", asbytes=True)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        ]
        sizes = np.diff(cuts).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), pa.array(sizes), pa.array(np.full(len(sizes), kind, np.int32)), pa.array(data, pa.binary())], names)

    held, size = [], 0
    for batch in batches:
        part, v, u, w = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        held.append((part, v, u, np.nan_to_num(w)))
        size += len(v)
        if size >= PACK_EDGES:
            yield flush(held)
            held, size = [], 0
    if size:
        yield flush(held)


def _unpacked(n: int, kind: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = np.dtype(_TYPES[kind]).itemsize
    raw = pa.decompress(data, decompressed_size=n * (16 + width), codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<i8", n, 8 * n), np.frombuffer(raw, _TYPES[kind], n, 16 * n)


def _laid_out(packs: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, Csr]:
    """(vertices in order, graph) of the packs of a part, each of which is unpacked twice, so that it is not held as rows."""
    seen = np.zeros(0, np.int64)
    for pack in packs:
        v, u, _ = _unpacked(*pack)
        seen = np.union1d(seen, np.concatenate([v, u]))
    n, degree = len(seen), np.zeros(len(seen), np.int64)
    for pack in packs:
        v, u, _ = _unpacked(*pack)
        apart = v != u
        for x in (v[apart], u[apart]):
            degree += np.bincount(np.searchsorted(seen, x), minlength=n)
    first = np.concatenate([[0], np.cumsum(degree)])
    ends = np.empty(first[-1], np.int32)
    weights = np.empty(first[-1], _TYPES[max(kind for _, kind, _ in packs)])
    loops, filled = np.zeros(n), first[:-1].copy()
    while packs:
        v, u, w = _unpacked(*packs.pop())
        v, u = np.searchsorted(seen, v), np.searchsorted(seen, u)
        loops += 2 * np.bincount(v[v == u], w[v == u], n)
        v, u, w = v[v != u], u[v != u], w[v != u]
        for x, y in ((v, u), (u, v)):
            order = np.argsort(x, kind="stable")
            x, counts = x[order], np.bincount(x, minlength=n)
            at = filled[x] + np.arange(len(x)) - (np.cumsum(counts) - counts)[x]
            ends[at], weights[at] = y[order], w[order]
            filled += counts
    return seen, (first, ends, weights, loops)


def _steps(first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of vertices with some million entries at a time, one vertex at least."""
    a = 0
    while a < len(first) - 1:
        b = max(a + 1, int(np.searchsorted(first, first[a] + STEP, side="right")) - 1)
        yield a, b
        a = b


def _settled(graph: Csr, least_gain: float) -> np.ndarray:
    """Community of each vertex, numbered from 0, when no vertex gains by a move."""
    first, ends, weights, loops = graph
    n = len(first) - 1
    k = loops.copy()
    for a, b in _steps(first):
        own = np.repeat(np.arange(b - a), np.diff(first[a : b + 1]))
        k[a:b] += np.bincount(own, weights[first[a] : first[b]], b - a)
    whole = k.sum()
    r = k / whole if whole > 0 else np.zeros(n)
    comm, tot, active = np.arange(n), k.copy(), np.ones(n, bool)
    bounds, swept = first.tolist(), True
    while True:
        moved = False
        for v in np.flatnonzero(active).tolist():
            active[v] = False
            a, b = bounds[v], bounds[v + 1]
            if a == b:
                continue
            near = comm[ends[a:b]]
            win = np.bincount(near, weights[a:b])
            own = comm[v]
            score = win - r[v] * tot[: len(win)]
            score[win <= 0] = -np.inf
            stay = (win[own] if own < len(win) else 0.0) - r[v] * (tot[own] - k[v])
            if own < len(win):
                score[own] = -np.inf
            best = int(score.argmax())
            if score[best] - stay > least_gain:
                comm[v] = best
                tot[own] -= k[v]
                tot[best] += k[v]
                active[ends[a:b][near != best]] = True
                moved = True
        # The sizes of communities change for all vertices, not only for the neighbours of those that move.
        if not moved and not active.any():
            if swept:
                return comm
            active[:], swept = True, True
            continue
        swept = False
        kept, comm = np.unique(comm, return_inverse=True)
        tot = tot[kept]


def _contracted(graph: Csr, comm: np.ndarray) -> Csr:
    """The graph whose vertices are the communities, which are numbered from 0."""
    first, ends, weights, loops = graph
    m = int(comm.max()) + 1
    inner = np.bincount(comm, loops, m)
    keys, sums = np.zeros(0, np.int64), np.zeros(0)
    for a, b in _steps(first):
        key = np.repeat(comm[a:b], np.diff(first[a : b + 1])) * m + comm[ends[first[a] : first[b]]]
        here, place = np.unique(key, return_inverse=True)
        here, both = np.concatenate([keys, here]), np.concatenate([sums, np.bincount(place, weights[first[a] : first[b]], len(here))])
        keys, place = np.unique(here, return_inverse=True)
        sums = np.bincount(place, both, len(keys))
    v, u = keys // m, keys % m
    inner += np.bincount(v[v == u], sums[v == u], m)
    v, u, sums = v[v != u], u[v != u], sums[v != u]
    return np.concatenate([[0], np.cumsum(np.bincount(v, minlength=m))]), u.astype(np.int32), sums, inner


def settled_levels(packs: list[tuple[int, int, bytes]], least_gain: float) -> tuple[np.ndarray, np.ndarray]:
    """(v, comm) of a part: settled communities become vertices of the next level, until nothing moves.

    A community is named after its smallest vertex. The packs are used up.
    """
    ids, graph = _laid_out(packs)
    path = np.arange(len(ids))
    while True:
        n = len(graph[0]) - 1
        found, comm = np.unique(_settled(graph, least_gain), return_inverse=True)
        path = comm[path]
        if len(found) == n:
            least = np.full(n, len(ids))
            np.minimum.at(least, path, np.arange(len(ids)))
            return ids, ids[least[path]]
        graph = _contracted(graph, comm)


def search_whole(pairs: DataFrame, sizes: DataFrame, small: bool, least_gain: float) -> DataFrame:
    """``(part, v, comm)`` of all levels of every part of ``pairs (part, v, u, w)``, each edge once.

    ``sizes (part, n)`` has the edges of each part, which go round the tasks from the largest one on.
    """
    tasks = task_count(pairs.sparkSession)
    order = dense_index(sizes.select("part", "n"), [F.desc("n"), F.asc("part")], "turn").select("part", F.pmod("turn", F.lit(tasks)).cast("int").alias("task"))
    packed = pairs.select("part", "v", "u", F.col("w").cast("double").alias("w")).mapInArrow(_packs, _PACKED)
    sent = keyed_join(packed, materialize(order, "turns"), ["part"], ["n"], small).repartitionById(tasks, F.col("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended() -> pa.RecordBatch:
            v, comm = settled_levels(packs, least_gain)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(v), part)), pa.array(v + part), pa.array(comm + part)], ["part", "v", "comm"])

        part, packs = None, []
        for batch in batches:
            for one, *pack in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if packs and one != part:
                    yield ended()
                    packs = []
                part = one
                packs.append(tuple(pack))
        if packs:
            yield ended()

    ordered = sent.sortWithinPartitions("part").select("part", "n", "kind", "data")
    return ordered.mapInArrow(run, "part long, v long, comm long")
