"""Near-duplicate vectors by an inverted multi-index.

Each half of a unit vector has its own codebook, so the cells of the index are the grid of both. A
vector visits cells in the order of the sum of its distances to the two codewords, which a walk over
the sorted codewords of both halves yields one by one, until the number of cells that the target
recall takes. That number is measured on partners of sample vectors at the least cosine. The size of the
codebooks follows from the number of vectors, so that a cell has some thousands of members at any size. Visits
meet the members of a cell in tiles: the members are held, the visits stream past them. Cosines are taken in
single precision first, and in double precision for the pairs that come near the bound.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiweave.llm.batches import drawn
from lexiweave.llm.components import components
from lexiweave.runtime import lookup_join, materialize, task_count

MIN_COSINE = 0.9
TARGET_RECALL = 0.98
# Bound of the sample that codebooks and the number of visits are fitted on; all vectors are indexed.
SAMPLE_VECTORS = 6000
# Members that a cell has on average.
CELL_MEMBERS = 4096
# Members that a tile holds, and visits that stream past them.
BLOCK_ROWS = 8192
VISIT_BLOCK = 8
# Visits of a tile that are compared at a time, and pairs that are verified at a time.
_ASK_ROWS = 1024
_VERIFY = 1 << 16
# Beyond the rounding of a product of unit vectors in single precision.
_SLACK = 1e-4


class Index:
    """Codebooks of the halves, and how many cells a vector visits."""

    def __init__(self, sample: np.ndarray, codewords: int, min_cosine: float = MIN_COSINE, target: float = TARGET_RECALL):
        self.cut = sample.shape[1] // 2
        self.books = [_codebook(half, codewords) for half in (sample[:, : self.cut], sample[:, self.cut :])]
        self.visits = self._needed(sample, min_cosine, target)

    @property
    def cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def distances(self, vectors: np.ndarray) -> list[np.ndarray]:
        halves = (vectors[:, : self.cut], vectors[:, self.cut :])
        return [
            (half**2).sum(axis=1)[:, None] - 2 * half @ book.T + (book**2).sum(axis=1)[None, :]
            for half, book in zip(halves, self.books, strict=True)
        ]

    def cell(self, vectors: np.ndarray) -> np.ndarray:
        first, second = self.distances(vectors)
        return first.argmin(axis=1) * len(self.books[1]) + second.argmin(axis=1)

    def walk(self, first: np.ndarray, second: np.ndarray, count: int) -> list[int]:
        """The ``count`` nearest cells of one vector by the sum of both distances, nearest first."""
        order_a, order_b = first.argsort(kind="stable"), second.argsort(kind="stable")
        a, b = first[order_a].tolist(), second[order_b].tolist()
        heap, seen, found = [(a[0] + b[0], 0, 0)], {(0, 0)}, []
        while heap and len(found) < count:
            _, i, j = heapq.heappop(heap)
            found.append(int(order_a[i]) * len(self.books[1]) + int(order_b[j]))
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(a) and y < len(b) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (a[x] + b[y], x, y))
        return found

    def visited(self, vectors: np.ndarray, count: int | None = None) -> list[list[int]]:
        first, second = self.distances(vectors)
        return [self.walk(a, b, count or self.visits) for a, b in zip(first, second, strict=True)]

    def _needed(self, sample: np.ndarray, min_cosine: float, target: float) -> int:
        """Cells after which the target share of partners at the bound is met from either side.

        A partner of every sample vector is drawn in a random direction at exactly the least cosine,
        the hardest case, so the number does not depend on how many pairs the sample happens to hold.
        """
        own = sample[:2048]
        turn = np.random.default_rng(23).standard_normal(own.shape)
        turn -= (turn * own).sum(axis=1)[:, None] * own
        turn /= np.maximum(np.sqrt((turn**2).sum(axis=1)), 1e-300)[:, None]
        other = min_cosine * own + np.sqrt(max(0.0, 1 - min_cosine**2)) * turn
        ranks = np.minimum(self._rank(own, other), self._rank(other, own))
        return int(min(self.cells, max(4, np.quantile(ranks, target, method="higher"))))

    def _rank(self, asks: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Place in the walk of each asking vector of the cell of the vector beside it."""
        first, second = self.distances(asks)
        cells, rows = self.cell(held), np.arange(len(asks))
        reached = first[rows, cells // len(self.books[1])] + second[rows, cells % len(self.books[1])]
        sums = first[:, :, None] + second[:, None, :]
        return (sums.reshape(len(asks), -1) < reached[:, None] - 1e-12).sum(axis=1) + 1


def _codebook(data: np.ndarray, codewords: int, rounds: int = 12, seed: int = 17) -> np.ndarray:
    if not data.shape[1]:
        return np.zeros((1, 0))
    rng = np.random.default_rng(seed)
    distinct = np.unique(data, axis=0)
    book = distinct[rng.choice(len(distinct), min(codewords, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = ((book**2).sum(axis=1)[None, :] - 2 * data @ book.T).argmin(axis=1)
        counts = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, data)
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def codewords_for(vectors: int, cell_members: int = CELL_MEMBERS) -> int:
    """Codewords of a half that give cells of about ``cell_members`` vectors."""
    return max(2, math.ceil(math.sqrt(vectors / cell_members)))


def packed_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, digest binary, raw binary): the values of a vector in their own width, and a digest of its direction.

    Both are null if the vector links with nothing. Single values take four bytes, others are stored as units.
    """
    single = df.schema[vector_col].dataType.simpleString() == "array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, raws = [], []
            for values in batch.column(1).to_pylist():
                unit = _unit(values)
                digests.append(None if unit is None else hashlib.sha256(unit.tobytes()).digest())
                raws.append(None if unit is None else (np.array(values, "<f4") if single else unit).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(raws, pa.binary())], ["id", "digest", "raw"])

    vector = F.col(vector_col).cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).mapInArrow(run, "id long, digest binary, raw binary")


def _unit(values: list | None) -> np.ndarray | None:
    if not values or any(x is None for x in values):
        return None
    v = np.array(values, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    return _units(v[None])[0]


def _units(values: np.ndarray) -> np.ndarray:
    """Rows of norm 1 in double precision."""
    v = values.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _matrix(raw: list[bytes], width: int) -> np.ndarray:
    """Unit vectors of one length from their values."""
    values = np.frombuffer(b"".join(raw), f"<f{width}").reshape(len(raw), -1)
    return _units(values) if width == 4 else values


def _first_cells(indexes: dict[int, Index]) -> dict[int, int]:
    """Where the cells of each length begin in the numbering of all cells."""
    starts, at = {}, 0
    for length, index in sorted(indexes.items()):
        starts[length] = at
        at += index.cells
    return starts


def _probes(vectors: DataFrame, indexes: dict[int, Index], width: int) -> DataFrame:
    """(node, copies, raw, cell, visits): every vector with its own cell and the cells that it visits.

    Its own cell is the nearest one, so it is always visited.
    """
    starts = _first_cells(indexes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // width
            for length in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == length)
                index, start, units = indexes[length], starts[length], _matrix([raw[k] for k in rows.tolist()], width)
                own = start + index.cell(units)
                visits = [[start + c for c in cells] for cells in index.visited(units)]
                visits = [v if c in v else [c, *v[:-1]] for c, v in zip(own.tolist(), visits, strict=True)]
                picked = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(picked) for k in range(3)], pa.array(own.astype(np.int32)), pa.array(visits, pa.list_(pa.int32()))],
                    ["node", "copies", "raw", "cell", "visits"],
                )

    return vectors.select("node", "copies", "raw").mapInArrow(run, "node long, copies long, raw binary, cell int, visits array<int>")


_BOTH, _HELD, _ASKS = 0, 1, 2


def links(
    vectors: DataFrame, indexes: dict[int, Index], width: int, min_cosine: float = MIN_COSINE, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(node, links) counts and (a, b) stars of linked nodes; vectors has (node, copies, raw).

    ``indexes`` has one index for each length. Each length has cells of its own, so vectors of different
    lengths do not meet. ``width`` is the number of bytes of a value.

    The members of a cell are cut into blocks by a hash of the node, and so are its visits if there are very
    many; every pair of blocks is one tile. A member is sent once to each tile that holds it and asks there as
    well, and a visit once for each block of members. A pair that meets from both sides counts once.
    """
    probes = materialize(_probes(vectors, indexes, width), "probes")
    cells = probes.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("m_blocks"))
    visits = probes.select("node", "copies", "raw", F.col("cell").alias("own"), F.explode("visits").alias("cell"))
    wide = visits.groupBy("cell").agg(F.ceil(F.count("*") / (VISIT_BLOCK * block_rows)).cast("int").alias("v_blocks"))
    grid = materialize(cells.join(wide, "cell"), "grid")

    def block(blocks: str):
        return F.pmod(F.xxhash64(F.lit(5), "node"), F.col(blocks)).cast("int")

    # The cells are as many as the vectors over CELL_MEMBERS, so their table is joined by size.
    own_v, own_m = block("v_blocks"), block("m_blocks")
    asking = lookup_join(visits, grid, ["cell"], ["node"]).withColumn("m", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1)))
    # A member asks in its own tile without another row.
    asking = asking.where((F.col("own") != F.col("cell")) | (F.col("m") != own_m)).select(
        "cell", own_v.alias("v"), "m", F.lit(_ASKS).alias("kind"), "node", "copies", "raw", "own", F.lit(None).cast("array<int>").alias("visits")
    )
    held = lookup_join(probes, grid, ["cell"], ["node"]).withColumn("v", F.explode(F.sequence(F.lit(0), F.col("v_blocks") - 1)))
    held = held.select(
        "cell", "v", own_m.alias("m"), F.when(F.col("v") == own_v, _BOTH).otherwise(_HELD).alias("kind"),
        "node", "copies", "raw", F.col("cell").alias("own"), "visits",
    )
    tasks = task_count(vectors.sparkSession) * 4
    tiles = held.unionByName(asking).repartition(tasks, "cell", "v", "m").sortWithinPartitions("cell", "v", "m", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if tile is None or tile.key != tuple(keys[s].tolist()):
                    if tile is not None:
                        yield from tile.finish()
                    tile = _Tile(tuple(keys[s].tolist()), min_cosine, width)
                yield from tile.add(batch.slice(s, e - s))
        if tile is not None:
            yield from tile.finish()

    found = materialize(tiles.mapInArrow(run, "a long, b long, links long"), "tile_links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    return counts, found.where("a <> b").select("a", "b")


class _Tile:
    """The members of a block of a cell; visits are compared with them as they come."""

    def __init__(self, key: tuple[int, int, int], min_cosine: float, width: int):
        self.key, self.min_cosine, self.width = key, min_cosine, width
        self.parts: list[pa.RecordBatch] = []
        self.units = None

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Rows in order: those that are held come before those that only ask."""
        kind = rows.column(3).to_numpy()
        first = int(np.searchsorted(kind, _ASKS))
        if first:
            self.parts.append(rows.slice(0, first))
        if first < rows.num_rows:
            self._hold()
            yield from self._ask(rows.slice(first))

    def finish(self) -> Iterator[pa.RecordBatch]:
        self._hold()
        if self.units is None:
            return
        yield from self._made()
        if self.total.any():
            seen = self.total > 0
            yield self._rows(self.node[seen], self.node[seen], self.total[seen])

    def _hold(self) -> None:
        if self.units is not None or not self.parts:
            return
        held = pa.Table.from_batches(self.parts).combine_chunks()
        raw = held.column(6).to_pylist()
        self.units = _matrix(raw, self.width)
        self.small = self.units.astype(np.float32)
        self.node, self.copies = held.column(4).to_numpy(), held.column(5).to_numpy()
        spots = held.column(8).to_pylist()
        self.visits = np.full((len(spots), max(map(len, spots))), -1, np.int32)
        for k, one in enumerate(spots):
            self.visits[k, : len(one)] = one
        self.total = np.zeros(len(spots), np.int64)
        self.parts = []
        both = np.flatnonzero(held.column(3).to_numpy() == _BOTH)
        self.made = [x for at in range(0, len(both), _ASK_ROWS) for x in self._compare(
            self.units[both[at : at + _ASK_ROWS]], self.node[both[at : at + _ASK_ROWS]], self.copies[both[at : at + _ASK_ROWS]],
            np.full(len(both[at : at + _ASK_ROWS]), self.key[0], np.int32))]

    def _ask(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.units is None:
            return
        yield from self._made()
        for at in range(0, rows.num_rows, _ASK_ROWS):
            some = rows.slice(at, _ASK_ROWS)
            node, copies, own = (some.column(k).to_numpy() for k in (4, 5, 7))
            yield from self._compare(_matrix(some.column(6).to_pylist(), self.width), node, copies, own)

    def _made(self) -> list[pa.RecordBatch]:
        made, self.made = self.made, []
        return made

    @staticmethod
    def _rows(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, n)], ["a", "b", "links"])

    def _compare(self, units: np.ndarray, node: np.ndarray, copies: np.ndarray, own: np.ndarray) -> list[pa.RecordBatch]:
        """Links of asking vectors: their counts, and the smallest node that each end reaches over them."""
        i, j = np.nonzero(units.astype(np.float32) @ self.small.T >= self.min_cosine - _SLACK)
        kept = np.zeros(len(i), bool)
        for at in range(0, len(i), _VERIFY):
            p, q = i[at : at + _VERIFY], j[at : at + _VERIFY]
            close = np.einsum("ij,ij->i", units[p], self.units[q]) >= self.min_cosine
            # Whether the member visits the cell of the vector that asks: then the pair meets there as well.
            back = (self.visits[q] == own[p][:, None]).any(axis=1)
            kept[at : at + _VERIFY] = close & (node[p] != self.node[q]) & (~back | (node[p] < self.node[q]))
        i, j = i[kept], j[kept]
        if not len(i):
            return []
        np.add.at(self.total, j, copies[i])
        asked = np.zeros(len(node), np.int64)
        np.add.at(asked, i, self.copies[j])
        left, right = node.copy(), self.node.copy()
        while True:
            least = np.minimum(left[i], right[j])
            np.minimum.at(left, i, least)
            np.minimum.at(right, j, least)
            if (left[i] == right[j]).all():
                break
        ask, hold = np.unique(i), np.unique(j)
        return [
            self._rows(node[ask], left[ask], asked[ask]),
            self._rows(self.node[hold], right[hold], np.zeros(len(hold))),
        ]


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    min_cosine: float = MIN_COSINE,
    codewords: int | None = None,
    sample_vectors: int = SAMPLE_VECTORS,
    target_recall: float = TARGET_RECALL,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row whose id is not null.

    Vectors that are null, empty, zero or hold null or non-finite values link with nothing. Equal
    directions are one node with a number of copies, which all link with each other. Vectors of
    different lengths have no angle; each length has an index of its own, with ``codewords`` per half or as many
    as its number of vectors asks for. Rows with a repeated id count as separate vectors and carry the smallest
    id. An empty table gives no rows.
    """
    named = df.where(F.col(id_col).isNotNull())
    width = 4 if df.schema[vector_col].dataType.simpleString() == "array<float>" else 8
    packed = materialize(packed_vectors(named, id_col, vector_col), "vectors")
    usable = packed.where("digest is not null")
    nodes = usable.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.min("raw").alias("raw"))
    nodes = materialize(nodes, "nodes")
    size = F.octet_length("raw")
    sizes = nodes.groupBy(size.alias("size")).count().orderBy("size").collect()
    if not sizes:
        return packed.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    indexes = {}
    for r in sizes:
        same = nodes.where(size == r["size"])
        sample = drawn(same, F.col("digest"), sample_vectors, r["count"]).select("raw").toPandas()
        if not len(sample):
            sample = same.limit(1).select("raw").toPandas()
        units = _matrix(sorted(map(bytes, sample["raw"])), width)
        indexes[r["size"] // width] = Index(units, codewords or codewords_for(r["count"]), min_cosine, target_recall)
    counts, stars = links(nodes.select("node", "copies", "raw"), indexes, width, min_cosine, block_rows)
    found = nodes.drop("raw").join(counts, "node", "left").join(components(stars).withColumnRenamed("id", "node"), "node", "left")
    found = materialize(
        found.select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "node").alias("component_id"),
        ),
        "found",
    )
    joined = packed.select("id", "digest").join(found, "digest", "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
