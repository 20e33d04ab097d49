"""Embedding whitening by a bit-sliced scatter matrix.

Every entry becomes a whole number. Within a block of rows each dimension is shifted to start at zero and
cut into bit planes; a plane is packed across the rows into 64-bit words. The product sum of two dimensions
is then the sum over pairs of their planes of ``2**(a + b)`` times the population count of the AND of the two
planes, which is exact. The shift is taken back in whole numbers, the sums of all tasks are added by Spark,
and ``n * sum(x*y) - sum(x) * sum(y)`` is a whole number too, so the only rounding before the
eigenvectors is the division by ``n**2``.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiweave.llm.batches import fresh
from lexiweave.runtime import lookup_join, materialize

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
# Rows that are packed together, a multiple of 64.
BLOCK_ROWS = 4096
# Scaled entries beyond this bound count as non-finite.
LARGEST = 1 << 52
# Words of one AND at a time.
_AND_WORDS = 1 << 18
# Sums leave a task in parts of this many bits, so that no sum of parts can pass 64 bits.
_LIMB_BITS = 30
_LIMBS = 6
# All models together may take this much; they go to every task.
MODEL_BYTES = 64 * 1024 * 1024


def whole_numbers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * entry) + offset for every entry, in double precision; null if the vector cannot be used."""
    finite = F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * scale) < F.lit(float(LARGEST)))
    )
    return F.when(finite, F.transform(vector, lambda v: F.floor(v.cast("double") * scale) + F.lit(offset).cast("long")))


def planes_of(shifted: np.ndarray) -> np.ndarray:
    """Bit planes (bit, dimension, word) of a matrix of numbers from zero up, packed across its rows."""
    rows, dims = shifted.shape
    bits = max(int(shifted.max(initial=0)).bit_length(), 1)
    packed = np.zeros((bits, dims, -(-rows // 64) * 8), np.uint8)
    columns = np.ascontiguousarray(shifted.T)
    for bit in range(bits):
        some = np.packbits(((columns >> bit) & 1).astype(np.uint8), axis=1, bitorder="little")
        packed[bit, :, : some.shape[1]] = some
    return packed.view(np.uint64)


def _counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Population counts of the AND of every row of ``a`` with every row of ``b``."""
    found = np.empty((len(a), len(b)), np.int64)
    step = max(1, _AND_WORDS // max(b.size, 1))
    for at in range(0, len(a), step):
        both = a[at : at + step, None, :] & b[None, :, :]
        found[at : at + step] = np.bitwise_count(both).sum(axis=2, dtype=np.int64)
    return found


def scatter(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and product sums (as Python integers) of the columns of a block of whole numbers."""
    rows, dims = block.shape
    least = block.min(axis=0)
    planes = planes_of(block - least)
    bits = len(planes)
    # Up to 2**12 rows of numbers below 2**25 cannot pass 64 bits.
    kind = np.int64 if 2 * bits + int(rows).bit_length() < 63 else object
    sums, products = np.zeros(dims, kind), np.zeros((dims, dims), kind)
    for a in range(bits):
        sums += np.bitwise_count(planes[a]).sum(axis=1, dtype=np.int64).astype(kind) * (1 << a)
        for b in range(a, bits):
            found = _counts(planes[a], planes[b]).astype(kind) * (1 << (a + b))
            products += found if a == b else found + found.T
    sums, products, shift = sums.astype(object), products.astype(object), least.astype(object)
    moved = np.multiply.outer(shift, sums)
    products += moved + moved.T + rows * np.multiply.outer(shift, shift)
    return sums + rows * shift, products


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of the vectors of each length above zero of a list column without nulls."""
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        yield length, rows, values[offsets[rows][:, None] + np.arange(length)]


def _limb_rows(dim: int, n: int, sums: np.ndarray, products: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sums of a task as rows (dim, i, j, limb, value); the count has i = -1, plain sums have j = -1."""
    i, j = np.triu_indices(dim)
    value = np.concatenate([[n], sums, products[i, j]]).astype(object)
    i = np.concatenate([[-1], np.arange(dim), i]).astype(np.int32)
    j = np.concatenate([np.full(dim + 1, -1), j]).astype(np.int32)
    negative = value < 0
    rest = np.abs(value)
    for limb in range(_LIMBS):
        low = (rest & ((1 << _LIMB_BITS) - 1)).astype(np.int64)
        rest = rest >> _LIMB_BITS
        kept = low != 0
        if kept.any():
            signed = np.where(negative, -low, low)[kept]
            count = int(kept.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, dim, np.int32)), pa.array(i[kept]), pa.array(j[kept]),
                 pa.array(np.full(count, limb, np.int32)), pa.array(signed)],
                ["dim", "i", "j", "limb", "value"],
            )


def sums_of(vectors: DataFrame, x: str) -> DataFrame:
    """Count, sums and product sums of the whole-number vectors in ``x``, in limbs, per vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for dim, _, matrix in _by_length(batch.column(0)):
                # Close to zero, so that shifts stay small numbers.
                matrix = matrix - OFFSET
                for at in range(0, len(matrix), BLOCK_ROWS):
                    block = matrix[at : at + BLOCK_ROWS]
                    sums, products = scatter(block)
                    if dim in totals:
                        old = totals[dim]
                        totals[dim] = [old[0] + len(block), old[1] + sums, old[2] + products]
                    else:
                        totals[dim] = [len(block), sums, products]
        for dim, (n, sums, products) in totals.items():
            yield from _limb_rows(dim, n, sums, products)

    parts = vectors.select(x).mapInArrow(run, "dim int, i int, j int, limb int, value long")
    return parts.groupBy("dim", "i", "j", "limb").agg(F.sum("value").alias("value"))


_MODEL = "dim int, n long, sums array<decimal(38,0)>, variances array<double>, axes array<double>, explained array<double>"


def eigen_model(dim: int, n: int, sums: np.ndarray, products: np.ndarray, components: int) -> tuple[list[float], np.ndarray, list[float]]:
    """Leading eigenvalues, unit eigenvectors and shares of the trace, from exact whole-number sums.

    A component without variance (below rounding of the largest) has eigenvalue 0.
    """
    exact = n * products - np.multiply.outer(sums, sums)
    square = n * n
    covariance = np.array([[value / square for value in row] for row in exact.tolist()], np.float64)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, axes = values[order], axes[:, order].T
    trace = sum(exact[k, k] for k in range(dim)) / square
    values = np.where(values > max(values[0], 0.0) * dim * 1e-15, values, 0.0)
    largest = np.abs(axes).argmax(axis=1)
    axes = axes * np.sign(axes[np.arange(len(axes)), largest])[:, None]
    return values.tolist(), axes, (values / trace if trace > 0 else values * 0.0).tolist()


def fit(vectors: DataFrame, x: str, components: int = COMPONENTS) -> DataFrame:
    """One row per vector length: count, sums, eigenvalues, eigenvectors (row by row) and explained shares.

    What is gathered for a length grows with the square of the length alone.
    """
    stored = materialize(sums_of(vectors, x), "scatter")

    def solve(key: tuple[object, ...], rows: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        total: dict[tuple[int, int], int] = {}
        for i, j, limb, value in zip(*(rows[c].tolist() for c in ("i", "j", "limb", "value")), strict=True):
            total[i, j] = total.get((i, j), 0) + (value << (_LIMB_BITS * limb))
        n = total[-1, -1]
        sums = np.array([total.get((i, -1), 0) for i in range(dim)] + [None], object)[:-1]
        products = np.zeros((dim, dim), object)
        for (i, j), value in total.items():
            if j >= 0:
                products[i, j] = products[j, i] = value
        values, axes, explained = eigen_model(dim, n, sums, products, components)
        moved = [Decimal(int(s) + n * OFFSET) for s in sums]
        return pd.DataFrame(
            {"dim": [dim], "n": [n], "sums": [moved], "variances": [values], "axes": [axes.ravel().tolist()], "explained": [explained]}
        )

    return materialize(stored.groupBy("dim").applyInPandas(solve, _MODEL), "whitening")


def _deviations(matrix: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, pa.Array]:
    """n * x - S of every entry, as double, and the exact sum of squares of every row (null beyond a long)."""
    low, high = int(matrix.min()), int(matrix.max())
    most = max(abs(n * b - s) for b in (low, high) for s in (min(sums), max(sums)))
    if most * most * len(sums) < 1 << 63 and n * max(abs(low), abs(high)) < 1 << 63:
        moved = matrix * n - np.array(sums, np.int64)
        return moved.astype(np.float64), pa.array((moved * moved).sum(axis=1), pa.int64())
    moved = matrix.astype(object) * n - np.array([*sums, None], object)[:-1]
    squares = [sum(v * v for v in row) for row in moved.tolist()]
    return moved.astype(np.float64), pa.array([v if v < 1 << 63 else None for v in squares], pa.int64())


def project(vectors: DataFrame, x: str, model: DataFrame) -> DataFrame:
    """``vectors`` with dim, n, deviation and the array ``whitened``; a component without variance gives null.

    The models hold ten numbers per component and dimension at most; all of them are sent to the tasks, and an
    error is raised if they pass ``MODEL_BYTES`` together.
    """
    size = model.agg(F.sum((F.size("axes") + 20 * F.size("sums")) * 8)).first()[0] or 0
    if size > MODEL_BYTES:
        raise ValueError(f"the models of all vector lengths take {size} bytes, more than {MODEL_BYTES}")
    known = {}
    for row in model.collect():
        dim, variances = row["dim"], np.array(row["variances"])
        axes = np.array(row["axes"]).reshape(len(variances), dim)
        known[dim] = (row["n"], [int(s) for s in row["sums"]], variances, axes)
    kept = [f for f in vectors.schema.fields if f.name != x]
    names = [f.name for f in kept] + ["dim", "n", "deviation", "whitened"]
    added = [("dim", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.ArrayType(T.DoubleType()))]
    schema = T.StructType(kept + [T.StructField(name, kind) for name, kind in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(x)
            rest = [batch.column(k) for k in range(batch.num_columns) if k != place]
            for dim, rows, matrix in _by_length(batch.column(place)):
                n, sums, variances, axes = known[dim]
                moved, deviation = _deviations(matrix, n, sums)
                scores = (moved / n) @ axes.T
                flat = variances == 0
                scores[:, ~flat] /= np.sqrt(variances[~flat])
                mask = np.broadcast_to(flat, scores.shape).ravel()
                values = pa.array(scores.ravel(), pa.float64(), mask=mask)
                offsets = np.arange(0, scores.size + 1, len(variances), dtype=np.int32)
                count = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [c.take(pa.array(rows)) for c in rest]
                    + [pa.array(np.full(count, dim, np.int32)), pa.array(np.full(count, n)), deviation,
                       pa.ListArray.from_arrays(pa.array(offsets), values)],
                    names=names,
                )

    columns = [F.col(f"`{f.name}`") for f in kept] + [F.col(x)]
    return vectors.select(*columns).mapInArrow(run, schema)


def identity_errors(whitened: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector length, the largest entry of the measured covariance of ``whitened`` minus the identity.

    Components without variance are left out. The covariance of Spark centres before it multiplies.
    """
    part = [F.get("whitened", F.lit(k)) for k in range(components)]
    entries = []
    for i in range(components):
        for j in range(i, components):
            entry = F.covar_pop(part[i], part[j]) - F.lit(1.0 if i == j else 0.0)
            entries.append(F.coalesce(F.abs(entry), F.lit(0.0)).alias(f"e{i}_{j}"))
    table = whitened.groupBy("dim").agg(*entries)
    worst = F.array_max(F.array(*[F.col(c) for c in table.columns if c != "dim"]))
    return table.select("dim", worst.alias("identity_error"))


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), one row per vector and component.

    ``x = floor(1024 * entry) + 100000`` in double precision. Vectors that are null or hold null or non-finite
    entries are left out, and so are those with an entry of 2**52 / 1024 or more, since such an x cannot be
    summed exactly. Vectors of each length are whitened by themselves; empty ones have no components. A length
    below ``components`` has as many components as dimensions. ``deviation`` is the exact sum over dimensions of
    ``(n*x - S)**2``, null if it passes a long. A component without variance (all vectors equal, fewer vectors
    than components) has whitened null and explained 0 and takes no part in ``identity_error``. Repeated ids and
    rows with a null id are rows like others, equal eigenvalues keep the order of the solver, and an empty table
    gives an empty result.
    """
    x = fresh("x", [id_col])
    usable = df.select(F.col(f"`{id_col}`"), whole_numbers(F.col(f"`{vec_col}`")).alias(x))
    usable = usable.where(F.col(x).isNotNull() & (F.size(x) > 0))
    model = fit(usable, x, components)
    rows = materialize(project(usable, x, model), "whitened")
    shares = materialize(model.select("dim", "explained").join(identity_errors(rows, components), "dim"), "shares")
    told = lookup_join(rows, shares, ["dim"], [id_col])
    return told.select(F.col(f"`{id_col}`"), "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("_k", "whitened")).select(
        F.col(f"`{id_col}`"),
        (F.col("_k") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get("explained", F.col("_k")).alias("explained"),
        "identity_error",
    )
