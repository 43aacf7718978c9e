"""Whitening of embeddings; principal components by QDWH spectral divide-and-conquer.

The vectors, in fixed point (see ``fixed_point``), give a fit list with each
distinct vector once, its sums, and its covariance. Tasks sum d x d matrices of
centred vectors, and these are added in two rounds of bounded groups. Only
matrices of the vectors' own dimension come to the driver, whatever the rows.

There the covariance is split. The polar factor of the covariance less a shift,
by the QR form of the dynamically weighted Halley iteration, has eigenvalue 1
above the shift and -1 below; half of it and the identity is the projector onto
the components above. Orthonormal bases of it and of its complement split the
matrix in two, and each half is split again until single components are left.

Whitened rows are the centred vectors projected on the components, over the
roots of the eigenvalues. The projection is d x k numbers and goes with the
tasks.

Cases: a row whose vector is null or holds a null or non-finite entry is left
out; entries beyond the range of a long count as its ends; an empty vector has
no components and gives no row; vectors of several lengths are fitted apart, each
with its own ``n``; repeated rows give repeated results and count once in the
fit; a component without variance (an eigenvalue of at most the rounding of the
trace) has ``whitened`` null and ``explained`` 0, and ``identity_error`` is over the
others, null if there is none; a ``deviation`` beyond a long is null; null ids
stay; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.staging import stage

SCALE = 256
COMPONENTS = 4
#: Partial matrices are added in so many groups first, then those sums.
GROUPS = 512

_EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray, steps: int = 12) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix."""
    size = len(a)
    x = a / np.abs(a).max()
    x = x / np.linalg.norm(x)
    r = np.linalg.qr(x, mode="r")
    least = np.abs(np.diag(r)).min()
    low = max(1 / (np.linalg.norm(np.linalg.inv(r), 1) * np.sqrt(size)), _EPS) if least > _EPS**2 else _EPS
    for _ in range(steps):
        square = low * low
        root = np.sqrt(1 + np.cbrt(4 * (1 - square) / (square * square)))
        weight = root + np.sqrt(8 - 4 * (root * root - 1) + 8 * (2 - square) / (square * root)) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))[0]
        after = (b / c) * x + (weight - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        moved, x = np.linalg.norm(after - x), (after + after.T) / 2
        low = min(low * (weight + b * square) / (1 + c * square), 1.0)
        if moved < np.cbrt(_EPS) and 1 - low < 10 * _EPS:
            break
    return x


def _shifts(a: np.ndarray) -> list[float]:
    """The mean eigenvalue lies between the least and the greatest; the others stand in where it is one itself."""
    mean, spread = np.trace(a) / len(a), np.linalg.norm(a - np.eye(len(a)) * np.trace(a) / len(a)) / np.sqrt(len(a))
    return [float(mean), float(np.median(np.diag(a)))] + [float(mean + spread * s) for s in (0.31, -0.29, 0.11, -0.13, 0.03, -0.02)]


def _halves(a: np.ndarray) -> tuple[np.ndarray, int]:
    """An orthogonal basis whose first columns span what lies above a shift, and their number."""
    size = len(a)
    drawn = np.random.default_rng(size).standard_normal((size, size))
    best = None
    for shift in _shifts(a):
        above = (polar_factor(a - shift * np.eye(size)) + np.eye(size)) / 2
        k = int(round(np.trace(above)))
        if not 0 < k < size:
            continue
        basis = np.linalg.qr(above @ np.linalg.qr(above @ drawn[:, :k])[0])[0]
        rest = drawn[:, k:] - basis @ (basis.T @ drawn[:, k:])
        basis = np.linalg.qr(np.hstack([basis, rest]))[0]
        left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if best is None or left < best[0]:
            best = (left, basis, k)
        if left <= 10 * size * _EPS * np.linalg.norm(a):
            break
    if best is None:
        raise ArithmeticError("no shift parts the spectrum")
    return best[1], best[2]


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    whole = np.linalg.norm(a)

    def split(block: np.ndarray) -> np.ndarray:
        size = len(block)
        even = np.eye(size) * np.trace(block) / size
        if size == 1 or np.linalg.norm(block - even) <= _EPS * whole:
            return np.eye(size)
        basis, k = _halves(block)
        turned = basis.T @ block @ basis
        turned = (turned + turned.T) / 2
        return np.hstack([basis[:, :k] @ split(turned[:k, :k]), basis[:, k:] @ split(turned[k:, k:])])

    vectors = split((a + a.T) / 2)
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = (vectors * (a @ vectors)).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Fit:
    """What the vectors of one length need: ``n``, sums, mean, and the projection (``None`` without variance)."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def scales(self, k: int) -> list[float | None]:
        least = self.trace * len(self.sums) * _EPS
        return [float(1 / np.sqrt(e)) if e > least else None for e in self.eigenvalues[:k]]

    def explained(self, k: int) -> list[float]:
        return [float(e / self.trace) if s is not None else 0.0 for e, s in zip(self.eigenvalues[:k], self.scales(k), strict=True)]

    def whitened(self, x: np.ndarray, k: int) -> list[np.ndarray | None]:
        turned = self.centred(x) @ self.vectors[:, :k]
        return [None if s is None else turned[:, i] * s for i, s in enumerate(self.scales(k))]

    def deviations(self, x: np.ndarray) -> pa.Array:
        far = self.centred(x) * self.n
        rough = (far * far).sum(1)
        if (rough < 2.0**62).all() and _safe(x, self.n, self.sums):
            exact = self.n * x - np.array(self.sums, np.int64)
            return pa.array((exact * exact).sum(1))
        whole = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())


def _safe(x: np.ndarray, n: int, sums: list[int]) -> bool:
    return not len(x) or (max(abs(int(x.min())), abs(int(x.max()))) * n < 1 << 61 and max(map(abs, sums)) < 1 << 61)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - S / n``; where it fits, from the whole numbers ``n * x - S``."""
    if _safe(x, n, sums):
        return (n * x - np.array(sums, np.int64)) / n
    return x - np.array([s / n for s in sums])


def _by_length(column: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Row numbers and vectors of each length above 0."""
    sizes = pc.list_value_length(column)
    for size in sizes.unique().to_pylist():
        if size:
            rows = pc.indices_nonzero(pc.equal(sizes, size))
            yield rows, pc.list_flatten(column.take(rows)).to_numpy(zero_copy_only=False).reshape(-1, size)


def fixed_point(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``x``, the vector's entries as whole numbers of 1 / ``scale``; unusable rows are left out."""
    vector = F.col("embedding")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = rows.select("vec_id", "embedding").filter(vector.isNotNull()).filter(finite)
    return usable.select("vec_id", F.transform(vector, lambda v: F.floor(v.cast("double") * F.lit(float(scale)))).alias("x"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per dimension, in halves of 32 bits, which no batch overflows."""
    for batch in batches:
        for _, x in _by_length(batch.column(0)):
            size = x.shape[1]
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            columns = {"size": [size] * size, "dim": range(size), "n": [len(x)] * size, "high": high, "low": low}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()})


def _products(known: dict[int, tuple[int, list[int]]]):
    """Per task and length the rows of the matrix of products of centred entries."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _by_length(batch.column(0)):
                u = _centred(x, *known[x.shape[1]])
                held[x.shape[1]] = held.get(x.shape[1], 0) + u.T @ u
        for size, matrix in held.items():
            rows = pa.array(list(matrix), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([size] * size, pa.int64()), pa.array(range(size), pa.int64()), rows], ["size", "dim", "row"])

    return multiply


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.iloc[:1].assign(row=[np.add.reduce(rows["row"].to_list())])


def fit(rows: DataFrame, k: int = COMPONENTS) -> dict[int, Fit]:
    """The components of distinct vectors ``x``, by length."""
    distinct = stage(rows.select("x").distinct(), "fit-vectors")
    sums = distinct.mapInArrow(_summed, "size long, dim long, n long, high long, low long")
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    known: dict[int, tuple[int, list[int]]] = {}
    for row in sums.groupBy("size", "dim").agg(F.sum("n").alias("n"), *whole).orderBy("size", "dim").collect():
        known.setdefault(row["size"], (row.n, []))[1].append((int(row.high) << 32) + int(row.low))
    schema = "size long, dim long, row array<double>"
    parts = distinct.mapInArrow(_products(known), schema).withColumn("part", F.spark_partition_id() % GROUPS)
    some = parts.groupBy("size", "dim", "part").applyInPandas(_added, f"{schema}, part int")
    matrices: dict[int, list] = {}
    for row in some.groupBy("size", "dim").applyInPandas(_added, f"{schema}, part int").orderBy("size", "dim").collect():
        matrices.setdefault(row["size"], []).append(row["row"])
    fits = {}
    for size, (n, totals) in known.items():
        covariance = np.array(matrices[size]) / n
        values, vectors = components(covariance)
        fits[size] = Fit(n, totals, values, vectors, float(np.trace(covariance)))
    _measure(distinct, fits, k)
    return fits


def _leading(fits: dict[int, Fit], k: int) -> dict[int, Fit]:
    """Without the components that a task does not need."""
    return {size: replace(found, vectors=found.vectors[:, :k]) for size, found in fits.items()}


def _projected(fits: dict[int, Fit], k: int):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _by_length(batch.column(0)):
                found = [pa.nulls(len(x), pa.float64()) if w is None else pa.array(w) for w in fits[x.shape[1]].whitened(x, k)]
                found += [pa.nulls(len(x), pa.float64())] * (k - len(found))
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]] * len(x), pa.int64()), *found], ["size", *[f"w{i}" for i in range(k)]])

    return project


def _measure(distinct: DataFrame, fits: dict[int, Fit], k: int) -> None:
    """The covariance of the whitened fit list against the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    whitened = distinct.mapInArrow(_projected(_leading(fits, k), k), "size long, " + ", ".join(f"w{i} double" for i in range(k)))
    aggregates = [F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]
    for row in whitened.groupBy("size").agg(*aggregates).collect():
        off = [abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs if row[f"c{i}_{j}"] is not None]
        fits[row["size"]].identity_error = max(off, default=None)


def _rows_out(fits: dict[int, Fit], k: int):
    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _by_length(batch.column(1)):
                found = fits[x.shape[1]]
                ids, deviation = batch.column(0).take(rows), found.deviations(x)
                for i, (white, share) in enumerate(zip(found.whitened(x, k), found.explained(k), strict=True)):
                    columns = {
                        "vec_id": ids,
                        "component": pa.array([i + 1] * len(x), pa.int32()),
                        "n": pa.array([found.n] * len(x), pa.int64()),
                        "deviation": deviation,
                        "whitened": pa.nulls(len(x), pa.float64()) if white is None else pa.array(white),
                        "explained": pa.array([share] * len(x), pa.float64()),
                        "identity_error": pa.array([found.identity_error] * len(x), pa.float64()),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    return give


def whitened(rows: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, up to ``k``."""
    points = fixed_point(rows)
    fits = fit(points, k)
    kind = dict(points.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return points.mapInArrow(_rows_out(_leading(fits, k), k), schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
