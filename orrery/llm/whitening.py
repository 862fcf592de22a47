"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become integers x = floor(scale * c) + offset. One pass sums them per dimension,
a second sums the products of what is left after the rounded means are taken away; both
sums are exact, so they depend neither on the order of rows nor on partitions, and the
covariance about the true means follows from them in integers. A pivoted Cholesky
factor of it (dimensions squared, whatever the number of rows) is rotated from the
right until its columns are orthogonal: their squared norms are the eigenvalues, the
columns over their norms the components. A last pass measures the covariance of what
whitening gives.

Tasks send one row per pair of dimensions, and Spark sums them by pair, so neither the
driver nor a task gathers vectors. The driver holds matrices of dims x dims numbers.

Vectors that are null or hold null or non-finite entries take no part and have no row.
Shorter vectors are padded with zeros. Repeated rows and rows with a null id count and
are returned like any other. Entries whose x passes 2**61 either way are held there.
Fewer dimensions than asked for give that many components; a component without variance
has explained 0 and whitened null (explained null where nothing varies at all). Equal
eigenvalues stand in the order the rotations leave. A deviation that no long can hold is
null. An empty table gives no rows. Only the id and the vector column are read, so other
columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectors import matrix, usable

HOLD = float(1 << 61)
LIMB = 40
_LIMBS = 4
_STEP = 20
_ROWS = 4096  # rows of products that are summed as doubles without rounding: 2**(2 * _STEP) each


def integers(v: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """x = floor(scale * c) + offset of every entry."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(v * scale), -HOLD, HOLD).astype(np.int64) + offset


def limbs(values) -> list[list[int]]:
    """Whole numbers as digits to the base 2**40, the last one signed; sums of digits are digits of sums."""
    ints = [int(v) for v in values]
    low = (1 << LIMB) - 1
    return [[(v >> LIMB * k) & low if k < _LIMBS - 1 else v >> LIMB * k for v in ints] for k in range(_LIMBS)]


def whole(row) -> int:
    """The number that summed digits stand for."""
    return sum(int(row[f"l{k}"]) << LIMB * k for k in range(_LIMBS))


class Products:
    """Exact sums of z_i * z_j over rows of whole numbers."""

    def __init__(self, dims: int):
        self.total = np.zeros((dims, dims), object)
        self.part: dict[tuple[int, int], np.ndarray] = {}
        self.batches = 0

    def add(self, z: np.ndarray) -> None:
        for at in range(0, len(z), _ROWS):
            digits, rest = [], z[at:at + _ROWS]
            while not digits or rest.any():
                low = rest & ((1 << _STEP) - 1)
                low -= (low >> (_STEP - 1)) << _STEP  # nearest digit: small numbers of either sign have one
                digits.append(low.astype(np.float64))
                rest = (rest - low) >> _STEP
            for i, a in enumerate(digits):
                for j, b in enumerate(digits):
                    got = (a.T @ b).astype(np.int64)
                    self.part[i, j] = self.part[i, j] + got if (i, j) in self.part else got
            self.batches += 1
            if self.batches % 256 == 0:
                self.flush()

    def flush(self) -> np.ndarray:
        for (i, j), p in self.part.items():
            self.total = self.total + p.astype(object) * (1 << _STEP * (i + j))
        self.part.clear()
        return self.total


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """Factor with v = factor @ factor.T, triangular up to the order of its rows: the dimension with
    most variance left comes next, until what is left of each is rounding."""
    d = len(v)
    factor, left = np.zeros((d, d)), np.diag(v).copy()
    noise = 8 * d * np.finfo(float).eps * left
    for k in range(d):
        open_ = left > noise
        if not open_.any():
            return factor[:, :k]
        p = int(np.argmax(np.where(open_, left, -1.0)))
        column = (v[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(left[p])
        column[left <= 0] = 0.0  # dimensions that were pivots already
        column[p] = np.sqrt(left[p])
        factor[:, k] = column
        left = left - column ** 2
        left[p] = 0.0
        noise[p] = np.inf
    return factor


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor after rotations of pairs of columns that make them orthogonal. Each round takes
    every column once, in disjoint pairs."""
    g = factor.copy()
    n = g.shape[1] + g.shape[1] % 2
    ring = list(range(n))
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for _ in range(n - 1):
            pairs = [(a, b) for a, b in zip(ring[:n // 2], reversed(ring[n // 2:])) if max(a, b) < g.shape[1]]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = np.array(pairs, int).reshape(-1, 2).T
            x, y = g[:, p], g[:, q]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            on = np.abs(gamma) > 4 * eps * np.sqrt(alpha * beta)
            if not on.any():
                continue
            turned = True
            p, q, x, y = p[on], q[on], x[:, on], y[:, on]
            zeta = (beta[on] - alpha[on]) / (2 * gamma[on])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            g[:, p], g[:, q] = c * x - s * y, s * x + c * y
        if not turned:
            break
    return g


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero, falling, and their unit eigenvectors as columns (largest entry positive)."""
    factor = pivoted_cholesky(v)
    if not factor.shape[1]:
        return np.zeros(0), factor
    g = orthogonal_columns(factor)
    norms = np.sqrt((g ** 2).sum(0))
    order = np.argsort(-norms, kind="stable")
    g, norms = g[:, order], norms[order]
    unit = g / norms
    lead = unit[np.abs(unit).argmax(0), np.arange(unit.shape[1])]
    return norms ** 2, unit * np.where(lead < 0, -1.0, 1.0)


class Whitening:
    """The fit over all usable vectors, and the whitened rows.

    ``n`` vectors of ``dims`` entries; ``sums`` of their x; ``values`` and ``vectors``: eigenvalues of
    the first ``components`` components (0 beyond the rank) and the components themselves;
    ``trace`` of the covariance; ``identity_error`` of what whitening gives (null without components)."""

    def __init__(self, rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 8,
                 scale: int = 1024, offset: int = 100_000):
        self.spark = rows.sparkSession
        self.scale, self.offset = scale, offset
        self.id_type = rows.select(F.col(f"`{id_column}`")).schema[0].dataType
        self.rows = (rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
                     .filter(usable(F.col("v"))))
        first = self.rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
        self.n, self.dims = first["n"], first["dims"] or 0
        self.components = min(components, self.dims)
        self.values, self.vectors = np.zeros(self.components), np.zeros((self.dims, self.components))
        self.trace, self.identity_error = 0.0, None
        if not self.n or not self.dims:
            return
        self.sums = self._sums()
        self.middle = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        self.rest = [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]  # n * (mean - middle)
        covariance = self._covariance()
        self.trace = float(np.trace(covariance))
        values, vectors = eigen(covariance)
        k = min(len(values), self.components)
        self.rank = k
        self.values[:k], self.vectors[:, :k] = values[:k], vectors[:, :k]
        if k:
            self.identity_error = self._identity_error()

    def _exact(self, partials, key: str) -> dict:
        """Sums by Spark of the digits that tasks send, per key."""
        names = [f"l{k}" for k in range(_LIMBS)]
        sent = self.rows.select("v").mapInArrow(partials, f"{key}, " + ", ".join(f"{n} long" for n in names))
        keys = [k.split()[0] for k in key.split(", ")]
        return {tuple(r[k] for k in keys): whole(r) for r in sent.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in names)).collect()}

    def _sums(self) -> list[int]:
        dims, scale, offset = self.dims, self.scale, self.offset

        def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(dims, object)
            for b in batches:
                x = integers(matrix(b["v"], dims), scale, offset)
                total = total + ((x >> 31).sum(0).astype(object) << 31) + (x & ((1 << 31) - 1)).sum(0).astype(object)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), *(pa.array(v, pa.int64()) for v in limbs(total))],
                                             ["i", *(f"l{k}" for k in range(_LIMBS))])

        got = self._exact(partials, "i int")
        return [got[(i,)] for i in range(dims)]

    def _covariance(self) -> np.ndarray:
        dims, scale, offset, middle = self.dims, self.scale, self.offset, self.middle
        upper = np.triu_indices(dims)

        def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            products = Products(dims)
            for b in batches:
                products.add(integers(matrix(b["v"], dims), scale, offset) - middle)
            total = products.flush()[upper]
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)),
                                              *(pa.array(v, pa.int64()) for v in limbs(total))], ["i", "j", *(f"l{k}" for k in range(_LIMBS))])

        out, n = np.zeros((dims, dims)), self.n
        for (i, j), p in self._exact(partials, "i int, j int").items():
            out[i, j] = out[j, i] = (n * p - self.rest[i] * self.rest[j]) / (n * n)
        return out

    def _projector(self):
        """Function from a matrix of x to whitened rows."""
        middle, left = self.middle, np.array([r / self.n for r in self.rest])
        axes = self.vectors[:, :self.rank] / np.sqrt(self.values[:self.rank])
        return lambda x: ((x - middle) - left) @ axes

    def _identity_error(self) -> float:
        dims, scale, offset, k, project = self.dims, self.scale, self.offset, self.rank, self._projector()
        i, j = np.triu_indices(k)

        def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mean, square = np.zeros(k), np.zeros((k, k))
            for b in batches:
                w = project(integers(matrix(b["v"], dims), scale, offset))
                mean += w.sum(0)
                square += w.T @ w
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(k, -1), i]).astype(np.int32)),
                                              pa.array(np.concatenate([np.arange(k), j]).astype(np.int32)),
                                              pa.array(np.concatenate([mean, square[i, j]]))], ["i", "j", "s"])

        got = {(r["i"], r["j"]): r["s"] / self.n for r in self.rows.select("v").mapInArrow(partials, "i int, j int, s double")
               .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
        return max(abs(got[a, b] - got[-1, a] * got[-1, b] - (a == b)) for a, b in zip(i.tolist(), j.tolist()))

    def whitened(self) -> DataFrame:
        """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every usable row."""
        schema = T.StructType([T.StructField("vec_id", self.id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                               T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                               T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
        if not self.n or not self.components:
            return self.spark.createDataFrame([], schema)
        dims, scale, offset, n, count, rank = self.dims, self.scale, self.offset, self.n, self.components, self.rank
        middle, rest, project, error = self.middle, self.rest, self._projector() if self.rank else None, self.identity_error
        explained = self.values / self.trace if self.trace else np.full(count, np.nan)

        def deviations(x: np.ndarray) -> pa.Array:
            """Sum over dimensions of (n * x - sum)**2: in longs that wrap round, right wherever the result is a long."""
            z = x - middle
            about = ((float(n) * z - np.array(rest, np.float64)) ** 2).sum(1)
            with np.errstate(over="ignore"):
                wrapped = np.array([n & ((1 << 64) - 1)], np.uint64) * z.astype(np.uint64) - np.array([r % (1 << 64) for r in rest], np.uint64)
                out = (wrapped * wrapped).sum(1, dtype=np.uint64).view(np.int64).astype(np.int64)
            fits = about < 2.0 ** 63 * (1 - 1e-6)
            for at in np.flatnonzero(~fits & (about < 2.0 ** 63 * (1 + 1e-6))):
                fits[at] = sum((n * int(v) - r) ** 2 for v, r in zip(z[at], rest)) < 1 << 63
            return pa.array(out, mask=~fits)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = integers(matrix(b["v"], dims), scale, offset)
                w = np.full((len(x), count), np.nan)
                if rank:
                    w[:, :rank] = project(x)
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), count))
                none = np.tile(np.arange(count) >= rank, m)
                yield pa.RecordBatch.from_arrays(
                    [b["id"].take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)), pa.array(np.full(m * count, n)),
                     deviations(x).take(each), pa.array(w.ravel(), mask=none), pa.array(np.tile(explained, m), mask=np.tile(np.isnan(explained), m)),
                     pa.array([error] * (m * count), pa.float64())], schema.names)

        return self.rows.mapInArrow(rows, schema)
