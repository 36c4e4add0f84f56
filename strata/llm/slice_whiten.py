"""Embedding whitening by spectrum slicing (operator 13).

Every entry c of a vector becomes the whole number x = floor(1024 c) + 100000.
Tasks add up the numbers and then the products of the centred vectors; the
covariance V that reaches the driver has as many cells as the vector has pairs
of dimensions, however many rows there are.  There V is brought to tridiagonal
form by reflections (which keep its eigenvalues), and the signs of the pivots of
the LDL' factors of the shifted form say how many eigenvalues lie below a shift.
Bisection on these counts isolates the largest eigenvalue, the second and so on;
Rayleigh quotient iteration on V, from a start that inverse iteration gives,
converges cubically inside the isolated interval; the counts on both sides of
each result certify its number.  Rows are whitened in tasks, with the
components (a few vectors) as a broadcast.

Cases: a vector that is null or holds a null, infinite or NaN entry is left out;
so are vectors of another length than the most frequent one (of two equally
frequent lengths the longer one stays) and empty vectors; repeated rows count
and come back as often as they stand; a null id is an id like any other; equal
eigenvalues get any orthonormal vectors of their space, the same for all rows; a
component without spread (eigenvalue at most ``FLAT`` of the trace: fewer rows
than components, constant dimensions) can't be scaled and is left out, so a
table of equal vectors gives no rows; an empty table gives no rows; a deviation
beyond 64 bits is an error; extra columns do not clash, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
# Share of the trace up to which an eigenvalue counts as zero.
FLAT = 1e-12
# Halvings of an interval after it holds one eigenvalue only.
NARROW = 10
EPS = float(np.finfo(float).eps)


# --- vectors in tasks ------------------------------------------------------------


def usable(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows of a list column that are whole vectors of ``dim``
    finite entries, and their x (one row per vector)."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    if not len(at) or not dim:
        return at[:0], np.zeros((0, dim), np.int64)
    flat = column.take(pa.array(at)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dim)  # nulls turn into NaN
    whole = np.isfinite(values).all(axis=1)
    return at[whole], (np.floor(SCALE * values[whole]) + SHIFT).astype(np.int64)


def _dimension(vectors: DataFrame) -> int:
    """The most frequent length of the whole vectors; 0 for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            lengths = pc.list_value_length(batch.column(0))
            for dim in pc.unique(lengths.drop_null()).to_pylist():
                rows, _ = usable(batch.column(0), dim)
                counts[dim] = counts.get(dim, 0) + len(rows)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["dim", "n"])

    found = vectors.mapInArrow(run, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n"))
    best = found.filter("n > 0 AND dim > 0").orderBy(F.desc("n"), F.desc("dim")).first()
    return best["dim"] if best else 0


def _totals(vectors: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, float]:
    """Sums over all vectors of the cells that ``part`` makes of a block of x.

    ``part`` gives one flat array per block; tasks add theirs up before the
    shuffle, which carries one row per task and cell.
    """
    numbers = pa.int64() if kind == "long" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, x = usable(batch.column(0), dim)
            if len(x):
                own = part(x)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total, numbers)], ["cell", "total"])

    found = vectors.mapInArrow(run, f"cell long, total {kind}").groupBy("cell").agg(F.sum("total").alias("total"))
    return {r["cell"]: r["total"] for r in found.collect()}  # as many rows as cells


# --- eigenvalues on the driver ---------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and subdiagonal of the tridiagonal form of a symmetric matrix,
    by Householder reflections on both sides."""
    a = np.array(matrix, float)
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length == 0.0:
            continue
        v[0] += np.copysign(length, v[0])
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        p = 2.0 * (block @ v)
        q = p - (p @ v) * v
        block -= np.outer(v, q) + np.outer(q, v)
        a[k + 1 :, k] -= 2.0 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_below(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues below ``shift``: negative pivots of the LDL' factors of the
    shifted tridiagonal form."""
    tiny = EPS * (np.abs(diagonal).max(initial=0.0) + np.abs(off).max(initial=0.0)) * EPS + np.finfo(float).tiny
    squares = np.concatenate([[0.0], off * off])
    pivot, negative = 1.0, 0
    for d, s in zip((diagonal - shift).tolist(), squares.tolist()):
        pivot = d - s / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        negative += pivot < 0
    return negative


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    """A vector along (matrix - shift)^-1 x; a shift on an eigenvalue is moved by a rounding."""
    for move in (0.0, 1.0, 8.0, 64.0):
        try:
            y = np.linalg.solve(matrix - (shift + move * EPS * scale) * np.eye(len(matrix)), x)
        except np.linalg.LinAlgError:
            continue
        length = np.linalg.norm(y)
        if np.isfinite(length) and length > 0:
            return y / length
    return x


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors (rows); fewer if the matrix has fewer."""
    n = len(matrix)
    diagonal, off = tridiagonal(matrix)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low, high = float((diagonal - reach).min(initial=0.0)), float((diagonal + reach).max(initial=0.0))
    scale = max(abs(low), abs(high))
    if scale == 0.0:  # no eigenvalue but zero
        return np.zeros(min(wanted, n)), np.eye(n)[:wanted]
    low, high = low - 4 * n * EPS * scale, high + 4 * n * EPS * scale

    def above(shift: float) -> int:
        return n - count_below(diagonal, off, shift)

    start = np.random.default_rng(0).standard_normal((min(wanted, n), n))
    values, vectors = [], np.zeros((0, n))
    for j in range(1, min(wanted, n) + 1):
        # The j-th largest lies in [a, b).
        a, b, n_a, n_b, after = low, high, n, 0, 0
        while b - a > 4 * EPS * scale and after < NARROW:
            after += n_a == j and n_b == j - 1
            middle = 0.5 * (a + b)
            c = above(middle)
            if c >= j:
                a, n_a = middle, c
            else:
                b, n_b = middle, c
        margin = 8 * n * EPS * scale
        x = start[j - 1]
        rho = 0.5 * (a + b)
        for step in range(30):
            x = _solve(matrix, rho, x, scale)
            for _ in range(2):  # what rounding brings in of the vectors before
                x = x - vectors.T @ (vectors @ x)
                x /= np.linalg.norm(x) or 1.0
            quotient = float(x @ matrix @ x)
            rest = float(np.linalg.norm(matrix @ x - quotient * x))
            # Inverse iteration at first; the quotient takes over once it is inside.
            if step >= 2 and a - margin <= quotient <= b + margin:
                rho = quotient
                if rest <= 4 * np.sqrt(n) * EPS * scale:
                    break
        value = float(x @ matrix @ x)
        sure = n * EPS * scale * 64
        if above(value - sure) < j or above(value + sure) > j - 1:
            raise ArithmeticError(f"the counts do not certify eigenvalue {j}")
        values.append(value)
        vectors = np.vstack([vectors, x])
    return np.array(values), vectors


# --- operator --------------------------------------------------------------------


@dataclass
class Model:
    """What whitening needs: a few numbers per dimension, whatever the rows."""

    n: int
    sums: np.ndarray  # of x, per dimension
    values: np.ndarray  # eigenvalues of the components kept, falling
    components: np.ndarray  # their unit vectors, one row each
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One row per vector, one column per component."""
        return (self.centred(x) @ self.components.T) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n x - S)^2, exact."""
        y = self.n * x - self.sums
        top = int(np.abs(y).max(initial=0))
        if top * top * len(self.sums) < 2**63:
            return (y * y).sum(axis=1).tolist()
        out = [sum(int(v) * int(v) for v in row) for row in y]
        if max(out) >= 2**63:
            raise OverflowError("a deviation does not fit 64 bits")
        return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Model:
    """Components of all whole vectors in the first column of ``vectors``."""
    dim = _dimension(vectors)
    if not dim:
        return Model(0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0)
    sums = _totals(vectors, dim, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    n, s = int(sums[dim]), np.array([sums[i] for i in range(dim)], np.int64)
    upper = np.triu_indices(dim)

    def products(x: np.ndarray) -> np.ndarray:
        d = (n * x - s) / n
        return (d.T @ d)[upper]

    cells = _totals(vectors, dim, products, "double")
    covariance = np.zeros((dim, dim))
    covariance[upper] = [cells[i] / n for i in range(len(cells))]
    covariance += np.triu(covariance, 1).T
    trace = float(np.trace(covariance))
    values, own = leading(covariance, components)
    kept = values > FLAT * trace if trace > 0 else np.zeros(len(values), bool)
    return Model(n, s, values[kept], own[kept], trace)


def identity_error(vectors: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of all whitened rows minus the
    identity, from the whitened values themselves."""
    k = len(model.values)
    if not k:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    cells = _totals(vectors, len(model.sums), moments, "double")
    mean = np.array([cells[i] for i in range(k)]) / model.n
    covariance = np.array([cells[k + i] for i in range(k * k)]).reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per whole vector of ``table`` and component: the key, component
    (from 1), n, deviation, whitened, explained, identity_error."""
    vectors = table.select(vector)
    model = fit(vectors, components)
    error = identity_error(vectors, model)
    shared = table.sparkSession.sparkContext.broadcast(model)  # size set by the dimension
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        k = len(own.values)
        for batch in batches:
            rows, x = usable(batch.column(1), len(own.sums))
            if not k or not len(rows):
                continue
            columns = [
                batch.column(0).take(pa.array(np.repeat(rows, k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(rows) * k, own.n, np.int64)),
                pa.array(np.repeat(np.array(own.deviations(x), np.int64), k)),
                pa.array(own.whitened(x).ravel()),
                pa.array(np.tile(own.values / own.trace, len(rows))),
                pa.array(np.full(len(rows) * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, *names])

    kind = table.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return table.select(key, vector).mapInArrow(run, schema)
