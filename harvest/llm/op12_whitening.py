"""Whitening of embeddings along their principal components, found by QDWH spectral divide and conquer.

Entries become integers ``x = floor(256 * c)``; each distinct vector counts once in the fit. Spark finds the distinct vectors
(equal ones are merged before they move), their number and sums, then the sums of products of the vectors less their rounded
mean; both sums are of integers, hence exact in any order of tasks, and what the rounding of the mean left over is taken off in
exact arithmetic as well. Rows of these sums are the only thing that reaches the driver: d sums and d (d + 1) / 2 products.

On that d x d matrix, ``eigen`` divides and conquers: the polar factor U of the matrix less a shift (dynamically weighted Halley
iterations, ``polar``) gives the spectral projector (U + I) / 2 of the eigenvalues above the shift; orthonormal bases of its range
and of the complement split the matrix into two smaller ones, until each holds one eigenvalue (or one that repeats). The
components and the sums, a few numbers a dimension, go to the tasks, which whiten each row.

Defined cases: rows whose vector is null or holds a null or a non-finite entry are dropped; the dimension is the most frequent
length (ties: the longest), and rows of other lengths are returned with null ``whitened`` and ``deviation`` and left out of the
fit; entries beyond 2**40 after scaling count as 2**40; a ``deviation`` that no long holds is null; repeated rows are returned each; components
without variance are left out, so that an empty table, or one of equal vectors, has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import cut, pieces

SCALE = 256
MOST = 2 ** 40
EPS = np.finfo(float).eps


# The eigenvectors of a symmetric matrix ---------------------------------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray | None:
    """The orthogonal polar factor of a symmetric matrix by QDWH; None if the matrix is singular to working precision."""
    scale = np.linalg.norm(a, 1)
    if scale == 0:
        return None
    x, eye = a / scale, np.eye(len(a))
    try:
        low = 0.9 / (np.linalg.norm(np.linalg.inv(x), 1) * len(a) ** 0.5)      # below the least singular value
    except np.linalg.LinAlgError:
        return None
    if not low > EPS / 8:
        return None
    for _ in range(30):
        r = np.cbrt(4 * (1 - low ** 2) / low ** 4) if low < 1 else 0.0
        wa = np.sqrt(1 + r) + 0.5 * np.sqrt(max(0.0, 8 - 4 * r + 8 * (2 - low ** 2) / (low ** 2 * np.sqrt(1 + r))))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:        # the inverse of I + c X'X would lose digits: by QR of the stacked matrix
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            y = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:len(a)] @ q[len(a):].T)
        else:
            y = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        y = (y + y.T) / 2
        moved, x, low = np.linalg.norm(y - x), y, min(1.0, low * (wa + wb * low ** 2) / (1 + wc * low ** 2))
        if moved <= np.cbrt(5 * EPS) and abs(1 - low) <= 10 * EPS or moved <= 4 * EPS * len(a):
            break
    return x


def split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below the shift; None if one is empty or the shift is an eigenvalue."""
    u = polar(a - shift * np.eye(len(a)))
    if u is None:
        return None
    projector = (u + np.eye(len(a))) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < len(a) or abs(np.trace(projector) - k) > 1e-8:
        return None
    start = np.random.default_rng(len(a)).standard_normal((len(a), k))
    for _ in range(2):      # the second pass starts from an orthonormal basis, so it loses no digits
        start = np.linalg.qr(projector @ start)[0]
    q = np.linalg.qr(start, mode="complete")[0]
    return q[:, :k], q[:, k:]


def subspaces(a: np.ndarray, floor: float) -> Iterator[np.ndarray]:
    """Orthonormal bases whose union diagonalises the symmetric matrix; ``floor`` is what counts as no difference."""
    n, mean = len(a), np.trace(a) / len(a)
    off = np.linalg.norm(a - np.diag(np.diag(a)))
    spread = np.linalg.norm(a - mean * np.eye(n)) / n ** 0.5
    if n == 1 or off <= floor and (off == 0 or spread <= floor):
        yield np.eye(n)
        return
    for shift in (float(np.median(np.diag(a))), mean, *(mean + s * spread for s in (0.03, -0.03, 0.11, -0.11, 0.37, -0.37, 0.73, -0.73))):
        found = split(a, shift)
        if found:
            break
    else:       # no shift tells the eigenvalues apart: they are equal to working precision
        yield np.eye(n)
        return
    for basis in found:
        inner = basis.T @ a @ basis
        for q in subspaces((inner + inner.T) / 2, floor):
            yield basis @ q


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    if not len(a):
        return np.empty(0), np.empty((0, 0))
    q = np.hstack(list(subspaces(a, 4 * EPS * np.linalg.norm(a))))
    values = np.einsum("ij,ij->j", q, a @ q)
    order = np.argsort(-values, kind="stable")
    return values[order], q[:, order]


# Sums over the fit list -------------------------------------------------------------------------------------------------

def entries(vector: Column) -> Column:
    """x of each entry; null for a null vector, and for one with a null or non-finite entry."""
    c = vector.cast("array<double>")
    good = F.forall(c, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    scaled = F.transform(c, lambda e: F.floor(F.least(F.greatest(e * SCALE, F.lit(float(-MOST))), F.lit(float(MOST)))))
    return F.when(good, scaled)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y'y of integers without rounding: in floating point where no sum leaves 53 bits, in Python's integers elsewhere."""
    if not len(y):
        return np.zeros((y.shape[1], y.shape[1]), object)
    if int(np.abs(y).max()) ** 2 * len(y) < 2 ** 53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def partial_sums(fit: DataFrame, dim: int, centre: list[int] | None = None) -> dict:
    """Exact sums over the fit list: without a centre of the entries, {i: sum} and {-1: number of rows}; else of the products of
    entries less the centre, {(i, j): sum} for i <= j, and of the entries themselves, {(-1, j): sum}."""
    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums, products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for b in pieces(batches, 4096):
            x = matrix(b.column(0), dim)
            rows += len(x)
            if centre is not None:
                x = x - np.array(centre, np.int64)
                products += exact_products(x)
            sums += x.astype(object).sum(axis=0) if len(x) and int(np.abs(x).max()) * len(x) >= 2 ** 62 else x.sum(axis=0).astype(object)
        if rows:
            out = [(-1, -1, rows), *((-1, j, int(sums[j])) for j in range(dim))]
            if centre is not None:
                out += [(i, j, int(products[i, j])) for i in range(dim) for j in range(i, dim)]
            i, j, v = zip(*out)
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(k) for k in v], pa.string())], names=["i", "j", "v"])

    parts = fit.select("x").mapInArrow(of_task, "i int, j int, v string")
    return {(r.i, r.j): int(r.v) for r in parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray      # eigenvalues of the components, falling
    vectors: np.ndarray     # unit eigenvectors, a column each
    trace: float


def fit_list(rows: DataFrame, dim: int) -> DataFrame:
    return cut(rows.where(F.size("x") == dim).groupBy("x").agg(F.lit(1).alias("one")).select("x"))


def fitted(fit: DataFrame, dim: int, components: int) -> Whitening:
    first = partial_sums(fit, dim)
    n, sums = first.get((-1, -1), 0), [first.get((-1, j), 0) for j in range(dim)]
    if not n:
        return Whitening(0, sums, np.empty(0), np.empty((dim, 0)), 0.0)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    second = partial_sums(fit, dim, centre)
    left = [second[-1, j] for j in range(dim)]
    v = np.empty((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            v[i, j] = v[j, i] = (n * second[i, j] - left[i] * left[j]) / (n * n)      # integers up to the division
    values, vectors = eigen(v)
    k = min(components, int((values > dim * EPS * values[0]).sum()) if len(values) and values[0] > 0 else 0)
    return Whitening(n, sums, values[:k], vectors[:, :k], float(np.trace(v)))


def applied(rows: DataFrame, dim: int, w: Whitening) -> DataFrame:
    """``rows`` with ``deviation`` and ``whitened`` (an entry for each component)."""
    n, sums, k = w.n, w.sums, len(w.values)
    weights = w.vectors / (n * np.sqrt(w.values)) if k else w.vectors
    most = max(map(abs, sums), default=0)

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 4096):
            x = b.column(b.num_columns - 1)
            fits = pc.equal(pc.list_value_length(x), dim).to_numpy(zero_copy_only=False)
            deviations, whitened = np.full(b.num_rows, None, object), np.full(b.num_rows, None, object)
            if fits.any():
                m = matrix(x.filter(pa.array(fits)), dim)
                large = max(1, (n * int(np.abs(m).max()) + most) ** 2 * dim) >= 2 ** 62 if dim else False
                m = n * (m.astype(object) if large else m) - np.array(sums, object if large else np.int64)
                square = (m * m).sum(axis=1)
                deviations[fits] = [int(s) if s < 2 ** 63 else None for s in square]
                for at, row in zip(np.flatnonzero(fits), m.astype(float) @ weights):
                    whitened[at] = row
            yield pa.record_batch([*b.columns, pa.array(deviations, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))],
                                  names=[*b.schema.names, "deviation", "whitened"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), "deviation long, whitened array<double>"])
    return rows.mapInArrow(of_task, schema)


def identity_error(fit: DataFrame, dim: int, w: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance less the identity, measured over its rows."""
    k = len(w.values)
    if not k:
        return 0.0
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = applied(fit, dim, w).agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(vectors: DataFrame, components: int = 4, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each row that is left and each component."""
    rows = vectors.select(F.col(row_id).alias("vec_id"), entries(F.col(vector)).alias("x")).where("x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = sizes["dim"] if sizes else 0
    fit = fit_list(rows, dim)
    w = fitted(fit, dim, components)
    error = identity_error(fit, dim, w)
    found = applied(rows, dim, w)
    of_components = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.col("whitened")[i].alias("whitened"), F.lit(float(w.values[i] / w.trace)).alias("explained"))
                              for i in range(len(w.values))]).cast("array<struct<component:int,whitened:double,explained:double>>")
    return (found.select("vec_id", F.explode(of_components).alias("c"), F.lit(w.n).cast("long").alias("n"), "deviation")
            .select("vec_id", "c.component", "n", "deviation", "c.whitened", "c.explained", F.lit(float(error)).alias("identity_error")))
