"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Each entry c of a usable vector becomes the integer x = floor(64 c) + 1000000.  The fit list has
each distinct x-vector once.  Its scatter is gathered by Spark in two passes over the written
list: the sums S, then the products of the entries less the rounded mean.  Both are integer
sums (decimals in Spark, exact), so the centred scatter is exact whatever the partitions, and is
rounded once.  Only its d x d numbers reach the driver.

There, ``pivoted_cholesky`` factors the scatter (the largest remaining diagonal first, until what remains
is rounding), and ``jacobi_columns`` rotates the columns of the triangular factor itself until all are orthogonal:
L J = U diag(s), so scatter = L L' = U diag(s^2) U'.  Squared column norms over n are the eigenvalues, the normalised columns
the components; no d x d product is formed again, which keeps small eigenvalues accurate.

Defined results: rows whose vector is null or holds null or non-finite entries are left out; a vector
shorter than the longest counts as having zeros at its end, also an empty one; entries so large that x would leave
+-2^46 count as that bound; null ids, repeated rows, ids and vectors are all returned row by row (a vector counts once in
the fit); components with eigenvalue zero are not returned, so with fewer than two distinct vectors, or on an empty
table, the result is empty; ``deviation`` is null where 38 digits do not hold it (the query: 64 bits).  Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardscan.llm.common import python_tasks, table, written

SCALE = 64
SHIFT = 1_000_000
LIMIT = 2.0 ** 46
N_COMPONENTS = 16
#: int64 sums of products stay exact below this.
EXACT = 2 ** 62


def usable(vec: Column) -> Column:
    good = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vec.isNotNull() & good


def integers(vec: Column) -> Column:
    """x of every entry (array<bigint>)."""
    def one(c: Column) -> Column:
        scaled = F.floor(F.greatest(F.least(c * F.lit(float(SCALE)), F.lit(LIMIT)), F.lit(-LIMIT)))
        return scaled.cast("bigint") + F.lit(SHIFT).cast("bigint")

    return F.transform(vec.cast("array<double>"), one)


def padded(arr: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) integers of an Arrow list column; missing entries at the end are those of zero."""
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(arr.offsets.to_numpy())
    if (size == dim).all():
        return flat.reshape(len(arr), dim)
    out = np.full((len(arr), dim), SHIFT, np.int64)
    out[np.arange(dim) < size[:, None]] = flat
    return out


def _products(y: np.ndarray) -> np.ndarray:
    """Exact Y'Y of integers, as Python integers where 64 bits could overflow."""
    top = int(np.abs(y).max(initial=0))
    if top * top * max(1, len(y)) < EXACT:
        if top * top * max(1, len(y)) < 2 ** 53:  # exact in doubles too, where the product is fastest
            f = y.astype(float)
            return (f.T @ f).astype(np.int64)
        return y.T @ y
    o = y.astype(object)
    return o.T @ o


def _gather(fit: DataFrame, cells, n_cells: int) -> list[int]:
    """Sums over the fit list of ``cells(batch) -> flat integers``: added up in each task, then by Spark in decimals."""
    from decimal import Decimal

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                got = cells(b.column("x")).astype(object)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n_cells), pa.int32()),
                 pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))], names=["cell", "v"])

    rows = fit.mapInArrow(partial, "cell int, v decimal(38,0)").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = [0] * n_cells
    for r in rows:
        out[r["cell"]] = int(r["v"])
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: ``n`` and the sums ``total`` are exact, ``components`` has one unit column per eigenvalue."""

    n: int
    dim: int
    total: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The rounded mean."""
        return np.array([_rounded(s, self.n) for s in self.total], np.int64)

    @property
    def rest(self) -> list[int]:
        """Sums of the entries less the rounded mean (at most n / 2 each)."""
        return [s - self.n * int(m) for s, m in zip(self.total, self.centre)]

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows of entries less the rounded mean."""
        centred = y - np.array([r / self.n for r in self.rest])
        return (centred @ self.components) / np.sqrt(self.values)


def _rounded(s: int, n: int) -> int:
    return (2 * s + n) // (2 * n)


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(l, order)`` with ``a[order][:, order] = l l'``: l is lower triangular (d x rank), its pivots fall."""
    a = a.astype(float).copy()
    d = len(a)
    order = np.arange(d)
    l = np.zeros((d, d))
    diag = a.diagonal().copy()
    least = d * np.finfo(float).eps * diag.max(initial=0.0)
    rank = 0
    for k in range(d):
        p = k + int(np.argmax(diag[k:]))
        if diag[p] <= least:
            break
        if p != k:
            order[[k, p]], diag[[k, p]] = order[[p, k]], diag[[p, k]]
            l[[k, p], :k] = l[[p, k], :k]
        pivot = np.sqrt(diag[k])
        l[k, k] = pivot
        below = a[order[k + 1:], order[k]] - l[k + 1:, :k] @ l[k, :k]
        l[k + 1:, k] = below / pivot
        diag[k + 1:] -= l[k + 1:, k] ** 2
        rank += 1
    return l[:, :rank], order


def jacobi_columns(l: np.ndarray, tolerance: float = 1e-15, max_sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """One-sided Jacobi: rotate pairs of columns of ``l`` until all are orthogonal; ``(unit columns, norms)``, norms falling.

    A sweep is a round robin: in each of its rounds the columns are paired off, and all pairs,
    being disjoint, are rotated at once."""
    u = l.copy()
    r = u.shape[1]
    seats = list(range(r)) + ([-1] if r % 2 else [])
    for _ in range(max_sweeps):
        worst = 0.0
        for _ in range(max(1, len(seats) - 1)):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], seats[:half - 1:-1]) if a >= 0 and b >= 0]
            seats = [seats[0], seats[-1], *seats[1:-1]] if len(seats) > 1 else seats
            if not pairs:
                continue
            i, j = (np.array(x) for x in zip(*pairs))
            a, b = u[:, i], u[:, j]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.sqrt(alpha * beta)
            cosine = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, float(cosine.max()))
            turn = cosine > tolerance
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            sign = np.where(zeta >= 0, 1.0, -1.0)
            tan = np.where(turn, sign / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cos = 1 / np.hypot(1.0, tan)
            sin = cos * tan
            u[:, i], u[:, j] = cos * a - sin * b, sin * a + cos * b
        if worst <= tolerance * 8:
            break
    norms = np.sqrt((u * u).sum(0))
    by = np.argsort(-norms, kind="stable")
    by = by[norms[by] > 0]
    return u[:, by] / norms[by], norms[by]


def fit_whitening(fit: DataFrame, n_components: int = N_COMPONENTS) -> Whitening | None:
    """The transform of a written table of distinct vectors ``x``; None where no direction varies."""
    first = fit.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dim")).first()
    n, dim = first["n"], first["dim"] or 0
    if n < 2 or not dim:
        return None
    total = _gather(fit, lambda x: padded(x, dim).astype(object).sum(axis=0) if len(x) * 2 ** 47 > EXACT
                    else padded(x, dim).sum(axis=0), dim)
    centre = np.array([_rounded(s, n) for s in total], np.int64)
    upper = np.triu_indices(dim)
    got = _gather(fit, lambda x: _products(padded(x, dim) - centre)[upper], len(upper[0]))
    rest = [s - n * int(m) for s, m in zip(total, centre)]
    # n * sum(y y') - sum(y) sum(y)' in integers, rounded once: n times the centred scatter
    scatter = np.zeros((dim, dim))
    exact_trace = 0
    for i, j, v in zip(upper[0].tolist(), upper[1].tolist(), got):
        cell = n * v - rest[i] * rest[j]
        scatter[i, j] = scatter[j, i] = cell / n
        exact_trace += cell if i == j else 0
    l, order = pivoted_cholesky(scatter)
    if not l.shape[1]:
        return None
    columns, norms = jacobi_columns(l)
    components = np.empty_like(columns)
    components[order] = columns
    k = min(n_components, len(norms))
    return Whitening(n, dim, tuple(total), (norms[:k] ** 2) / n, components[:, :k], exact_trace / n / n)


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity, from the rows themselves."""
    k, dim, centre = len(w.values), w.dim, w.centre

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for b in batches:
            z = w.project(padded(b.column("x"), dim) - centre)
            total += np.c_[z.T @ z, z.sum(axis=0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())],
                                         names=["cell", "v"])

    rows = fit.mapInArrow(partial, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros(k * (k + 1))
    for r in rows:
        sums[r["cell"]] = r["v"]
    sums = sums.reshape(k, k + 1)
    mean = sums[:, k] / w.n  # zero but for rounding: the rows are centred already
    return float(np.abs(sums[:, :k] / w.n - np.outer(mean, mean) - np.eye(k)).max())


def deviations(y: np.ndarray, w: Whitening) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exact: n^2 sum(y^2) - 2 n sum(y r) + sum(r^2)."""
    rest = np.array(w.rest, object)
    top, reach = int(np.abs(y).max(initial=0)), max((abs(r) for r in w.rest), default=0)
    if max(top * top, top * reach) * max(1, w.dim) < EXACT:
        square, cross = (y * y).sum(axis=1).tolist(), (y @ rest.astype(np.int64)).tolist()
    else:
        o = y.astype(object)
        square, cross = (o * o).sum(axis=1).tolist(), (o @ rest).tolist()
    last = sum(r * r for r in w.rest)
    return [w.n * (w.n * a - 2 * b) + last for a, b in zip(square, cross)]


def whiten(vectors: DataFrame, n_components: int = N_COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row per usable row and component."""
    from decimal import Decimal

    spark = vectors.sparkSession
    python_tasks(spark)
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), vec.alias("vec")).where(usable(F.col("vec"))).select(
        "vec_id", integers(F.col("vec")).alias("x"))
    # trailing entries of zero change nothing, so vectors that differ in them alone are one
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    fill = F.array_repeat(F.lit(SHIFT).cast("bigint"), F.lit(dim) - F.size("x"))
    rows = rows.withColumn("x", F.when(F.size("x") < dim, F.concat("x", fill)).otherwise(F.col("x")))
    fit = written(rows.select("x").distinct(), "whitening-fit")
    w = fit_whitening(fit, n_components)
    out = "vec_id {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    kind = vectors.schema[id_col].dataType.simpleString()
    if w is None:
        return spark.createDataFrame([], out.format(kind))
    error, centre = identity_error(fit, w), w.centre
    explained = w.values / w.trace
    limit = 10 ** 38

    @F.arrow_udf("struct<deviation:decimal(38,0),whitened:array<double>>")
    def transform(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            y = padded(arr, w.dim) - centre
            far = pa.array([Decimal(v) if v < limit else None for v in deviations(y, w)], pa.decimal128(38, 0))
            z = w.project(y)
            flat = pa.ListArray.from_arrays(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32), pa.array(z.ravel()))
            yield pa.StructArray.from_arrays([far, flat], names=["deviation", "whitened"])

    done = rows.select("vec_id", transform("x").alias("t"))
    each = done.select("vec_id", F.col("t.deviation").alias("deviation"),
                       F.posexplode("t.whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation",
        "whitened", F.array(*[F.lit(float(e)) for e in explained])[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"))


def op12_pivoted_cholesky_whitening(spark, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
