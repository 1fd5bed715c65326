"""Embedding whitening: leading eigenpairs of the covariance by contour integration, checked by inertia."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmart.llm.common import map_arrow, ship, stored

#: Entries become floor(SCALE * c).
SCALE = 256
#: Nodes on the half circle; the other half gives the conjugates.
NODES = 8
#: Rounds of one interval; each shrinks the error by the filter's ratio, far below 1e-3.
ROUNDS = 60
#: Eigenvalues of one interval at most, unless they cannot be told apart.
SLICE = 8


# --- eigenpairs of a symmetric matrix on intervals ---------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of a tridiagonal matrix similar to ``a``, by Householder reflections."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        size = np.linalg.norm(x)
        if size == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        v /= np.linalg.norm(v)
        b = a[k + 1 :, k + 1 :]
        p = b @ v
        w = p - (v @ p) * v
        b -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = 0
        a[k + 1, k] = -np.copysign(size, x[0])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(diagonal: np.ndarray, side: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: the inertia of the shifted matrix, from its pivots (Sylvester)."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, pivot = 0, 1.0
    for k, d in enumerate(diagonal.tolist()):
        pivot = d - shift - (side[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def kth_largest(count: Callable[[float], int], k: int, low: float, high: float, width: float) -> tuple[float, float]:
    """An interval of at most ``width`` that holds the k-th largest eigenvalue, by halving on counts."""
    while high - low > width:
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if count(middle) >= k else (low, middle)
    return low, high


def intervals(count: Callable[[float], int], dim: int, top: int, low: float, high: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), from the largest down, that hold the ``top`` largest at least.

    Borders lie in the widest gap among the next few eigenvalues: an interval ends early rather than cut a cluster.
    """
    out, done, border = [], 0, high
    span = high - low
    while done < top:
        size = SLICE
        while True:
            last = min(dim, done + size)
            least = min(top, last)
            # Eigenvalues least .. last + 1, each known to a small part of the span.
            near = [kth_largest(count, k, low, border, span * 1e-9) for k in range(least, min(last + 1, dim) + 1)]
            gaps = [near[i][0] - near[i + 1][1] for i in range(len(near) - 1)]
            if last == dim:
                gaps.append(near[-1][0] - low)
            at = int(np.argmax(gaps))
            if last == dim or gaps[at] > span * 1e-7:
                break
            size *= 2
        inside = least + at
        edge = low if inside == dim else (near[at][0] + near[at + 1][1]) / 2
        out.append((edge, border, inside - done))
        done, border = inside, edge
    return out


def contour_pairs(a: np.ndarray, low: float, high: float, inside: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """All ``inside`` eigenpairs with values in (low, high), largest first.

    Gauss quadrature of (zI - A)^-1 Y on a circle around the interval projects Y onto the eigenvectors
    inside; Rayleigh-Ritz on that subspace gives the pairs, and the projection is repeated on them until the residuals
    are at rounding level. Raises if the pairs found are not as many as the inertia says.
    """
    dim = len(a)
    size = min(dim, inside + inside // 2 + 4)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 + nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * angles)
    solvers = [np.linalg.inv((centre + radius * t) * np.eye(dim) - a) for t in turns]
    y = np.random.default_rng([seed, dim]).standard_normal((dim, size))
    scale = np.abs(a).sum(axis=1).max()
    best = np.inf
    for _ in range(ROUNDS):
        q = sum((w / 2 * radius * t * s).real @ y for t, w, s in zip(turns, weights, solvers, strict=True))
        q, _ = np.linalg.qr(q)
        values, ritz = np.linalg.eigh(q.T @ a @ q)
        x = q @ ritz
        off = np.linalg.norm(a @ x - x * values, axis=0)
        found = np.flatnonzero((values > low) & (values < high) & (off <= 1e-9 * scale))
        worst = off[found].max(initial=0.0)
        if len(found) == inside and (worst <= 4 * np.finfo(float).eps * scale or worst >= best / 2):
            # At rounding level, or no longer falling.
            order = found[np.argsort(-values[found], kind="stable")]
            return values[order], x[:, order]
        best = worst if len(found) == inside else np.inf
        y = x
    raise ArithmeticError(f"{len(found)} of {inside} eigenvalues between {low} and {high}")


def leading_pairs(a: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest eigenvalues that are above rounding level, and their unit eigenvectors as columns."""
    dim = len(a)
    scale = np.abs(a).sum(axis=1).max(initial=0.0)
    if scale == 0:
        return np.zeros(0), np.zeros((dim, 0))
    a = a / scale
    diagonal, side = tridiagonal(a)
    pad = 64 * dim * np.finfo(float).eps

    def count(shift: float) -> int:
        return above(diagonal, side, shift)

    rank = count(pad)
    top = min(top, rank)
    values, vectors = [], []
    for low, high, inside in intervals(count, rank, top, pad, 1 + pad):
        e, x = contour_pairs(a, low, high, inside)
        values.append(e)
        vectors.append(x)
    if not values:
        return np.zeros(0), np.zeros((dim, 0))
    return np.concatenate(values)[:top] * scale, np.concatenate(vectors, axis=1)[:, :top]


# --- on Spark ------------------------------------------------------------------


def scaled(column: str = "embedding"):
    """floor(256 * c) of each entry as long; null where the vector is null, empty, or holds a null or non-finite entry."""
    usable = F.coalesce(F.forall(column, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))) & (F.size(column) > 0), F.lit(False))
    return F.when(usable, F.transform(column, lambda c: F.floor(c.cast("double") * SCALE)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def _by_length(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.asarray(batch.column(at).value_lengths())
    for dim in np.unique(lengths).tolist():
        yield dim, batch.filter(pa.array(lengths == dim))


def sums(fit: DataFrame) -> DataFrame:
    """(dim, n, s): number of distinct vectors of each length and their sums, as longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for dim, part in _by_length(batch, 0):
                x = _matrix(part.column(0), dim)
                known = total.setdefault(dim, [0, np.zeros(dim, dtype=np.int64)])
                known[0] += len(x)
                known[1] += x.sum(axis=0)
        rows = [(dim, k, n, int(v)) for dim, (n, s) in total.items() for k, v in enumerate(s.tolist())]
        names = ["dim", "k", "n", "s"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names)

    parts = map_arrow(fit, run, "dim int, k int, n long, s long").groupBy("dim", "k").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("k", "s"))), lambda e: e["s"])
    return parts.groupBy("dim").agg(F.max("n").alias("n"), ordered.alias("s"))


def covariances(fit: DataFrame, totals: DataFrame) -> DataFrame:
    """(dim, i, j, v): entries of the covariance, divisor n, of vectors that were centred before multiplying."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in _by_length(batch, 0):
                # n and s are the same in all rows of a length.
                n, s = part.column(1)[0].as_py(), np.array(part.column(2)[0].as_py())
                x = _matrix(part.column(0), dim) - s / n
                products[dim] = products.get(dim, 0.0) + x.T @ x / n
        for dim, v in products.items():
            for i in range(dim):
                columns = [pa.array(np.full(dim, c, dtype=np.int32)) for c in (dim, i)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(dim, dtype=np.int32)), pa.array(v[i])], ["dim", "i", "j", "v"])

    # One row per length: far below any vector, so it is broadcast by its measured size.
    rows = fit.join(totals, F.size("x") == F.col("dim")).select("x", "n", "s")
    return map_arrow(rows, run, "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v"))


def fitted(fit: DataFrame, top: int) -> DataFrame:
    """(dim, n, s, mean, component, e, explained, axis): one row per length and component.

    One task solves one length; it holds the dim x dim covariance and never a vector.
    """
    ship(fit.sparkSession)
    totals = stored(sums(fit), "whitening_sums")

    def solve(entries: pd.DataFrame) -> pd.DataFrame:
        dim = int(entries["dim"].iat[0])
        v = np.zeros((dim, dim))
        v[entries["i"], entries["j"]] = entries["v"]
        v = (v + v.T) / 2
        e, axes = leading_pairs(v, top)
        return pd.DataFrame({"dim": dim, "component": np.arange(1, len(e) + 1), "e": e, "explained": e / np.trace(v) if len(e) else e, "axis": pd.Series(list(axes.T), dtype=object)})

    schema = "dim int, component int, e double, explained double, axis array<double>"
    pairs = covariances(fit, totals).groupBy("dim").applyInPandas(solve, schema)
    mean = F.transform("s", lambda v: v / F.col("n"))
    return stored(totals.withColumn("mean", mean).join(pairs, "dim"), "whitening_fit")


def projected(rows: DataFrame, model: DataFrame) -> DataFrame:
    """``rows`` with x, one row per component: the columns of ``model`` and ``whitened``."""
    out = rows.join(model, F.size("x") == F.col("dim"))
    terms = F.zip_with(F.zip_with("x", "mean", lambda x, m: x - m), "axis", lambda x, a: x * a)
    return out.withColumn("whitened", F.aggregate(terms, F.lit(0.0), lambda t, v: t + v) / F.sqrt("e"))


def identity_errors(fit: DataFrame, model: DataFrame) -> DataFrame:
    """(dim, identity_error): largest absolute entry of the whitened vectors' covariance minus the identity."""
    names = ["dim", "component", "mean", "axis", "e"]
    held = model.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct(*names[1:]))).alias("held"))

    def value(c):
        terms = F.zip_with(F.zip_with("x", c["mean"], lambda x, m: x - m), c["axis"], lambda x, a: x * a)
        return F.aggregate(terms, F.lit(0.0), lambda t, v: t + v) / F.sqrt(c["e"])

    rows = fit.join(held, F.size("x") == F.col("dim")).select("dim", F.transform("held", value).alias("w"))
    most = model.agg(F.max("component").alias("c")).first()["c"] or 0
    pairs = [(i, j) for i in range(most) for j in range(i, most)]
    # covar_pop centres as it goes; entries beyond the components of a length are null and do not count.
    entries = [F.abs(F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))) - float(i == j)) for i, j in pairs]
    largest = F.array_max(F.array(*entries)) if entries else F.lit(None).cast("double")
    return rows.groupBy("dim").agg(largest.alias("identity_error"))


def whiten(vectors: DataFrame, top: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of (vec_id, embedding); others are not read.

    Entries c become x = floor(256 c). The fit is over the distinct x-vectors: n of them, sums S, covariance V with
    divisor n. Components 1 to ``top`` are V's unit eigenvectors by falling eigenvalue e; whitened is x - S/n
    projected on one, over sqrt(e); deviation is the sum over dimensions of (n x - S)^2, null where that passes
    a long; explained is e / trace(V).

    Vectors that are null, empty, or hold a null or non-finite entry give no rows. Repeated vectors count once in
    the fit and each give their rows; a null vec_id is kept. Vectors of another length are another space: they have a
    fit of their own, n included. Components without variance (e at rounding level) are left out, so a
    fit of one distinct vector gives no rows. Entries reach to 2**40 after scaling; beyond, sums may pass a long.
    """
    rows = vectors.select("vec_id", scaled().alias("x")).where(F.col("x").isNotNull())
    fit = stored(rows.select("x").distinct(), "whitening_vectors")
    model = fitted(fit, top)
    errors = stored(identity_errors(fit, model), "whitening_errors")
    out = projected(rows, model.join(errors, "dim"))
    off = F.zip_with("x", "s", lambda x, s: F.try_subtract(F.try_multiply(x, F.col("n")), s))
    deviation = F.aggregate(off, F.lit(0).cast("bigint"), lambda t, d: F.try_add(t, F.try_multiply(d, d)))
    return out.select("vec_id", "component", "n", deviation.alias("deviation"), "whitened", "explained", "identity_error")


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), top=4)
