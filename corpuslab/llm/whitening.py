"""Whitening of embedding vectors by spectral divide and conquer.

1. Entries become integers (``floor(256 * c)``); the fit list holds every distinct vector once.
   Count and sums are exact integers, and the covariance is summed over rows that were centred before multiplying.
2. The covariance (width x width, nothing that grows with the rows) is split on the driver. The polar factor of
   ``V - shift * I`` has the eigenvalues 1 above the shift and -1 below it, so half of its sum with the identity is the
   projector on the upper invariant subspace. QDWH iterations find the factor with matrix products, QR and no inverse. Both
   subspaces are split in the same way until every part is a single component or a multiple of the identity; parts that
   hold none of the wanted components are left alone.
3. The components are broadcast (a few vectors of the width) and all rows are projected where they lie.

Edge cases: a row is dropped when its vector is null or empty or holds a null or non-finite entry, or when its width is
not the most frequent one (the smaller one of two); components without variance are not returned, so equal vectors alone
give an empty result, as does an empty table; entries that do not fit a long are cut to its range; a deviation that
does not fit a long is null; repeated rows are all returned and count once in the fit; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.session import written_table

SCALE = 256
EPS = np.finfo(np.float64).eps
BLOCK_ROWS = 1024  # rows of a batch worked on at once


# -- spectral divide and conquer ---------------------------------------------------------------------------------

def _least_singular(x: np.ndarray) -> float:
    """A lower bound of the smallest singular value: the reciprocal norm of the inverse triangular factor."""
    triangle = np.linalg.qr(x, "r")
    if np.abs(np.diag(triangle)).min() <= EPS / 8:
        return EPS / 8
    return float(max(1.0 / np.linalg.norm(np.linalg.inv(triangle)), EPS / 8))


def polar_factor(a: np.ndarray, most: int = 40) -> np.ndarray:
    """Orthogonal polar factor of a square non-singular matrix by dynamically weighted Halley steps in QR form."""
    n = len(a)
    x = a / np.linalg.norm(a)  # Frobenius norm bounds the largest singular value
    low = _least_singular(x)
    unit = np.eye(n)
    for _ in range(most):
        square = low * low
        inner = (4.0 * (1.0 - square) / (square * square)) ** (1.0 / 3.0)
        root = np.sqrt(1.0 + inner)
        p = root + 0.5 * np.sqrt(max(0.0, 8.0 - 4.0 * inner + 8.0 * (2.0 - square) / (square * root)))
        q = (p - 1.0) ** 2 / 4.0
        r = p + q - 1.0
        qr = np.linalg.qr(np.vstack([np.sqrt(r) * x, unit]))[0]
        moved = q / r * x + (p - q / r) / np.sqrt(r) * (qr[:n] @ qr[n:].T)
        low = min(1.0, low * (p + q * square) / (1.0 + r * square))
        step = np.linalg.norm(moved - x)
        x = moved
        if step <= n * EPS ** (1.0 / 3.0) and 1.0 - low <= 10 * EPS:
            break
    return x


def split_subspace(v: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the invariant subspaces of symmetric ``v`` above and below ``shift``."""
    n = len(v)
    projector = (polar_factor(v - shift * np.eye(n)) + np.eye(n)) / 2.0
    projector = (projector + projector.T) / 2.0
    k = int(round(float(np.trace(projector))))
    start = np.random.default_rng(n).standard_normal((n, n))
    seen = projector @ start[:, :k]
    basis = np.linalg.qr(np.hstack([seen, (np.eye(n) - projector) @ start[:, k:]]))[0]
    upper = np.linalg.qr(projector @ basis[:, :k])[0]  # a second product removes what rounding left
    lower = basis[:, k:] - upper @ (upper.T @ basis[:, k:])
    return upper, np.linalg.qr(lower)[0]


def _shifts(v: np.ndarray) -> list[float]:
    """Where to split: between the diagonal's middle entries, then elsewhere if that is an eigenvalue or outside."""
    d = np.sort(np.diag(v))
    low, high = d[0], d[-1]
    mean = float(d.mean())
    spread = np.sqrt(max(0.0, float((v * v).sum()) / len(v) - mean * mean))
    return [float(np.median(d)), mean, mean + spread / 3, mean - spread / 3, (low + high) / 2, mean + 2 * spread / 3, mean - 2 * spread / 3]


def top_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of symmetric ``v``, falling, and their unit vectors as columns."""
    v = (v + v.T) / 2.0
    size = float(np.linalg.norm(v))

    def solve(part: np.ndarray, wanted: int) -> np.ndarray:
        n = len(part)
        middle = float(np.trace(part)) / n
        if n == 1 or np.linalg.norm(part - middle * np.eye(n)) <= 4 * n * EPS * size:
            return np.eye(n)[:, :wanted]
        for shift in _shifts(part):
            upper, lower = split_subspace(part, shift)
            leak = np.linalg.norm(upper.T @ part @ lower) if 0 < upper.shape[1] < n else np.inf
            if leak <= 64 * n * EPS * size:
                break
        else:
            raise ArithmeticError("no shift separates the eigenvalues")
        first = upper.T @ part @ upper
        found = upper @ solve((first + first.T) / 2.0, min(wanted, len(first)))
        if wanted > len(first):
            second = lower.T @ part @ lower
            found = np.hstack([found, lower @ solve((second + second.T) / 2.0, wanted - len(first))])
        return found

    vectors = np.linalg.qr(solve(v, min(wanted, len(v))))[0]
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# -- Spark side --------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``n`` distinct vectors with ``sums``, falling ``values`` with ``vectors`` as columns, ``trace``."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    @property
    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def integer_vectors(vectors: DataFrame, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id, x``: usable rows with integer entries, all of the most frequent width."""
    usable = vectors.select(F.col(key).alias("vec_id"), F.col(vec).cast("array<double>").alias("_v"))
    usable = usable.filter(F.col("_v").isNotNull() & (F.size("_v") > 0)).filter(~_odd("_v"))
    limit = float(2**63 - 1024)
    whole = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-limit)), F.lit(limit))).cast("long")
    rows = usable.select("vec_id", F.transform("_v", whole).alias("x"))
    widths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    best = widths.orderBy(F.col("n").desc(), "width").first()
    return rows.filter(F.size("x") == (best.width if best else 0))


def _odd(name: str):
    return F.exists(name, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks(batches, at: int = 0):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            yield part, matrix_of(part.column(at))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Every distinct ``x`` once, pre-aggregated per task."""
    return rows.select("x").distinct()


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and per-dimension sums as exact integers."""

    def add(batches):
        n, total = 0, None
        for _, x in blocks(batches):
            part = x.astype(object).sum(0) if np.abs(x.astype(np.float64)).max() > 2**50 else x.sum(0)
            total = [int(a) + int(b) for a, b in zip(part, total or [0] * x.shape[1])]
            n += len(x)
        if n:
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                                   pa.array([str(t) for t in total])], names=["at", "n", "total"])

    parts = fit.mapInArrow(add, "at int, n long, total string")
    found = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    found.sort(key=lambda r: r.at)
    return (found[0].n, [int(r.total) for r in found]) if found else (0, [])


def product_sums(fit: DataFrame, means: np.ndarray, matrix: np.ndarray | None = None) -> np.ndarray:
    """Sum over rows of the outer product of ``(x - means) @ matrix``, by row of the result."""
    schema = "at int, total array<double>"
    width = len(means) if matrix is None else matrix.shape[1]

    def add(batches):
        total = np.zeros((width, width))
        for _, x in blocks(batches):
            c = x - means
            if matrix is not None:
                c = c @ matrix
            total += c.T @ c
        yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                              names=["at", "total"])

    rows = fit.mapInArrow(add, schema).select("at", F.posexplode("total").alias("to", "v"))
    out = np.zeros((width, width))
    for r in rows.groupBy("at", "to").agg(F.sum("v").alias("v")).toArrow().to_batches():
        out[r.column(0).to_numpy(), r.column(1).to_numpy()] = r.column(2).to_numpy()
    return out


def projected_means(fit: DataFrame, means: np.ndarray, matrix: np.ndarray, n: int) -> np.ndarray:
    def add(batches):
        total = np.zeros(matrix.shape[1])
        for _, x in blocks(batches):
            total += ((x - means) @ matrix).sum(0)
        yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["at", "v"])

    found = fit.mapInArrow(add, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    return np.array([r.v for r in sorted(found, key=lambda r: r.at)]) / n


def fit_whitening(fit: DataFrame, components: int) -> Whitening | None:
    """Model of the distinct vectors ``fit``; None without rows."""
    n, sums = exact_sums(fit)
    if not n:
        return None
    means = np.array([s / n for s in sums])
    covariance = product_sums(fit, means) / n
    values, vectors = top_components(covariance, components)
    trace = float(np.trace(covariance))
    real = values > len(sums) * EPS * trace
    return Whitening(n, sums, values[real], vectors[:, real], trace)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on the rows."""
    shift = projected_means(fit, model.means, model.matrix, model.n)
    found = product_sums(fit, model.means, model.matrix) / model.n - np.outer(shift, shift)
    return float(np.abs(found - np.eye(len(found))).max())


def apply_whitening(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """One row per vector and component, computed where the vector lies."""
    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def project(batches):
        m = shared.value
        k, width = len(m.values), len(m.sums)
        means, matrix, sums = m.means, m.matrix, np.array(m.sums, dtype=object)
        biggest = max(abs(s) for s in m.sums)
        for part, x in blocks(batches, 1):
            bound = m.n * float(np.abs(x.astype(np.float64)).max()) + biggest
            if bound < 2.0**62 and bound * bound * width < 2.0**62:
                deviation = ((m.n * x - sums.astype(np.int64)) ** 2).sum(1).tolist()
            else:
                deviation = ((m.n * x.astype(object) - sums) ** 2).sum(1).tolist()
                deviation = [d if d < 2**63 else None for d in deviation]
            white = (x - means) @ matrix
            r = len(x)
            yield pa.record_batch([
                part.column(0).take(pa.array(np.repeat(np.arange(r), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                pa.array(np.full(r * k, m.n)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(r), k))),
                pa.array(white.ravel()), pa.array(np.tile(m.values / m.trace, r)), pa.array(np.full(r * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(project, schema)


def whiten(vectors: DataFrame, components: int = 4, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of all usable rows."""
    rows = integer_vectors(vectors, vec, key)
    fit = written_table(distinct_vectors(rows), "whitening-fit")
    model = fit_whitening(fit, components)
    if model is None or not len(model.values):
        empty = Whitening(1, [0], np.zeros(0), np.zeros((1, 0)), 1.0)
        return apply_whitening(rows.limit(0), empty, 0.0)
    return apply_whitening(rows, model, identity_error(fit, model))
