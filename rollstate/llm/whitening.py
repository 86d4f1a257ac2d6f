"""Whitening of embeddings by principal components, found by FEAST contour integration (operator 13).

Spark reduces the vectors to their covariance matrix, whose size depends on the dimensions alone.
Its largest eigenvalues are then taken from an interval of the spectrum: quadrature along a circle
around the interval of ``(z - V)^-1 Y`` projects a random block onto the interval's eigenvectors, a
Rayleigh-Ritz step extracts them, and both repeat until the residuals are at rounding level.  The
number of eigenvalues in an interval is known beforehand from the inertia of the shifted matrices at
its ends (Sylvester), which places the interval and proves that no component is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollstate.session import scratch_dir

from .common import bound_batches

# An entry becomes floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Scaled entries beyond this size count as this size, so that sums stay exact.
LARGEST = 1 << 40
#: Points of the quadrature on the half circle, eigenvalues of one interval, its span, rounds at most.
NODES, PER_INTERVAL, SPAN, ROUNDS = 8, 32, 8.0, 60
EPS = float(np.finfo(float).eps)


class MissedEigenvalues(RuntimeError):
    """An interval gave another number of eigenpairs than the inertia says."""


# ------------------------------------------------------------------------------- eigenvalue intervals


class Inertia:
    """Counts eigenvalues of a symmetric matrix on one side of a shift.

    Reflections bring the matrix to three diagonals once; the pivots of the elimination of the shifted
    matrix then have the signs of its eigenvalues (Sylvester's law of inertia).
    """

    def __init__(self, v: np.ndarray):
        m = np.array(v, float)
        for c in range(len(m) - 2):
            u = m[c + 1 :, c].copy()
            u[0] += np.copysign(np.linalg.norm(u), u[0])
            norm = float(u @ u)
            if norm:
                rest = m[c + 1 :]
                rest -= np.outer(u, u @ rest) * (2 / norm)
                m[:, c + 1 :] -= np.outer(m[:, c + 1 :] @ u, u) * (2 / norm)
        self.size, self.diagonal = len(m), np.diagonal(m).tolist()
        self.squares = [0.0, *(np.diagonal(m, -1) ** 2).tolist()]
        self.tiny = float(np.abs(m).max(initial=0)) * EPS**2 or 1.0

    def above(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for a, b in zip(self.diagonal, self.squares):
            pivot = a - shift - b / pivot
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            count += pivot > 0
        return count


def _end(v: Inertia, low: float, high: float, wanted: int, near: float) -> tuple[float, float]:
    """Points on both sides of the largest eigenvalue with at most ``wanted`` others above it, no
    farther apart than ``near`` times the upper one: ``low`` has more than ``wanted`` above it."""
    while high - low > near * abs(high):
        middle = (low + high) / 2
        if not low < middle < high:
            break
        if v.above(middle) > wanted:
            low = middle
        else:
            high = middle
    return low, high


def intervals(v: Inertia, top: float, k: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, number of eigenvalues) that hold the ``k`` largest eigenvalues, all
    positive, the highest first; none is larger than ``top``.

    An interval spans at most a factor of about ``SPAN``, because the circle around it cannot tell
    apart eigenvalues that lie much nearer to each other than its radius.  Ends lie in the middle of a
    gap as far as eigenvalues can be told apart.
    """
    out, done, high, floor = [], 0, top, -top
    while done < k:
        _, high = _end(v, floor, high, done, 1e-3)  # just above the largest one left
        m = min(k, done + PER_INTERVAL, max(v.above(high / SPAN), done + 1))
        _, upper = _end(v, floor, high, m - 1, 1e-12)  # just above the m-th eigenvalue
        if m >= v.size:
            low = upper - (high - upper) / 2 - abs(upper) / 8
        else:
            lower, _ = _end(v, floor, upper, m, 1e-12)  # just below the next one
            low = (lower + upper) / 2
            if v.above(low) != m:  # the next one equals the m-th
                low = lower - 1e-12 * abs(lower)
        out.append((low, high, v.above(low) - done))
        done, high = v.above(low), low
    return out


def contour(v: np.ndarray, low: float, high: float, count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, falling, and their unit eigenvectors."""
    d = len(v)
    size = min(d, max(count + 8, 3 * count // 2))
    y = np.random.default_rng(seed).standard_normal((d, size))
    x, w = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 - x)
    centre, radius = (low + high) / 2, (high - low) / 2
    scale = max(float(np.abs(v).max()), np.finfo(float).tiny)
    best = None
    for _ in range(ROUNDS):
        q = np.zeros_like(y)
        for angle, weight in zip(angles, w):
            turn = radius * np.exp(1j * angle)
            q += weight / 2 * np.real(turn * np.linalg.solve((centre + turn) * np.eye(d) - v, y.astype(complex)))
        left, strength, _ = np.linalg.svd(q, full_matrices=False)
        basis = left[:, strength > strength[0] * EPS] if strength[0] else left
        small = basis.T @ v @ basis
        values, ritz = np.linalg.eigh((small + small.T) / 2)
        vectors = basis @ ritz
        inside = np.flatnonzero((values > low) & (values < high))[::-1]
        if len(inside) == count:
            found, part = values[inside], vectors[:, inside]
            off = float(np.abs(v @ part - part * found).max())
            if best is not None and off >= best[0] / 2:  # no longer getting better
                if best[0] <= 1e3 * EPS * scale * d:
                    return best[1], best[2]
            if best is None or off < best[0]:
                best = (off, found, part / np.linalg.norm(part, axis=0))
        y = vectors if vectors.shape[1] == size else np.hstack([vectors, y[:, vectors.shape[1] :]])
    if best is not None and best[0] <= 1e-10 * scale * d:
        return best[1], best[2]
    raise MissedEigenvalues(f"{count} eigenvalues between {low} and {high}")


def largest(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest positive eigenvalues (fewer if the matrix has fewer), falling, and their
    unit eigenvectors as columns.  Eigenvalues at rounding level of the largest count as zero."""
    top = float(np.abs(v).sum(axis=1).max()) if len(v) else 0.0
    if not top:
        return np.zeros(0), np.zeros((len(v), 0))
    unit = v / top  # eigenvalues within -1 and 1, whatever the scale of the vectors
    inertia = Inertia(unit)
    k = min(k, inertia.above(4 * len(v) * EPS))
    parts = [contour(unit, *interval) for interval in intervals(inertia, 1 + 1e-9, k)]
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    vectors = np.hstack([p[1] for p in parts])[:, :k]
    # One Rayleigh-Ritz step over all intervals makes the vectors orthogonal to the last digit.
    basis, _ = np.linalg.qr(vectors)
    small = basis.T @ v @ basis
    values, ritz = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], (basis @ ritz)[:, ::-1]


# --------------------------------------------------------------------------------------------- Spark


@dataclass
class Whitener:
    """What a fit found: ``n`` vectors with sums per dimension, and the whitening of their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None


def _rows(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: 64-bit where the numbers allow it, Python's whole numbers elsewhere."""
    base = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    near = x - base
    if (float(np.abs(near).max(initial=0)) + 1) * n < 2.0**62:
        return near * np.int64(n) - np.array(rest, np.int64)
    return near.astype(object) * n - np.array(rest, object)


def _centred(x: np.ndarray, w: Whitener) -> np.ndarray:
    return (_deviations(x, w.n, w.sums) / w.n).astype(float)


def _summed(df: DataFrame, make, width: int) -> np.ndarray:
    """Sums over all rows of the matrices that ``make`` gives for a batch; the tasks' sums are added by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            part = make(b.column("x"))
            total = part if total is None else total + part
        if total is not None:
            for i, row in enumerate(np.atleast_2d(total)):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row])], names=["i", "row"])

    kind = "long" if width < 0 else "double"
    each = df.mapInArrow(partial, f"i int, row array<{kind}>").select("i", F.posexplode("row").alias("j", "v"))
    cells = each.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((max(r.i for r in cells) + 1, abs(width)), object if width < 0 else float)
    for i, j, v in cells:
        out[i, j] = v
    return out


def scaled(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """``key`` and ``x`` (whole numbers) of the rows with a complete vector, and the dimensions.

    Left out: null vectors, vectors with null, NaN or infinite entries, and vectors with fewer
    entries than the longest one (missing entries count as null).
    """
    d = df.agg(F.max(F.size(vector))).first()[0] or 0
    number = F.col(vector)
    complete = number.isNotNull() & (F.size(vector) == d)
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))

    def whole(c):
        wide = F.least(F.greatest(c.cast("double") * SCALE, F.lit(float(-LARGEST))), F.lit(float(LARGEST)))
        return F.floor(wide).cast("long") + OFFSET

    rows = df.filter(complete & finite).select(F.col(key).alias("_key"), F.transform(vector, whole).alias("x"))
    return rows, max(int(d), 0)


def fit(fit_list: DataFrame, d: int, components: int) -> Whitener | None:
    """Whitener of distinct vectors ``x``; None for an empty list."""
    bound_batches(fit_list.sparkSession)
    n = fit_list.count()
    if not n or not d:
        return None
    sums = [int(s) for s in _summed(fit_list, lambda c: _rows(c, d).sum(axis=0), -d)[0]]
    w = Whitener(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)

    def products(column: pa.Array) -> np.ndarray:
        x = _centred(_rows(column, d), w)
        return x.T @ x

    v = _summed(fit_list, products, d) / n
    v = (v + v.T) / 2
    w.values, w.vectors = largest(v, components)
    w.trace = float(np.trace(v))
    k = len(w.values)
    if k:
        project = w.vectors / np.sqrt(w.values)

        def whitened(column: pa.Array) -> np.ndarray:
            z = _centred(_rows(column, d), w) @ project
            return np.vstack([z.T @ z, z.sum(axis=0)])

        both = _summed(fit_list, whitened, k) / n
        cov = both[:k] - np.outer(both[k], both[k])
        w.identity_error = float(np.abs(cov - np.eye(k)).max())
    return w


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """``key``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``: one
    row for every complete vector and component.

    ``scaled`` says which vectors are complete.  The covariance is fitted on each distinct vector once,
    so copies in the table change nothing; repeated rows and null keys are rows of their own.
    Directions without variance are no components: a table of one vector, or of equal ones, gives no
    rows, nor does an empty table.  ``deviation`` is null where it exceeds 64 bits.  Scaled entries
    beyond ``LARGEST`` count as ``LARGEST``.  Other columns are not read.

    Vectors meet only to find copies (a shuffle); everything else is sums of matrices per task.  The
    driver gets matrices whose size is the square of the dimensions, whatever the number of rows.
    """
    spark = df.sparkSession
    rows, d = scaled(df, key, vector)
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    folder = scratch_dir(spark, "whitening")
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    rows.select("x").distinct().write.parquet(f"{folder}/fit")
    w = fit(spark.read.schema(rows.select("x").schema).parquet(f"{folder}/fit"), d, components)
    if w is None or not len(w.values):
        return _nothing(spark, schema)
    k = len(w.values)
    project, explained = w.vectors / np.sqrt(w.values), w.values / w.trace

    def project_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dev = _deviations(_rows(b.column("x"), d), w.n, w.sums)
            if float(np.abs(dev).max(initial=0)) ** 2 * d < 2.0**62:
                squares = (dev * dev).sum(axis=1).tolist()
            else:
                squares = [s if s < 1 << 63 else None for s in (sum(int(e) ** 2 for e in row) for row in dev)]
            z = (dev / w.n).astype(float) @ project
            m = len(z)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("_key").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n)),
                    pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(z.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, w.identity_error)),
                ],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project_rows, schema)


def _nothing(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
