"""Embedding whitening: the leading eigenvectors of the covariance by Chebyshev-filtered subspace iteration.

Components become integers x. One pass sums them exactly; every further pass computes the centred product (1/n) sum (x - m)((x - m)'Q) for a
block Q of a few more columns than are wanted, one array a task, so no task or driver holds more than dimension x block numbers.

Two block Lanczos steps give a first block and bounds of the spectrum. An iteration applies a Chebyshev polynomial by its
three-term recurrence, one pass a degree, which damps the part of the spectrum below the block and lets what is above grow; then come QR and
Rayleigh-Ritz. It ends when the residuals |V q - e q| of all wanted pairs are certified: at ``TOLERANCE`` of the largest eigenvalue, or as
small as rounding lets them get.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adjudika.llm.vectors import finite_rows, matrix, pieces, summed, width_of

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Columns of the block beyond the wanted ones; the more, the faster the unwanted part is damped.
EXTRA = 16
DEGREE, MOST_ITERATIONS = 8, 200
#: Largest growth of one filter, so that rounding errors of the first column do not drown the last.
MOST_GROWTH = 1e10
TOLERANCE, ROUNDING = 4e-14, 1e-11
#: Components with a smaller share of the variance count as having none.
NO_VARIANCE = 1e-12


@dataclass
class Moments:
    """Rows, exact sums of the integer components, and the integer and fractional part of their means."""
    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the integer difference is exact, the fraction is rounded once."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """sum (n x - S)^2 of every row, exactly."""
        apart = x - self.whole
        most = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return ((apart * self.n - self.rest) ** 2).sum(1)
        wide = apart.astype(object) * self.n - self.rest.astype(object)
        return (wide * wide).sum(1).tolist()


def moments(vectors: DataFrame, width: int, scale: int = SCALE, shift: int = SHIFT) -> Moments:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1, np.int64)
        for batch in pieces(batches):
            x = matrix(batch.column("embedding"), scale, shift)
            total[:width] += x.sum(0)
            total[width] += len(x)
        if total[width]:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["sums"])

    every = [int(s) for s in summed(vectors.mapInArrow(sums, "sums array<bigint>"), "sums", "decimal(38,0)")]
    return Moments(every[width], every[:width])


def product(vectors: DataFrame, at: Moments, q: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> tuple[np.ndarray, float]:
    """V q for the covariance V of the rows, and the trace of V: one pass."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, trace, passed = np.zeros(q.shape), 0.0, 0
        for batch in pieces(batches):
            x = at.centred(matrix(batch.column("embedding"), scale, shift))
            total += x.T @ (x @ q)
            trace += float((x * x).sum())
            passed += len(x)
        if passed:
            yield pa.RecordBatch.from_arrays([pa.array([np.append(total.ravel(), trace) / at.n], pa.list_(pa.float64()))], names=["sums"])

    every = np.array(summed(vectors.mapInArrow(sums, "sums array<double>"), "sums", "double"))
    return every[:-1].reshape(q.shape), float(every[-1])


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, the Ritz vectors in the span of q, and V times these."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def _filtered(apply, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """A scaled Chebyshev polynomial of V, small on [low, high], times q; ``vq`` = V q saves the first pass."""
    half, middle = (high - low) / 2, (high + low) / 2
    growth = np.arccosh(max(1.0 + 1e-9, (top - middle) / half))
    degree = int(np.clip(np.log(2 * MOST_GROWTH) / growth, 2, DEGREE))
    first = half / (top - middle)
    factor, before, now = first, q, (vq - middle * q) * (first / half)
    for _ in range(degree - 1):
        further = 1 / (2 / first - factor)
        before, now = now, (apply(now) - middle * now) * (2 * further / half) - before * (factor * further)
        factor = further
    return now


@dataclass
class Basis:
    """Eigenvalues, falling, and eigenvectors as columns, for components with a variance; the covariance's trace and the passes it took."""
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int
    residual: float


def leading(apply_traced, width: int, components: int = COMPONENTS) -> Basis:
    """The leading eigenpairs of the matrix that ``apply_traced(q) -> (V q, trace V)`` multiplies by."""
    passes = [0]
    trace = [0.0]

    def apply(q):
        passes[0] += 1
        made, trace[0] = apply_traced(q)
        return made

    wanted, size = min(components, width), min(width, components + EXTRA)
    q, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((width, size)))
    vq = apply(q)
    if trace[0] <= 0:
        return Basis(np.zeros(0), np.zeros((width, 0)), 0.0, passes[0], 0.0)
    low = 0.0
    if size < width:
        # A second Lanczos block: its least Ritz value, less its residual, bounds the spectrum from below.
        more, _ = np.linalg.qr(np.concatenate([q, vq - q @ (q.T @ vq)], 1))
        more = more[:, size:min(width, 2 * size)]
        values, wide, vwide = _ritz(np.concatenate([q, more], 1), np.concatenate([vq, apply(more)], 1))
        low = max(0.0, float(values[-1] - np.linalg.norm(vwide[:, -1] - values[-1] * wide[:, -1])))
        values, q, vq = values[:size], wide[:, :size], vwide[:, :size]
    else:
        values, q, vq = _ritz(q, vq)
    last = np.inf
    for _ in range(MOST_ITERATIONS):
        pairs = slice(0, wanted)
        residual = float(np.linalg.norm(vq[:, pairs] - q[:, pairs] * values[pairs], axis=0).max())
        if residual <= TOLERANCE * values[0] or size == width or (residual <= ROUNDING * values[0] and residual > last / 2):
            break
        last = residual
        high = float(values[-1])
        if high <= low or high - low < 1e-9 * values[0]:
            low = 0.0
        if high <= NO_VARIANCE * values[0]:  # nothing is left to damp: the block holds the whole range
            q, _ = np.linalg.qr(vq)
        else:
            q, _ = np.linalg.qr(_filtered(apply, q, vq, low, high, float(values[0])))
        vq = apply(q)
        values, q, vq = _ritz(q, vq)
        low = min(low, max(0.0, float(values[-1])))
    else:
        raise RuntimeError(f"eigenvectors are not certified: residual {residual:.3g} of {values[0]:.3g}")
    held = int((values[:wanted] > NO_VARIANCE * trace[0]).sum())
    found = q[:, :held]
    sign = np.where(found[np.abs(found).argmax(0), np.arange(held)] < 0, -1.0, 1.0) if held else np.ones(0)
    return Basis(values[:held], found * sign, trace[0], passes[0], residual)


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> tuple[Moments, Basis] | None:
    """Moments and basis of the integer vectors of ``vectors`` (embedding, finite); None for an empty table."""
    width = width_of(vectors, "embedding")
    if width is None:
        return None
    slim = vectors.select("embedding")
    at = moments(slim, width, scale, shift)
    if not width:
        return at, Basis(np.zeros(0), np.zeros((0, 0)), 0.0, 0, 0.0)
    return at, leading(lambda q: product(slim, at, q, scale, shift), width, components)


def identity_error(vectors: DataFrame, at: Moments, basis: Basis, scale: int = SCALE, shift: int = SHIFT) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity: one pass."""
    held = len(basis.values)
    if not held:
        return 0.0
    turn = basis.vectors / np.sqrt(basis.values)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean, passed = np.zeros((held, held)), np.zeros(held), 0
        for batch in pieces(batches):
            y = at.centred(matrix(batch.column("embedding"), scale, shift)) @ turn
            total += y.T @ y
            mean += y.sum(0)
            passed += len(y)
        if passed:
            yield pa.RecordBatch.from_arrays([pa.array([np.append(total.ravel(), mean) / at.n], pa.list_(pa.float64()))], names=["sums"])

    every = np.array(summed(vectors.select("embedding").mapInArrow(sums, "sums array<double>"), "sums", "double"))
    mean = every[held * held:]
    return float(np.abs(every[:held * held].reshape(held, held) - np.outer(mean, mean) - np.eye(held)).max())


RESULT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, "
          "deviation_digits string")


def whitened(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row for each finite vector of ``embeddings`` (vec_id, embedding) and component: the columns of ``RESULT``.

    Rows whose vector is null, or holds a null or non-finite entry, are dropped; an empty table gives an empty one. There are as many
    components as the vectors have dimensions with a variance, 8 at most: a table of equal vectors, or of one, has none and gives no row.
    Repeated ids stay repeated rows. A deviation beyond a long is null there and stands in ``deviation_digits``, null otherwise. Vectors of several
    lengths raise. Each pass scans the table, so ``embeddings`` has to be a stored one.
    """
    vectors = finite_rows(embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"), "embedding")
    fitted = fit(vectors, components, scale, shift)
    if fitted is None or not len(fitted[1].values):
        return embeddings.sparkSession.createDataFrame([], RESULT)
    at, basis = fitted
    error = identity_error(vectors, at, basis, scale, shift)
    turn, held = basis.vectors / np.sqrt(basis.values), len(basis.values)
    explained = basis.values / basis.trace

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = matrix(batch.column("embedding"), scale, shift)
            y = at.centred(x) @ turn
            exact = [int(v) for v in at.deviations(x)]
            fits = [v if v < 1 << 63 else None for v in exact]
            each = np.repeat(np.arange(len(x)), held)
            rows = len(each)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, held + 1, dtype=np.int32), len(x))),
                pa.array(np.full(rows, at.n)), pa.array(fits, pa.int64()).take(pa.array(each)), pa.array(y.ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(rows, error)),
                pa.array([None if v is not None else str(w) for v, w in zip(fits, exact)], pa.string()).take(pa.array(each))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_digits"])

    return vectors.mapInArrow(made, RESULT)
