"""Embedding whitening: each partition counts, sums and centres its vectors, the pairwise merge formula adds the
partitions up, the driver takes eigenvectors of one matrix, and a second pass tells how white the result is."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready
from .vectors import matrix, state_batch, tree_reduced, whole

#: Entries are multiplied by SCALE, rounded down and moved up by SHIFT. Beyond LARGEST they count as non-finite.
SCALE, SHIFT, LARGEST = 64, 1_000_000, float(1 << 43)


@dataclass
class Moments:
    """Count, exact sums and the scatter about the mean. Sums of whole numbers are Python's, which don't overflow."""

    n: int
    sums: np.ndarray
    scatter: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        if x.dtype == np.int64:
            out = cls(len(x), x.sum(0).astype(object), np.empty(0))
            low, part = out.mean()
            z = (x - low.astype(np.int64)) - part
        else:
            out = cls(len(x), x.sum(0), np.empty(0))
            z = x - out.sums / out.n
        out.scatter = z.T @ z
        return out

    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean rounded down, and what is left of it, so that a large mean costs no digits."""
        if self.sums.dtype == object:
            low = self.sums // self.n
            return low, ((self.sums - low * self.n) / self.n).astype(np.float64)
        return np.zeros(len(self.sums)), self.sums / self.n

    def merge(self, other: Moments) -> Moments:
        """Chan's formula: the scatters, and the gap between the means."""
        (a, pa_), (b, pb) = self.mean(), other.mean()
        gap = (b - a).astype(np.float64) + (pb - pa_)
        n = self.n + other.n
        return Moments(n, self.sums + other.sums, self.scatter + other.scatter + np.outer(gap, gap) * (self.n / n * other.n))


def _merge(a: Moments, b: Moments) -> Moments:
    return a.merge(b)


@dataclass
class Whitening:
    """A fitted whitening: the mean of whole numbers in two parts, components as columns, and their eigenvalues."""

    n: int
    low: np.ndarray  # the mean rounded down
    rest: np.ndarray  # n times what is left of it
    part: np.ndarray  # the same, divided by n
    components: np.ndarray
    values: np.ndarray
    trace: float

    @classmethod
    def of(cls, m: Moments, most: int) -> Whitening:
        value, vector = np.linalg.eigh(m.scatter / m.n)
        order = np.argsort(-value, kind="stable")[:most]
        vector = vector[:, order]
        top = np.abs(vector).argmax(0)
        vector = vector * np.where(vector[top, np.arange(len(order))] < 0, -1.0, 1.0)
        low, part = m.mean()
        # What rounding alone leaves of an eigenvalue is none.
        least = max(value.max(), 0.0) * len(value) * 8 * np.finfo(float).eps
        return cls(m.n, low.astype(np.int64), (m.sums - low * m.n).astype(np.int64), part, vector, np.where(value[order] > least, value[order], 0.0), float(np.trace(m.scatter) / m.n))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN along components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return ((x - self.low) - self.part) @ self.components / np.where(self.values > 0, np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Each row's exact sum of (n x - S)^2; None where a long doesn't hold it."""
        d = x - self.low
        most = self.n * (int(np.abs(d).max(initial=0)) + 1)
        if x.shape[1] * most * most < 1 << 63:
            t = d * self.n - self.rest
            return (t * t).sum(1).tolist()
        t = d.astype(object) * self.n - self.rest.astype(object)
        return [v if v < 1 << 63 else None for v in (t * t).sum(1).tolist()]


def _numbers(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and whole numbers of the vectors that count."""
    at, c = matrix(col, dim)
    y = np.floor(SCALE * c)
    use = (np.abs(y) <= LARGEST).all(1)
    return at[use], y[use].astype(np.int64) + SHIFT


def _gather(dim: int, white: Whitening | None = None):
    """A partition's moments: of the whole numbers, or of what the whitening makes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            for lo in range(0, b.num_rows, 8192):
                _, x = _numbers(b.column(0).slice(lo, 8192), dim)
                if len(x):
                    m = Moments.of(x if white is None else white.whiten(x)[:, white.values > 0])
                    state = m if state is None else state.merge(m)
        if state is not None:
            yield state_batch(state)

    return run


def _rows(dim: int, white: Whitening, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(white.values)
        explained = white.values / white.trace if white.trace > 0 else np.full(k, np.nan)
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                at, x = _numbers(part.column(1), dim)
                m = len(at)
                if m:
                    y = white.whiten(x).reshape(-1)
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(np.repeat(at, k), pa.int64())), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, white.n, np.int64)),
                        pa.array(white.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(y, pa.float64(), mask=np.isnan(y)),
                        pa.array(np.tile(explained, m), pa.float64(), mask=np.tile(np.isnan(explained), m)), pa.array(np.full(m * k, error)),
                    ], ["row", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def fit(vectors: DataFrame, *, vector_col: str = "embedding", most: int = 32, dim: int | None = None) -> tuple[Whitening, float] | None:
    """The whitening of all vectors that count, and the largest entry of its result's covariance minus the identity.

    ``dim`` None: the length that most vectors have, the smaller one of equals. None where no vector counts.
    What comes to the driver is one state of ``dim`` squared numbers, whatever the number of vectors.
    """
    ready(vectors.sparkSession)
    v = vectors.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fits = whole(F.col("v")) & ~F.exists("v", lambda c: F.abs(F.floor(c * SCALE)) > LARGEST)
    size = v.where(fits).groupBy(F.size("v").alias("dim")).count().where("dim > 0" if dim is None else F.col("dim") == dim)
    known = size.orderBy(F.desc("count"), "dim").first()
    if known is None:
        return None
    dim = known["dim"]
    white = Whitening.of(tree_reduced(v.mapInArrow(_gather(dim), "state binary"), _merge), most)
    if not (white.values > 0).any():
        return white, 0.0
    second = tree_reduced(v.mapInArrow(_gather(dim, white), "state binary"), _merge)
    return white, float(np.abs(second.scatter / second.n - np.eye(second.scatter.shape[0])).max())


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32, keep: list[str] | None = None) -> DataFrame:
    """Each vector along the ``most`` strongest components: ``(row, component, n, deviation, whitened, explained, identity_error)``.

    ``row`` is a struct of the columns to ``keep`` (None: the id alone). Entries c count as floor(64 c) + 1,000,000.
    Vectors that are null, empty or hold null or non-finite entries (or entries beyond 1e11) have no rows, nor have
    vectors of another length than most have. Null or repeated ids, repeated vectors: each row counts. A component
    without variance has null ``whitened`` and 0 ``explained`` (null where nothing varies); ``deviation`` is null where
    a long doesn't hold it. Empty input: empty output.
    """
    names = [id_col] if keep is None else keep
    kept = T.StructType([vectors.schema[c] for c in names])
    schema = T.StructType([T.StructField("row", kept)])
    for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        schema = schema.add(name, kind)
    found = fit(vectors, vector_col=vector_col, most=most)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    white, error = found
    rows = vectors.select(F.struct(*[vectors[f"`{c}`"] for c in names]).alias("row"), vectors[f"`{vector_col}`"].cast("array<double>").alias("v"))
    return rows.mapInArrow(_rows(len(white.low), white, error), schema)
