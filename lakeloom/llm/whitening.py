"""Whitening of embeddings by spectral divide and conquer.

Counts, sums and products are gathered by Spark as exact integers, so the
covariance does not depend on how rows are dealt to tasks. Its eigenvectors come
from polar decompositions: for a shift s the orthogonal polar factor U of
V - s*I has eigenvalue 1 where V's is above s and -1 below, so (I + U) / 2 is
the projector on the invariant subspace above the shift. Bases of both
subspaces split the matrix in two, and each part is split again until single
components (or a part that is a multiple of the identity) are left. Polar
factors come from the QR-based, dynamically weighted Halley iteration. The
matrix has a side of the vectors' length, whatever the number of rows; the
whitening matrix is broadcast and applied in the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: entries c become floor(SCALE * c) + SHIFT
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: integers beyond this are cut off (a double has no finer ones)
FAR = 1 << 52
#: longest vectors; the driver holds a few square matrices of this side
MOST_DIMENSIONS = 4096
_BIG = pa.decimal128(38, 0)


# -- linear algebra on the covariance ----------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by the QR-based,
    dynamically weighted Halley iteration."""
    n = len(a)
    norm = np.linalg.norm(a)  # at least the largest singular value
    if norm == 0:
        return np.eye(n)
    x, low, eye = a / norm, 1e-16, np.eye(n)  # low: a lower bound of the smallest singular value
    for _ in range(20):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square ** 2) if square < 1 else 0.0
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 1e-15 and moved < 1e-13 * np.sqrt(n):
            break
    return x


def _basis(p: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal basis of the range of a projector of rank k."""
    q, _ = np.linalg.qr(p @ rng.normal(size=(len(p), k)))
    q, _ = np.linalg.qr(p @ q)
    return q


def _split(a: np.ndarray, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces of ``a`` that make up all of it, the
    one with the larger eigenvalues first; None if no shift parts it."""
    m = len(a)
    for shift in [np.median(np.diag(a)), np.mean(np.diag(a)), *np.quantile(np.diag(a), [0.25, 0.75]),
                  *(np.mean(np.diag(a)) + scale * rng.normal(size=8))]:
        u = polar(a - shift * np.eye(m))
        if np.linalg.norm(u @ u - np.eye(m)) > 1e-10 * m:
            continue  # the shift hit an eigenvalue
        p = (np.eye(m) + u) / 2
        k = int(round(np.trace(p)))
        if 0 < k < m:
            return _basis(p, k, rng), _basis(np.eye(m) - p, m - k, rng)
    return None


def eigen(v: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix by spectral divide and conquer."""
    rng = np.random.default_rng(seed)
    norm = np.linalg.norm(v)
    values, vectors = [], []
    parts = [(v, np.eye(len(v)))] if len(v) else []
    while parts:
        a, q = parts.pop()
        spread = np.linalg.norm(a - np.mean(np.diag(a)) * np.eye(len(a))) if len(a) > 1 else 0.0
        halves = _split(a, spread / np.sqrt(len(a)), rng) if spread > 1e-15 * norm * len(a) else None
        if halves is None:
            values.extend(np.diag(a))
            vectors.extend(q.T)
            continue
        for half in halves:
            inner = half.T @ a @ half
            parts.append(((inner + inner.T) / 2, q @ half))
    w = np.array(vectors).T.reshape(len(v), -1)
    if len(v):
        w, _ = np.linalg.qr(w)  # takes away the rounding of the products of bases
        values = np.einsum("ij,ij->j", w, v @ w)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], w[:, order]


# -- exact sums by Spark ------------------------------------------------------

def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the vectors that are neither null nor empty
    and hold neither nulls nor non-finite entries."""
    # a comparison with null is null, one with NaN or infinity false
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (table.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .where((F.size("v") > 0) & F.forall("v", finite)))


def _integers(column: pa.Array, side: int) -> np.ndarray:
    """Rows of floor(SCALE * c) + SHIFT."""
    x = np.floor(SCALE * np.asarray(column.flatten()).reshape(-1, side))
    return np.clip(x, -FAR, FAR).astype(np.int64) + SHIFT


def _exact_rows(numbers) -> list[Decimal]:
    return [Decimal(int(v)) for v in numbers]


def _added(parts: DataFrame) -> dict[int, int]:
    """Sums by position: one row a position comes to the driver."""
    return {r.i: int(r.s) for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect()}


def sums(rows: DataFrame, side: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension's integers."""
    def run(batches):
        total = [0] * (side + 1)
        for batch in batches:
            x = _integers(batch.column(0), side)
            high, low = x >> 26, x & ((1 << 26) - 1)  # both sums fit in 64 bits
            total[0] += len(x)
            for k, (h, w) in enumerate(zip(high.sum(axis=0).tolist(), low.sum(axis=0).tolist())):
                total[k + 1] += (h << 26) + w
        yield pa.RecordBatch.from_arrays([pa.array(range(side + 1), pa.int32()), pa.array(_exact_rows(total), _BIG)], ["i", "s"])

    got = _added(rows.select("v").mapInArrow(run, "i int, s decimal(38,0)"))
    return got.get(0, 0), [got.get(k + 1, 0) for k in range(side)]


def _products(y: np.ndarray) -> np.ndarray:
    """y'y in Python integers; by doubles where they are exact."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(len(y), 1) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    big = y.astype(object)
    return big.T @ big


def covariance(rows: DataFrame, side: int, n: int, s: list[int]) -> np.ndarray:
    """Covariance, divisor n. Vectors are centred by the whole number next to
    each mean before they are multiplied, in exact integers; the fractions of
    the means that are left are then taken out exactly."""
    centre = [(2 * t + n) // (2 * n) for t in s]
    upper = np.triu_indices(side)

    def run(batches):
        middle = np.array(centre, np.int64)
        total = np.zeros((side, side), object)
        for batch in batches:
            x = _integers(batch.column(0), side)
            for k in range(0, len(x), 4096):
                total = total + _products(x[k:k + 4096] - middle)
        flat = total[upper]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(_exact_rows(flat), _BIG)], ["i", "s"])

    got = _added(rows.select("v").mapInArrow(run, "i int, s decimal(38,0)"))
    left = [t - n * c for t, c in zip(s, centre)]
    v = np.zeros((side, side))
    for k, (i, j) in enumerate(zip(*upper)):
        v[i, j] = v[j, i] = float(Fraction(n * got.get(k, 0) - left[i] * left[j], n * n))
    return v


# -- the operator -------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """``matrix``: side x components, each eigenvector over the root of its
    eigenvalue; ``explained``: each eigenvalue over the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    matrix: np.ndarray
    explained: np.ndarray

    def _centred(self, x: np.ndarray) -> np.ndarray:
        centre = np.array([t // self.n for t in self.sums], np.int64)
        rest = np.array([(t % self.n) / self.n for t in self.sums])
        return (x - centre).astype(float) - rest

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self._centred(x) @ self.matrix

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum)^2, exact."""
        centre = np.array([t // self.n for t in self.sums], np.int64)
        rest = np.array([t % self.n for t in self.sums], object)
        y = x - centre
        if (int(np.abs(y).max(initial=0)) + 1) * self.n < 1 << 62:
            d = y * self.n - rest.astype(np.int64)
            if int(np.abs(d).max(initial=0)) ** 2 * len(self.sums) < 1 << 62:
                return (d * d).sum(axis=1).tolist()
        d = y.astype(object) * self.n - rest
        return (d * d).sum(axis=1).tolist()


def fit(rows: DataFrame, side: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``rows`` (v array<double> of one length). None if
    there are none. Components whose eigenvalue is 0 to double precision
    cannot be scaled to 1 and are left out."""
    n, s = sums(rows, side)
    if not n:
        return None
    v = covariance(rows, side, n, s)
    values, vectors = eigen(v)
    trace = float(np.trace(v))
    k = min(components, int((values > 1e-13 * max(trace, 0.0)).sum()) if trace > 0 else 0)
    return Whitening(n, s, values, vectors, vectors[:, :k] / np.sqrt(values[:k]), values[:k] / trace if trace > 0 else values[:k])


def identity_error(rows: DataFrame, side: int, w: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened vectors minus
    the identity, measured on the vectors."""
    sent, k = rows.sparkSession.sparkContext.broadcast(w), w.matrix.shape[1]

    def run(batches):
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = sent.value.apply(_integers(batch.column(0), side))
            total += y.sum(axis=0)
            square += y.T @ y
        flat = np.r_[total, square.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["i", "s"])

    parts = rows.select("v").mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
    flat = np.zeros(k + k * k)
    for r in parts.collect():  # one row a position
        flat[r.i] = r.s
    mean = flat[:k] / w.n  # 0 but for rounding
    return float(np.abs(flat[k:].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def dimensions(rows: DataFrame) -> int:
    """The most frequent length of the vectors, the larger one of equals; 0 without any."""
    found = rows.groupBy(F.size("v").alias("side")).count().orderBy(F.desc("count"), F.desc("side")).first()
    if found and found.side > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {found.side} entries; at most {MOST_DIMENSIONS}")
    return found.side if found else 0


OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(table: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    a row for each usable vector and component, numbered from 1 by falling
    eigenvalue.

    Null and empty vectors, vectors with null or non-finite entries and
    vectors whose length is not the most frequent one leave. Null ids and
    repeated rows keep their rows and count each. Equal eigenvalues: any
    basis of their subspace, the same for all rows. Components without variance
    have no rows; so one vector alone, equal vectors or an empty table give an
    empty table. Other columns are ignored. Entries beyond 2^52 / 1024 are cut
    off there.
    """
    rows = usable(table, vec_id, vector)
    side = dimensions(rows)
    kind = table.schema[vec_id].dataType.simpleString()
    rows = rows.where(F.size("v") == side)
    w = fit(rows, side, components) if side else None
    if w is None or not w.matrix.shape[1]:
        return table.sparkSession.createDataFrame([], f"vec_id {kind}, {OUT}")
    error, k = identity_error(rows, side, w), w.matrix.shape[1]
    sent = table.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        w = sent.value
        for batch in batches:
            for first in range(0, len(batch), 8192):
                part = batch.slice(first, 8192)
                x, m = _integers(part.column(1), side), len(part)
                ids = part.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                far = pa.array(np.repeat(np.array(_exact_rows(w.deviations(x)), object), k), _BIG)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)), far, pa.array(w.apply(x).ravel()),
                     pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "v").mapInArrow(run, f"vec_id {kind}, {OUT}")
