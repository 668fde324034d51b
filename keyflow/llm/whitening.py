"""Embedding whitening by QDWH spectral divide and conquer.

Entries become whole numbers, ``x = floor(256 * c)``. The fit list holds every
distinct x-vector once. Its covariance (divisor n, centred before multiplying)
is summed up by Spark: a task adds up its own rows' products, the entries are
then summed by place. Only sums of d and d x d numbers reach the driver, so what
it holds depends on the dimension, never on the rows.

Components come from spectral divide and conquer on that d x d matrix: the polar
factor U of the covariance shifted to the middle of its spectrum (QR-based
dynamically weighted Halley iteration) has eigenvalues +1 and -1, so (U + I) / 2
projects onto the eigenvectors above the shift. An orthonormal basis of that
space and of its complement splits the matrix into two independent blocks, which
are split again until they are single components (or multiples of the identity,
where every basis is one of eigenvectors). Blocks that lie below the wanted
number of components are left alone.

The means, components and scales (bounded by d x components) are broadcast, and
every row is projected in one pass over Arrow batches.

Defined results: rows whose vector is null, empty or holds null or non-finite
entries are dropped; so are vectors of another length than the commonest one
(the longest of equally common ones). Repeated rows give a row each, in the fit
list they count once. A component without variance (at most d * 2^-52 of the
largest eigenvalue) cannot be scaled: its ``whitened`` is null and it stays out
of ``identity_error``; with no variance at all ``explained`` is 0. Entries are
cut to 2^53 in x, beyond which doubles skip whole numbers; ``deviation`` is null
where it does not fit a long. An empty table gives an empty result. Only the id
and the vector column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SCALE = 256
COMPONENTS = 4
#: rows that are multiplied at once
ROWS = 4096
LIMIT = float(1 << 53)
EPS = float(np.finfo(float).eps)


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: QR-based dynamically
    weighted Halley iteration, at most some seven steps at any condition."""
    size = np.linalg.norm(a, 2)
    if size == 0:
        return np.eye(len(a))
    x, m = a / size, len(a)
    low = EPS / np.sqrt(m)  # a lower bound of the singular values that matter
    eye = np.eye(m)
    for _ in range(40):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        s = np.sqrt(1 + d)
        wa = s + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - l2) / (l2 * s)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, eye]))[0]
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        moved, x = np.linalg.norm(new - x), new
        if moved <= np.cbrt(EPS) and 1 - low <= 1e-8:
            # the iteration is cubic: one more step than this is exact to EPS
            return _newton(x)
    return x


def _newton(x: np.ndarray) -> np.ndarray:
    """One Newton-Schulz step, which removes what rounding left."""
    return 1.5 * x - 0.5 * x @ x @ x


def spectral_split(a: np.ndarray, rng: np.random.Generator) -> tuple[int, np.ndarray] | None:
    """(k, basis): an orthonormal basis whose first k columns span the eigenvectors
    above a shift inside the spectrum; None for a multiple of the identity."""
    m = len(a)
    middle = np.trace(a) / m
    rest = a - middle * np.eye(m)
    if np.abs(rest).max() <= 4 * EPS * np.abs(a).max():
        return None
    diagonal = np.sort(np.diag(a))
    shifts = [middle, (diagonal[(m - 1) // 2] + diagonal[m // 2]) / 2]
    spread = np.linalg.norm(rest) / np.sqrt(m)
    shifts += [middle + t * spread for t in (0.37, -0.37, 0.81, -0.81, 0.05, -0.05)]
    best, least = None, np.inf  # (k, basis)
    for shift in shifts:
        p = (polar_factor(a - shift * np.eye(m)) + np.eye(m)) / 2
        k = int(round(np.trace(p)))
        if not 0 < k < m:
            continue
        # the range of the projector: its product with a random block, made
        # orthonormal, and once more for the digits
        basis = np.linalg.qr(p @ rng.standard_normal((m, k)))[0]
        basis = np.linalg.qr(p @ basis, mode="complete")[0]
        left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if left < least:
            best, least = (k, basis), left
        if left <= 10 * m * EPS * np.linalg.norm(a):
            break
    return best


def components(cov: np.ndarray, top: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix,
    by recursive splits; ``top`` of them, or all."""
    m = len(cov)
    top = m if top is None else min(top, m)
    rng = np.random.default_rng(11)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    # blocks from the top of the spectrum down; a stack bounds the depth
    blocks = [(cov, np.eye(m))]
    while blocks and len(values) < top:
        a, basis = blocks.pop()
        found = spectral_split(a, rng) if len(a) > 1 else None
        if found is None:
            values += np.diag(a).tolist()
            vectors += list(basis.T)
            continue
        k, q = found
        for part in (q[:, k:], q[:, :k]):
            sub = part.T @ a @ part
            blocks.append(((sub + sub.T) / 2, basis @ part))
    if not values:
        return np.zeros(0), np.zeros((m, 0))
    v = np.linalg.qr(np.stack(vectors, axis=1))[0]
    e = np.einsum("ij,ik,kj->j", v, cov, v)
    order = np.argsort(-e, kind="stable")[:top]
    return e[order], v[:, order]


@dataclass(frozen=True)
class Whitening:
    """Row count and sums of the fit list, its leading components and scales."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    total: float

    @property
    def usable(self) -> np.ndarray:
        low = len(self.sums) * EPS * max(self.values.max(initial=0.0), 0.0)
        return self.values > low

    @property
    def weights(self) -> np.ndarray:
        """Columns that take a centred vector to its whitened coordinates."""
        scale = np.where(self.usable, np.sqrt(np.where(self.usable, self.values, 1)), np.inf)
        return self.vectors / scale


def whole_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x) of the rows whose vector is complete and finite."""
    c = F.transform(F.col(vector), lambda v: v.cast("double"))
    # exists is null where only nulls are found, so nulls are asked for as such
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    x = F.transform(c, lambda v: F.floor(
        F.greatest(F.least(v * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))).cast("long"))
    whole = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad
    return rows.filter(whole).select(F.col(vec_id).alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(fit: DataFrame, d: int, kind: str, part) -> dict[int, float]:
    """Per place, the sum over all rows of what ``part`` makes of a block of them.
    A task sends one row per place; places are summed by Spark."""

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in it:
            for at in range(0, batch.num_rows, ROWS):
                one = part(_matrix(batch.column(0).slice(at, ROWS), d))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "v"])

    places = (fit.select("x").mapInArrow(add, f"place long, v {kind}")
              .groupBy("place").agg(F.sum("v").alias("v")).collect())
    return {r["place"]: r["v"] for r in places}


def _array(sums: dict[int, float], size: int) -> np.ndarray:
    return np.array([sums.get(i, 0.0) for i in range(size)])


def fit_whitening(vectors: DataFrame, d: int,
                  top: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """The whitening of (vec_id, x) rows of length ``d`` and the written fit list;
    None without rows."""
    fit = materialize(vectors.select("x").distinct(), "whitening-fit")
    sums = _summed(fit, d, "long", lambda x: np.append(x.sum(axis=0), len(x)))
    if not sums:
        return None
    n, total = sums[d], np.array([sums[j] for j in range(d)], dtype=np.int64)
    mean = total / n

    def products(x: np.ndarray) -> np.ndarray:
        c = x - mean
        return c.T @ c

    cov = _array(_summed(fit, d, "double", products), d * d).reshape(d, d) / n
    cov = (cov + cov.T) / 2
    values, vecs = components(cov, top)
    return Whitening(n, total, values, vecs, float(np.trace(cov))), fit


def identity_error(w: Whitening, fit: DataFrame) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the
    identity, over the components that have variance."""
    d, k = w.vectors.shape
    mean, weights = w.sums / w.n, w.weights
    centre = _array(_summed(fit, d, "double", lambda x: ((x - mean) @ weights).sum(axis=0)), k) / w.n

    def products(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ weights - centre
        return z.T @ z

    cov = _array(_summed(fit, d, "double", products), k * k).reshape(k, k) / w.n
    usable = w.usable
    off = np.abs(cov - np.eye(k))[np.ix_(usable, usable)]
    return float(off.max(initial=0.0))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums over dimensions of (n*x - S)^2."""
    bound = (float(n) * np.abs(x).max(initial=0) + np.abs(sums.astype(float)).max(initial=0))
    if bound * bound * max(1, x.shape[1]) < 2.0 ** 62:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    wide = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in wide]


SCHEMA = ("component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           top: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: its whitened coordinate."""
    kind = rows.schema[vec_id].dataType.simpleString()
    vectors = whole_vectors(rows, vec_id, vector)
    spark = rows.sparkSession
    empty = spark.createDataFrame([], f"vec_id {kind}, {SCHEMA}")
    lengths = (vectors.groupBy(F.size("x").alias("d")).count()
               .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    if not lengths:
        return empty
    d = lengths[0]["d"]
    vectors = vectors.filter(F.size("x") == d)
    w, fit = fit_whitening(vectors, d, top)
    error = identity_error(w, fit)
    shared = spark.sparkContext.broadcast(w)

    def project(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        k, mean, weights = len(own.values), own.sums / own.n, own.weights
        share = np.clip(own.values, 0, None) / own.total if own.total > 0 else np.zeros(k)
        missing = ~own.usable
        for batch in it:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part.column(1), d)
                rows_, z = len(x), (x - mean) @ weights
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(rows_), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * k, own.n)),
                    pa.array([v for v in deviations(x, own.n, own.sums) for _ in range(k)],
                             pa.int64()),
                    pa.array(z.ravel(), mask=np.tile(missing, rows_)),
                    pa.array(np.tile(share, rows_)),
                    pa.array(np.full(rows_ * k, error))],
                    names=["vec_id", *(f.split()[0] for f in SCHEMA.split(", "))])

    return vectors.select("vec_id", "x").mapInArrow(project, f"vec_id {kind}, {SCHEMA}")
