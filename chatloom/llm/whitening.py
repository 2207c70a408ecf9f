"""Whitening of vectors by spectral divide and conquer on polar decompositions (QDWH).

Count, sums and covariance are gathered by Spark over the distinct vectors; what reaches the driver is one
square matrix of the vectors' dimension. There the matrix is split: the polar factor of the covariance
less a shift has eigenvalues 1 above the shift and -1 below, so half of it plus the identity projects onto the
subspace above. Bases of the two subspaces give two smaller matrices, which are split again. The directions
of all dimensions are small enough to travel with the tasks that whiten the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import scratch_dir

EPS = np.finfo(np.float64).eps
LONG_MAX = (1 << 63) - 1


def polar(a: np.ndarray, limit: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps.

    Each step maps singular values in [low, 1] to a narrower interval below 1 by the best rational function
    of its type; steps with large weights use QR, the later ones a Cholesky factor.
    """
    n = len(a)
    scale = np.sqrt(np.abs(a).sum(axis=0).max() * np.abs(a).sum(axis=1).max())
    if not scale:
        return np.eye(n)
    x, low, eye = a / scale, EPS, np.eye(n)
    for _ in range(limit):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        h = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            new = (b / c) * x + (h - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        else:
            lower = np.linalg.cholesky(eye + c * x.T @ x)
            solved = np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
            new = (b / c) * x + (h - b / c) * solved
        new = (new + new.T) / 2
        low = min(1.0, low * (h + b * square) / (1 + c * square))
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * EPS and moved <= (4 * EPS) ** (1 / 3) * np.linalg.norm(x):
            break
    # One Newton-Schulz step takes what rounding has left.
    x = x @ (3 * eye - x.T @ x) / 2
    return (x + x.T) / 2


def _split(a: np.ndarray, size: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None if no shift divides."""
    n, diagonal = len(a), np.sort(np.diag(a))
    spread = np.linalg.norm(a - np.trace(a) / n * np.eye(n), 2)
    middle = np.trace(a) / n
    shifts = [np.median(diagonal), middle, (diagonal[0] + diagonal[-1]) / 2]
    # Shifts that happen to be an eigenvalue leave a direction on neither side: then others are tried.
    shifts += [middle + spread * t for t in rng.uniform(-0.9, 0.9, 24)]
    best = None
    for shift in shifts:
        u = polar(a - shift * np.eye(n))
        above = (u + np.eye(n)) / 2
        rank = int(round(np.trace(above)))
        if not 0 < rank < n:
            continue
        basis = rng.standard_normal((n, n))
        basis[:, :rank] = above @ basis[:, :rank]
        basis[:, rank:] -= above @ basis[:, rank:]
        first, _ = np.linalg.qr(above @ np.linalg.qr(basis[:, :rank])[0])
        q, _ = np.linalg.qr(np.hstack([first, basis[:, rank:]]))
        one, two = q[:, :rank], q[:, rank:]
        rest = np.linalg.norm(two.T @ a @ one)
        if best is None or rest < best[0]:
            best = rest, one, two
        if rest <= 10 * n * EPS * size:
            break
    return None if best is None or best[0] > 1e-10 * size else best[1:]


def eigen(matrix: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    rng = np.random.default_rng(seed)
    size = np.linalg.norm(matrix)
    found: list[tuple[float, np.ndarray]] = []
    pending = [(matrix, np.eye(len(matrix)))] if len(matrix) else []
    while pending:
        a, basis = pending.pop()
        a = (a + a.T) / 2
        rest = np.linalg.norm(a - np.diag(np.diag(a)))
        parts = None if len(a) == 1 or rest <= EPS * size else _split(a, size, rng)
        if parts is None:  # one direction, or directions of one eigenvalue: every basis of them serves
            found += [(a[i, i], basis[:, i]) for i in range(len(a))]
        else:
            pending += [(p.T @ a @ p, basis @ p) for p in parts]
    vectors = np.array([v for _, v in found]).reshape(len(found), len(matrix)).T
    if len(found):
        vectors, _ = np.linalg.qr(vectors)
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def clean(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, the entries as whole 256ths, of the rows whose vector has finite entries only.

    ``x`` is floor(256 * entry), worked out in double precision; beyond 64 bits it is the nearest long.
    """
    entry = lambda c: c.cast("double")
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) == float("inf")))
    x = F.transform("v", lambda c: F.floor(entry(c) * 256))
    named = table.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    return named.filter(F.col("v").isNotNull()).filter(~odd).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """A batch's vectors, all of one length, as rows of a matrix."""
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _summed(vectors: DataFrame, d: int, terms: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of a d x d matrix that ``terms`` gives for a batch of them.

    A task sends one matrix, as cells, however many vectors it has read; cells are added up in
    parallel, and nothing but the finished matrix reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                total += terms(_matrix(batch))
        rows, columns = np.indices((d, d)).reshape(2, -1)
        yield pa.record_batch([pa.array(rows), pa.array(columns), pa.array(total.ravel())], ["i", "j", "v"])

    cells = vectors.select("x").mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    matrix = np.zeros((d, d))
    for row in cells.collect():
        matrix[row.i, row.j] = row.v
    return matrix


def _sums(vectors: DataFrame) -> list[int]:
    """Exact sums per dimension: a task adds up high and low halves, Spark the tasks' decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list[int] = []
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                part = [(h << 32) + v for h, v in zip(high, low)]
                totals = [a + b for a, b in zip(totals, part)] if totals else part
        yield pa.record_batch([pa.array(range(len(totals)), pa.int32()), pa.array(map(str, totals), pa.string())], ["i", "s"])

    parts = vectors.select("x").mapInArrow(run, "i int, s string")
    sums = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(28,0)")).alias("s"))
    return [int(r.s) for r in sorted(sums.collect())]


@dataclass(frozen=True)
class Whitener:
    """What whitening needs: length and sums of the fit list, eigenvalues and directions of its covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray

    @property
    def varies(self) -> np.ndarray:
        """Which components vary beyond rounding; the others have no scale to be brought to."""
        return self.values > len(self.values) * EPS * self.values.max(initial=0)

    def explained(self, components: int) -> list[float | None]:
        total = self.values.sum()
        return [float(v / total) if total > 0 else None for v in self.values[:components]]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean; the whole part of the mean is taken off in whole numbers where these fit."""
        low, part = [s // self.n for s in self.sums], [(s % self.n) / self.n for s in self.sums]
        if max(map(abs, low), default=0) < 1 << 61 and np.abs(x.astype(np.float64)).max(initial=0) < 2.0**61:
            return (x - np.array(low, dtype=np.int64)).astype(np.float64) - np.array(part)
        return x.astype(np.float64) - np.array(low, dtype=np.float64) - np.array(part)

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        """Whitened coordinates; NaN in components that do not vary."""
        varies = self.varies[:components]
        scale = np.where(varies, np.sqrt(np.where(varies, self.values[:components], 1)), np.nan)
        return self.centred(x) @ (self.directions[:, :components] / scale)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) squared, exact; None where it is beyond 64 bits."""
        largest = self.n * max(np.abs(x.astype(np.float64)).max(initial=0), 1.0)
        if largest < 2.0**62 and np.square(self.n * self.centred(x)).sum(axis=1).max(initial=0) < 2.0**62:
            return np.square(self.n * x - np.array(self.sums, dtype=np.int64)).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())
        return [e if e <= LONG_MAX else None for e in exact]


def fit(distinct: DataFrame, d: int) -> Whitener:
    """Fit over a stored table of distinct vectors ``x`` of length ``d``; it must have rows."""
    n, sums = distinct.count(), _sums(distinct)
    around = Whitener(n, sums, np.zeros(d), np.zeros((d, d)))

    def products(x: np.ndarray) -> np.ndarray:
        c = around.centred(x)
        return c.T @ c

    return Whitener(n, sums, *eigen(_summed(distinct, d, products) / n))


def identity_error(distinct: DataFrame, model: Whitener, components: int) -> float:
    """Largest entry by which the whitened fit list's covariance misses the identity, as measured over it;
    components that do not vary are left out."""
    varying = np.flatnonzero(model.varies[:components])
    if not len(varying):
        return 0.0

    def products(x: np.ndarray) -> np.ndarray:
        w = np.hstack([model.project(x, components)[:, varying], np.ones((len(x), 1))])
        return w.T @ w

    moments = _summed(distinct, len(varying) + 1, products) / model.n
    covariance = moments[:-1, :-1] - np.outer(moments[:-1, -1], moments[-1, :-1])
    return float(np.abs(covariance - np.eye(len(varying))).max())


WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(
    table: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector and component, numbered from 1 by falling eigenvalue.

    Columns: vec_id, component, n (length of the fit list: each distinct whole vector once), deviation
    (exact; null beyond 64 bits), whitened (null in a component that does not vary, as with one distinct
    vector), explained (null if nothing varies), identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out, and so are empty vectors and those
    of another length than the most frequent one (of equally frequent ones the longest): they have no
    place in one covariance. Null ids and repeated rows stay; other columns are ignored. There are at
    most as many components as dimensions. An empty table gives an empty one.
    """
    spark = table.sparkSession
    rows = clean(table, id_col, vector_col).filter(F.size("x") > 0)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if usual is None:
        return spark.createDataFrame([], WHITENED)
    rows = rows.filter(F.size("x") == usual.d)
    path = scratch_dir(spark, "distinct-vectors")
    rows.select("x").distinct().write.parquet(path)
    distinct = spark.read.parquet(path)

    model, components = fit(distinct, usual.d), min(components, usual.d)
    error, explained = identity_error(distinct, model, components), model.explained(components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = batch.num_rows
            if not many:
                continue
            x = _matrix(batch)
            number = np.repeat(np.arange(many), components)
            deviation = pa.array(model.deviations(x), pa.int64())
            columns = [
                batch["vec_id"].take(pa.array(number)),
                pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), many)),
                pa.array(np.full(len(number), model.n, dtype=np.int64)),
                deviation.take(pa.array(number)),
                pa.array(model.project(x, components).ravel(), from_pandas=True),
                pa.array(explained * many, pa.float64()),
                pa.array(np.full(len(number), error)),
            ]
            yield pa.record_batch(columns, names=[c.split()[0] for c in WHITENED.split(", ")])

    return rows.mapInArrow(run, WHITENED)
