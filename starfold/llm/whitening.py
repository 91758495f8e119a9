"""Whitening of embeddings along leading components found by spectrum slicing.

Vectors become whole numbers (256ths, rounded down), so that equal vectors, their number and their sums are
exact. The covariance of the distinct vectors is summed up by Spark, centred before multiplying; it has
the size of one dimension squared and is the only thing of the data that the driver sees.

There, the number of eigenvalues above a shift is the number of positive pivots of an LDL' factorisation of
the shifted covariance (Sylvester's law of inertia). Bisecting by such counts isolates each leading
eigenvalue in an interval; Rayleigh quotient iteration converges to it cubically, and counts just below and
above the result certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored

COMPONENTS = 4
# Steps of a vector's entries.
STEPS = 256
# Entries of vectors that a task multiplies at once.
BLOCK_ENTRIES = 1_000_000
EPSILON = float(np.finfo(np.float64).eps)
LONG = 1 << 63


# --- spectrum slicing --------------------------------------------------------------------------------


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues of a symmetric matrix are positive, zero and negative.

    By LDL' with symmetric pivoting: the pivot is the largest diagonal entry, or a block of two where the
    largest entry of all lies beside the diagonal and is much larger. A block has one eigenvalue of each sign.
    """
    rest = np.array(matrix, np.float64)
    positive = negative = 0
    limit = (1 + 17**0.5) / 8
    while size := len(rest):
        diagonal = np.abs(np.diagonal(rest))
        r = int(diagonal.argmax())
        most = np.abs(rest).max()
        if most == 0 or not np.isfinite(most):
            break
        if diagonal[r] >= limit * most:
            pivot = rest[r, r]
            positive, negative = positive + int(pivot > 0), negative + int(pivot < 0)
            others = np.delete(np.arange(size), r)
            column = rest[others, r]
            rest = rest[np.ix_(others, others)] - np.outer(column / pivot, column)
        else:
            p, q = np.unravel_index(np.abs(rest - np.diag(np.diagonal(rest))).argmax(), rest.shape)
            positive, negative = positive + 1, negative + 1
            others = np.delete(np.arange(size), [p, q])
            columns = rest[np.ix_(others, [p, q])]
            rest = rest[np.ix_(others, others)] - columns @ np.linalg.solve(rest[np.ix_([p, q], [p, q])], columns.T)
    return positive, len(matrix) - positive - negative, negative


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``."""
    return inertia(matrix - shift * np.eye(len(matrix)))[0]


def _rayleigh(matrix: np.ndarray, start: np.ndarray, shift: float, found: np.ndarray, scale: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from ``start`` after two steps of inverse iteration about ``shift``.

    ``found``, rows, are eigenvectors to stay orthogonal to.
    """
    size = len(matrix)

    def step(vector: np.ndarray, at: float) -> np.ndarray:
        try:
            moved = np.linalg.solve(matrix - at * np.eye(size), vector)
        except np.linalg.LinAlgError:
            moved = np.linalg.solve(matrix - (at + EPSILON * scale) * np.eye(size), vector)
        if not np.isfinite(moved).all() or not np.linalg.norm(moved):
            return vector
        for _ in range(2):
            moved = moved / np.linalg.norm(moved)
            moved = moved - found.T @ (found @ moved)
        return moved / np.linalg.norm(moved)

    vector = step(step(start, shift), shift)
    value, least = shift, np.inf
    for _ in range(12):
        value = float(vector @ matrix @ vector)
        error = float(np.linalg.norm(matrix @ vector - value * vector))
        if error >= least / 2:
            break
        least, best = error, (value, vector)
        vector = step(vector, value)
    return best if least < np.inf else (value, vector)


def leading(matrix: np.ndarray, count: int = COMPONENTS) -> list[tuple[float, np.ndarray]]:
    """The ``count`` largest eigenvalues of a covariance, falling, with unit eigenvectors; fewer if the rest is zero.

    Each is isolated by inertia counts before it is refined, and certified by counts afterwards; if the counts
    about a result are not those of its number, its interval is halved further. Eigenvalues that are equal
    within rounding share an interval; their vectors are kept orthogonal, in a fixed but arbitrary basis.
    """
    matrix = (matrix + matrix.T) / 2
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    zero = 4 * size * EPSILON * scale
    found: list[tuple[float, np.ndarray]] = []
    rng = np.random.default_rng(size)
    starts = rng.standard_normal((count, size))
    for k in range(1, min(count, size) + 1):
        low, high = zero, scale * (1 + 8 * EPSILON) + 2 * zero
        n_low, n_high = above(matrix, low), 0
        if n_low < k:
            break
        while True:
            # narrow until the interval holds the k-th alone, or is as narrow as rounding allows
            while (n_low > k or n_high < k - 1) and high - low > zero:
                middle = (low + high) / 2
                counted = above(matrix, middle)
                low, n_low, high, n_high = (middle, counted, high, n_high) if counted >= k else (low, n_low, middle, counted)
            vectors = np.array([v for _, v in found]).reshape(-1, size)
            value, vector = _rayleigh(matrix, starts[k - 1], (low + high) / 2, vectors, scale)
            inside = low - zero <= value <= high + zero
            if high - low <= zero or inside and above(matrix, value - zero) >= k > above(matrix, value + zero):
                break
            middle = (low + high) / 2
            counted = above(matrix, middle)
            low, n_low, high, n_high = (middle, counted, high, n_high) if counted >= k else (low, n_low, middle, counted)
        found.append((value, vector))
    return found


# --- the table ---------------------------------------------------------------------------------------


def whole_numbers(vector: Column, steps: int = STEPS) -> Column:
    """Each entry times ``steps``, rounded down, as a long; one beyond a long is the nearest long."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(steps))))


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all its entries are finite numbers."""
    entries = vector.cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """The vectors ``x`` of batches as rows of whole numbers, in blocks of bounded size."""
    rows = max(1, BLOCK_ENTRIES // size)
    for batch in batches:
        entries = batch.column("x").flatten().to_numpy().reshape(-1, size)
        for at in range(0, len(entries), rows):
            yield entries[at : at + rows]


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sums of their entries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for x in _matrices(batches, size):
            # halves of 32 bits add up without overflow
            n, total = n + len(x), total + (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0)
        at = pa.array(np.arange(-1, size, dtype=np.int32))
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([at, pa.array([str(v) for v in (n, *total)]).cast(kind)], ["at", "total"])

    parts = fit.select("x").mapInArrow(work, "at int, total decimal(38,0)")
    found = dict(parts.groupBy("at").agg(F.sum("total")).collect())
    return int(found.get(-1, 0)), [int(found.get(k, 0)) for k in range(size)]


def _covariance(fit: DataFrame, size: int, n: int, means: np.ndarray) -> np.ndarray:
    """The covariance of the vectors, divisor ``n``, each centred before it is multiplied."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for x in _matrices(batches, size):
            centred = x - means
            total += centred.T @ centred
        i, j = np.triu_indices(size)
        place = pa.array((i * size + j).astype(np.int64))
        yield pa.RecordBatch.from_arrays([place, pa.array(total[i, j] / n)], ["place", "part"])

    parts = fit.select("x").mapInArrow(work, "place long, part double")
    sums = parts.groupBy("place").agg(F.sum("part").alias("part")).toArrow()
    matrix = np.zeros(size * size)
    matrix[sums.column("place").to_numpy()] = sums.column("part").to_numpy()
    matrix = matrix.reshape(size, size)
    return np.triu(matrix) + np.triu(matrix, 1).T


@dataclass
class Whitening:
    """What a fit has found: ``axes`` are the components, a row each, already divided by their deviation."""

    n: int
    sums: list[int]
    means: np.ndarray
    axes: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.means) @ self.axes.T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n * x - S) squared, exact."""
        reach = max(self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))), 1) + max(map(abs, self.sums), default=0)
        if reach * reach * max(1, x.shape[1]) < LONG:
            apart = x * self.n - np.array(self.sums, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        apart = x.astype(object) * self.n - np.array(self.sums, object)
        return (apart * apart).sum(axis=1).tolist()


def fit_whitening(fit: DataFrame, size: int, count: int = COMPONENTS) -> Whitening:
    """Fit to the distinct vectors ``x``, ``size`` long entries each."""
    n, sums = _sums(fit, size)
    means = np.array([s / n if n else 0.0 for s in sums])
    covariance = _covariance(fit, size, n, means) if n else np.zeros((size, size))
    found = leading(covariance, count)
    trace = float(np.trace(covariance))
    axes = np.array([vector / np.sqrt(value) for value, vector in found]).reshape(-1, size)
    return Whitening(n, sums, means, axes, np.array([value / trace for value, _ in found]))


def _identity_error(fit: DataFrame, size: int, fitted: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    many = len(fitted.axes)
    names = [f"w{k}" for k in range(many)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _matrices(batches, size):
            yield pa.RecordBatch.from_arrays([pa.array(w) for w in np.ascontiguousarray(fitted.project(x).T)], names)

    whitened = fit.select("x").mapInArrow(work, ", ".join(f"{name} double" for name in names))
    entries = [(i, j) for i in range(many) for j in range(i, many)]
    row = whitened.agg(*[F.covar_pop(names[i], names[j]) for i, j in entries]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(row, entries, strict=True))


def whiten(vectors: DataFrame, count: int = COMPONENTS, steps: int = STEPS) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding) and component: vec_id, component, n, deviation,
    whitened, explained, identity_error, deviation_digits.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, as are rows whose vector
    has not the table's usual length (the most frequent, of equally frequent ones the greatest). Repeated rows
    each have their own result and count once in the fit. ``deviation`` is null beyond the range of a long;
    ``deviation_digits`` has it as a text at any size. Only components with a variance above rounding
    are returned: none where all vectors are equal, so that table's result is empty, as is that of an
    empty one. Components of equal variance are orthogonal but otherwise arbitrary. Other columns are not read.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double, deviation_digits string"
    )
    good = vectors.where(usable(F.col("embedding")) & (F.size("embedding") > 0))
    good = good.select("vec_id", whole_numbers(F.col("embedding"), steps).alias("x"))
    usual = good.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if usual is None:
        return spark.createDataFrame([], schema)
    size = usual["size"]
    good = good.where(F.size("x") == size)
    fit = stored(good.select("x").distinct(), "distinct-vectors")
    fitted = fit_whitening(fit, size, count)
    many = len(fitted.axes)
    if not many:
        return spark.createDataFrame([], schema)
    error = _identity_error(fit, size, fitted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _matrices([batch], size):
                ids = batch.column("vec_id").slice(at, len(x)).take(pa.array(np.repeat(np.arange(len(x)), many)))
                at += len(x)
                apart = fitted.deviations(x)
                exact = pa.array([v if v < LONG else None for v in apart for _ in range(many)], pa.int64())
                digits = pa.array([str(v) for v in apart for _ in range(many)])
                columns = [
                    ids, pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * many, fitted.n)), exact, pa.array(fitted.project(x).ravel()),
                    pa.array(np.tile(fitted.explained, len(x))), pa.array(np.full(len(x) * many, error)), digits,
                ]
                yield pa.RecordBatch.from_arrays(columns, schema_names)

    schema_names = [part.split()[0] for part in schema.split(", ")]
    return good.mapInArrow(work, schema)
