"""Whitening of embeddings: principal components of their covariance, scaled to unit variance.

The covariance is summed over partitions about the exact mean and comes to the driver as one matrix, whose size depends
on the dimension only. There it is reduced to a tridiagonal matrix by Householder reflections; bisection by Sturm counts
finds the leading eigenvalues, inverse iteration their vectors, made orthogonal within clusters of close values. Tasks
get the components with their code and project what they read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
LARGEST = float(1 << 46)  # entries from here on take no part: their sums would not be exact
RANK = 1e-10  # an eigenvalue below this share of the highest is taken for zero
CLUSTER = 1e-3  # eigenvalues closer than this share of the norm are made orthogonal
ROWS = 4_096
_HALF = 1 << 24


# ---- Eigenvectors of a symmetric matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal and the Householder vectors that turn the matrix into them."""
    a = matrix.astype(np.float64, copy=True)
    size = len(a)
    reflectors = []
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length == 0:
            reflectors.append(np.zeros(size - k - 1))
            continue
        v[0] += length if v[0] >= 0 else -length
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        column = a[k + 1 :, k] - 2 * v * (v @ a[k + 1 :, k])
        a[k + 1 :, k] = a[k, k + 1 :] = column
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_counts(diagonal: np.ndarray, below: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """For each shift, how many eigenvalues of the tridiagonal matrix are less."""
    least = np.finfo(float).tiny / np.finfo(float).eps
    counts = np.zeros(len(shifts), dtype=np.int64)
    pivot = np.ones(len(shifts))
    for place, value in enumerate(diagonal):
        pivot = value - shifts - (below[place - 1] ** 2 / pivot if place else 0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        counts += pivot < 0
    return counts


def leading_values(diagonal: np.ndarray, below: np.ndarray, count: int) -> np.ndarray:
    """The highest eigenvalues, falling, each by bisection until no number lies between its bounds."""
    size = len(diagonal)
    around = np.concatenate([[0], np.abs(below)]) + np.concatenate([np.abs(below), [0]])
    low = np.full(count, (diagonal - around).min())
    high = np.full(count, (diagonal + around).max())
    margin = np.finfo(float).eps * size * max(abs(low[0]), abs(high[0]))
    low, high = low - margin, high + margin
    wanted = size - np.arange(count)  # the k-th highest is the (size - k + 1)-th lowest
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        less = sturm_counts(diagonal, below, middle) >= wanted
        high, low = np.where(less, middle, high), np.where(less, low, middle)


def _solve(diagonal: np.ndarray, below: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """Solve (T - shift) y = right by elimination with row exchanges; a zero pivot becomes a tiny one."""
    size = len(diagonal)
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(below).max(initial=0), np.finfo(float).tiny)
    main, first, second = (diagonal - shift).tolist(), below.tolist() + [0.0], [0.0] * size
    under, y = below.tolist(), right.tolist()
    for k in range(size - 1):
        if abs(under[k]) > abs(main[k]):
            main[k], under[k] = under[k], main[k]
            first[k], main[k + 1] = main[k + 1], first[k]
            second[k], first[k + 1] = first[k + 1], 0.0
            y[k], y[k + 1] = y[k + 1], y[k]
        if main[k] == 0:
            main[k] = tiny
        factor = under[k] / main[k]
        main[k + 1] -= factor * first[k]
        first[k + 1] -= factor * second[k]
        y[k + 1] -= factor * y[k]
    for k in range(size - 1, -1, -1):
        value = y[k]
        if k + 1 < size:
            value -= first[k] * y[k + 1]
        if k + 2 < size:
            value -= second[k] * y[k + 2]
        y[k] = value / (main[k] if abs(main[k]) > tiny else tiny)
        if abs(y[k]) > 1e200:  # only the direction counts
            y = [value * 1e-200 for value in y]
    return np.array(y)


def inverse_iteration(diagonal: np.ndarray, below: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit eigenvector for each value, in columns; those of close values orthogonal to each other."""
    size = len(diagonal)
    norm = max((np.abs(diagonal) + np.concatenate([np.abs(below), [0]])).max(), np.finfo(float).tiny)
    draw = np.random.default_rng(size)
    vectors = np.zeros((size, len(values)))
    begin = 0
    for place, value in enumerate(values):
        if place and values[place - 1] - value > CLUSTER * norm:
            begin = place
        # Values that are the same number are solved a little apart.
        shift = value - 4 * np.finfo(float).eps * norm * int((values[begin:place] - value <= 8 * np.finfo(float).eps * norm).sum())
        y = draw.standard_normal(size)
        others = vectors[:, begin:place]
        for _ in range(8):
            y = _solve(diagonal, below, shift, y / np.linalg.norm(y))
            y /= np.linalg.norm(y)
            for _ in range(2):
                y -= others @ (others.T @ y)
            kept = np.linalg.norm(y)
            if kept < 1e-8:  # nothing new in it
                y = draw.standard_normal(size)
                continue
            y /= kept
            residual = diagonal * y - value * y
            residual[1:] += below * y[:-1]
            residual[:-1] += below * y[1:]
            if np.abs(residual).max() <= 4 * np.finfo(float).eps * norm:
                break
        vectors[:, place] = y
    return vectors


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest eigenvalues, falling, and their unit vectors in columns; the largest entry of each is positive.

    Values too small to be told from zero are left out.
    """
    count = min(count, len(matrix))
    if count == 0:
        return np.zeros(0), np.zeros((0, 0))
    scale = np.abs(matrix).max()
    if scale == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, below, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, below, count)
    values = values[values > RANK * values[0]]
    vectors = inverse_iteration(diagonal, below, values)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values * scale, vectors


# ---- Sums over partitions


def usable(vector: Column) -> Column:
    """Neither null nor empty, with finite entries only, none of LARGEST or more."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(LARGEST)))
    return F.coalesce(vector.isNotNull() & fits & (F.size(vector) > 0), F.lit(False))


def _grids(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows of one length and their integers, at most ROWS at a time."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.asarray(column.value_lengths()).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for begin in range(0, len(rows), ROWS):
            part = rows[begin : begin + ROWS]
            grid = values[starts[part][:, None] + np.arange(length)]
            yield part, np.floor(grid * SCALE).astype(np.int64) + SHIFT


def _sum_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (length, place, n, high, low) of a partition; the sum of a place is high * _HALF + low."""
    sums: dict[int, list] = {}
    for batch in batches:
        for _, x in _grids(batch.column(0)):
            held = sums.setdefault(x.shape[1], [0, np.zeros(x.shape[1], dtype=np.int64), np.zeros(x.shape[1], dtype=np.int64)])
            held[0] += len(x)
            held[1] += (x // _HALF).sum(axis=0)
            held[2] += (x % _HALF).sum(axis=0)
    for length, (n, high, low) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(length, length), pa.int64()), pa.array(np.arange(length), pa.int64()),
                pa.array(np.full(length, n), pa.int64()), pa.array(high), pa.array(low),
            ],
            ["length", "place", "n", "high", "low"],
        )


def _cells(total: np.ndarray) -> pa.RecordBatch:
    """The upper triangle of a matrix as rows (cell, value)."""
    size = len(total)
    row, column = np.triu_indices(size)
    cells = pa.array(row.astype(np.int64) * size + column)
    return pa.RecordBatch.from_arrays([cells, pa.array(total[row, column])], ["cell", "value"])


def _products(mean: np.ndarray, axes: np.ndarray | None = None, rest: np.ndarray | None = None):
    """Sums of products of the centred rows of a partition, projected on `axes` if given and centred again by `rest`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _grids(batch.column(0)):
                rows = x - mean
                rows = rows if axes is None else rows @ axes - rest
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            yield _cells(total)

    return work


def _matrix(rows: DataFrame, work, size: int) -> np.ndarray:
    """Sum the partitions' triangles; `size` squared numbers come to the driver, whatever the rows."""
    cells = rows.mapInArrow(work, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = cells.toPandas()
    total = np.zeros(size * size)
    total[found["cell"].to_numpy()] = found["value"].to_numpy()
    total = total.reshape(size, size)
    return np.triu(total) + np.triu(total, 1).T


@dataclass(frozen=True)
class Whitening:
    """What a projection needs: rows fitted on, exact sums, components in columns, eigenvalues and their shares."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(total, self.n)) for total in self.sums])

    @property
    def axes(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def fit(vectors: DataFrame, embedding: str = "embedding", count: int = COMPONENTS) -> Whitening | None:
    """Fit on all usable vectors of the length that most have (of equally many, the longer); None without any."""
    rows = vectors.where(usable(F.col(f"`{embedding}`"))).select(F.col(f"`{embedding}`").alias("v"))
    schema = "length bigint, place bigint, n bigint, high bigint, low bigint"
    wide = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("high", "low")]
    sums = rows.mapInArrow(_sum_columns, schema).groupBy("length", "place").agg(F.sum("n").alias("n"), *wide)
    # One row a length, with one pair of sums for each of its places.
    places = F.array_sort(F.collect_list(F.struct("place", "high", "low"))).alias("sums")
    best = sums.groupBy("length").agg(F.max("n").alias("n"), places).orderBy(F.desc("n"), F.desc("length")).first()
    if best is None:
        return None
    size, n = best.length, best.n
    totals = tuple(int(row.high) * _HALF + int(row.low) for row in best.sums)
    exact = [Fraction(total, n) for total in totals]
    mean = np.array([float(value) for value in exact])
    rows = rows.where(F.size("v") == size)
    # What the mean as a double lacks is taken off afterwards, so that products are about the exact mean.
    left = np.array([float(value - Fraction(float(near))) for value, near in zip(exact, mean)])
    covariance = _matrix(rows, _products(mean), size) / n - np.outer(left, left)
    values, components = leading_components(covariance, count)
    if not len(values):
        return Whitening(n, totals, components, values, values, 0.0)
    axes = components / np.sqrt(values)
    again = _matrix(rows, _products(mean, axes, left @ axes), len(values)) / n
    error = float(np.abs(again - np.eye(len(values))).max())
    return Whitening(n, totals, components, values, values / np.trace(covariance), error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...], mean: np.ndarray) -> list[int | None]:
    """Sums of (n x - S)^2, exact; None where a long does not hold it."""
    farthest = float(np.abs(x - mean).max(initial=0)) * n * 1.01 + 2
    if farthest**2 * x.shape[1] < 2**62 and float(np.abs(x).max(initial=0)) * n < 2**62:
        return ((x * n - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    found = [sum((n * value - total) ** 2 for value, total in zip(row, sums)) for row in x.tolist()]
    return [value if value < 1 << 63 else None for value in found]


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), one for each vector and component.

    Entries c count as the integers floor(64 c) + 1,000,000. A null or empty vector, one with a null, non-finite or
    huge entry (2^46 or more), and one of another length than most vectors have gives no row; where no vector is left, or all
    are equal, the result is empty. Components without variance are left out, so that fewer vectors than dimensions give
    fewer components. Rows with a null or repeated id count like any others; other columns are not read. `deviation` is
    null where a long does not hold it.
    """
    key = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"))
    kind = key.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    model = fit(vectors, embedding, count)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    mean, axes, size, width = model.mean, model.axes, len(model.sums), len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _grids(batch.column(1)):
                rows = len(part)
                ids = batch.column(0).take(pa.array(np.repeat(part, width)))
                deviation = pa.array(_deviations(x, model.n, model.sums, mean), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * width, model.n)),
                        deviation.take(pa.array(np.repeat(np.arange(rows), width))),
                        pa.array(((x - mean) @ axes).ravel()),
                        pa.array(np.tile(model.explained, rows)),
                        pa.array(np.full(rows * width, model.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    column = F.col(f"`{embedding}`")
    rows = vectors.where(usable(column) & (F.size(column) == size))
    return rows.select(F.col(f"`{vec_id}`").alias("vec_id"), column.alias("v")).mapInArrow(project, schema)
