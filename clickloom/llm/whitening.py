"""Embedding whitening by slicing the spectrum of the covariance.

Entries become integers, so means and covariance come from exact integer sums that do not
depend on how the rows were dealt out. Tasks sum over their rows; the driver gets d sums and
d x d products, whatever the number of rows, and finds the leading eigenvalues there. The
number of positive pivots of the LDL' factors of V - s I is the number of eigenvalues above
s. Such counts bisect the spectrum until an interval holds one eigenvalue, Rayleigh quotient
iteration then converges cubically to it, and counts on both sides certify its number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
#: Entries from here on count as non-finite: their exact products leave decimal(38, 0).
LARGEST = float(1 << 40)
COMPONENTS = 8
ROWS = 2048  # of one product of matrices in a task
EPS = float(np.finfo(float).eps)


# ---- linear algebra of one d x d matrix


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Positive, negative and zero pivots of LDL' with diagonal pivoting of one and two rows.

    Swaps are symmetric and blocks are eliminated by congruence, so the signs are those of the
    eigenvalues.
    """
    a = np.array(matrix, dtype=float)
    n, k = len(a), 0
    share = (1 + math.sqrt(17)) / 8  # bounds the growth of either kind of pivot alike
    signs = [0, 0, 0]

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        most = below.max() if len(below) else 0.0
        size = 1
        if max(abs(a[k, k]), most) == 0:
            signs[2] += 1
            k += 1
            continue
        if abs(a[k, k]) < share * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = row.max()
            if abs(a[k, k]) * other < share * most * most:
                if abs(a[r, r]) >= share * other:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        block = a[k : k + size, k : k + size]
        if size == 1:
            signs[0 if block[0, 0] > 0 else 1] += 1
        elif block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0] < 0:
            signs[0] += 1
            signs[1] += 1
        else:
            signs[0 if block[0, 0] + block[1, 1] > 0 else 1] += 2
        rest = a[k + size :, k : k + size]
        a[k + size :, k + size :] -= rest @ np.linalg.solve(block, rest.T)
        k += size
    return signs[0], signs[1], signs[2]


class Slices:
    """Counts of the eigenvalues above shifts, each made once."""

    def __init__(self, matrix: np.ndarray):
        radius = np.abs(matrix).sum(axis=1) - np.abs(matrix.diagonal())
        self.matrix = matrix
        self.size = max(float(np.abs(matrix).sum(axis=1).max()), 1e-250)
        margin = 8 * EPS * self.size
        low = float((matrix.diagonal() - radius).min()) - margin
        high = float((matrix.diagonal() + radius).max()) + margin
        self.known = {low: len(matrix), high: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            shifted = self.matrix - shift * np.eye(len(self.matrix))
            self.known[shift] = inertia(shifted)[0]
        return self.known[shift]

    def bracket(self, number: int) -> tuple[float, float]:
        """Nearest known shifts around eigenvalue ``number`` (from 1, largest first)."""
        low = max(s for s, n in self.known.items() if n >= number)
        high = min(s for s, n in self.known.items() if n < number and s > low)
        return low, high


def _orthogonal(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in found:
            x = x - (v @ x) * v
    return x / np.linalg.norm(x)


def rayleigh(
    matrix: np.ndarray, shift: float, found: list[np.ndarray], size: float, seed: int
) -> tuple[float, np.ndarray, float]:
    """Eigenvalue, unit vector and residual by Rayleigh quotient iteration from ``shift``."""
    eye = np.eye(len(matrix))

    def solve(s: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(matrix - s * eye, x)
        except np.linalg.LinAlgError:
            y = np.full(len(x), np.nan)
        if not np.isfinite(y).all():
            y = np.linalg.solve(matrix - (s + 4 * EPS * size) * eye, x)
        return _orthogonal(y / np.abs(y).max(), found)

    x = _orthogonal(np.random.default_rng(seed).standard_normal(len(matrix)), found)
    for _ in range(2):
        x = solve(shift, x)
    best = (math.inf, x, 0.0)
    for _ in range(12):
        value = float(x @ matrix @ x)
        residual = float(np.linalg.norm(matrix @ x - value * x))
        if residual >= best[0]:
            break
        best = (residual, x, value)
        x = solve(value, x)
    return best[2], best[1], best[0]


class Spectrum(NamedTuple):
    values: np.ndarray  # falling
    vectors: np.ndarray  # one column each
    counts: list[tuple[int, int]]  # eigenvalues certainly above, and at least at, each value


def leading(matrix: np.ndarray, k: int) -> Spectrum:
    """The ``k`` largest eigenvalues of a symmetric matrix with unit eigenvectors.

    Equal eigenvalues get any orthonormal basis of their space.
    """
    slices = Slices(matrix)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    counts = []
    tight = 64 * EPS * slices.size
    for number in range(1, k + 1):
        while True:
            low, high = slices.bracket(number)
            narrow = high - low <= tight
            if slices.above(low) - slices.above(high) == 1 or narrow:
                value, vector, residual = rayleigh(
                    matrix, (low + high) / 2, vectors, slices.size, number
                )
                margin = max(tight, 4 * residual)
                inside = low - tight <= value <= high + tight
                if inside and residual <= 1e3 * tight:
                    over, upto = slices.above(value + margin), slices.above(value - margin)
                    if over < number <= upto:
                        break
                if narrow:
                    raise ArithmeticError(f"no certificate for eigenvalue {number}")
            slices.above((low + high) / 2)
        values.append(value)
        vectors.append(vector)
        counts.append((over, upto))
    stacked = np.array(vectors).T if vectors else np.zeros((len(matrix), 0))
    return Spectrum(np.array(values), stacked, counts)


# ---- sums over all rows


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part."""
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = plain.filter(
        F.col("embedding").isNotNull()
        & F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < LARGEST))
    )
    return fine


def dimension(fine: DataFrame) -> int:
    """The most frequent length; the larger of equally frequent ones."""
    order = fine.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    first = order.first()
    return first["d"] if first else 0


def whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """Integers of a batch, one row a vector."""
    c = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Sums of columns as Python integers."""
    largest = int(np.abs(x).max(initial=0))
    fits = largest * max(len(x), 1) < 1 << 62
    return (x.sum(axis=0) if fits else x.astype(object).sum(axis=0)).astype(object)


def exact_products(z: np.ndarray) -> np.ndarray:
    """z'z as Python integers; doubles multiply as long as every sum is exact in them."""
    largest = int(np.abs(z).max(initial=0))
    if largest * largest * max(len(z), 1) < 1 << 53:
        f = z.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    w = z.astype(object)
    return w.T @ w


def _decimals(numbers) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in numbers], pa.decimal128(38, 0))


def sums(fine: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                total = total + exact_sum(whole(batch, d))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), _decimals(total), pa.array([n] * d, pa.int64())],
            names=["i", "total", "n"],
        )

    parts = fine.select("embedding").mapInArrow(run, "i int, total decimal(38,0), n long")
    rows = parts.groupBy("i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    by = {r["i"]: r for r in rows}  # d rows
    return by[0]["n"], [int(by[i]["total"]) for i in range(d)]


def covariance(fine: DataFrame, n: int, total: list[int]) -> tuple[np.ndarray, list[int], list[int]]:
    """Covariance, the whole part of each mean, and n times what is left of it.

    Every vector is centred by the nearest integer to the mean before it is multiplied; what
    the mean has beyond it (at most a half) is taken off exactly afterwards.
    """
    d = len(total)
    middle = [(2 * s + n) // (2 * n) for s in total]
    left = [s - n * m for s, m in zip(total, middle)]
    upper = np.triu_indices(d)
    centre = np.array(middle, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((d, d), object)
        for batch in batches:
            z = whole(batch, d) - centre if batch.num_rows else np.zeros((0, d), np.int64)
            for at in range(0, len(z), ROWS):
                products = products + exact_products(z[at : at + ROWS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), _decimals(products[upper])],
            names=["i", "j", "total"],
        )

    parts = fine.select("embedding").mapInArrow(run, "i int, j int, total decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()  # d (d + 1) / 2
    v = np.zeros((d, d))
    for i, j, g in rows:
        v[i, j] = v[j, i] = (n * int(g) - left[i] * left[j]) / (n * n)
    return v, middle, left


class Whitening(NamedTuple):
    n: int
    middle: np.ndarray  # integers nearest to the means
    left: list[int]  # n * mean - n * middle
    values: np.ndarray  # falling eigenvalues
    vectors: np.ndarray  # unit eigenvectors, one column each
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding."""
        return self.values > len(self.vectors) * EPS * self.trace

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of integer vectors; NaN where there is no variance."""
        rest = np.array([r / self.n for r in self.left])
        scale = np.where(self.usable, np.sqrt(np.where(self.usable, self.values, 1.0)), np.nan)
        return ((x - self.middle) - rest) @ self.vectors / scale

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact, in Python integers."""
        z, n = x - self.middle, self.n
        largest = int(np.abs(z).max(initial=0))
        more = max((abs(r) for r in self.left), default=0)
        if largest * max(largest, more) * z.shape[1] >= 1 << 62:
            z = z.astype(object)
        squares = (z * z).sum(axis=1).astype(object)
        crossed = (z * np.array(self.left, z.dtype)).sum(axis=1).astype(object)
        constant = sum(r * r for r in self.left)
        return list(n * n * squares - 2 * n * crossed + constant)


def fit(fine: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """Of all rows of ``fine``, which have ``d`` entries; None without rows or entries."""
    if not d:
        return None
    n, total = sums(fine, d)
    v, middle, left = covariance(fine, n, total)
    found = leading(v, min(components, d))
    return Whitening(
        n, np.array(middle, np.int64), left, found.values, found.vectors, float(np.trace(v))
    )


def identity_error(fine: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k, d = int(model.usable.sum()), len(model.middle)
    if not k:
        return None
    places = [(i, j) for i in range(k) for j in range(i, k)] + [(i, -1) for i in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = model.apply(whole(batch, d))[:, :k]
                first += w.sum(axis=0)
                second += w.T @ w
        got = [first[i] if j < 0 else second[i, j] for i, j in places]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in places], pa.int32()), pa.array([p[1] for p in places], pa.int32()),
             pa.array(got, pa.float64())],
            names=["i", "j", "total"],
        )

    parts = fine.select("embedding").mapInArrow(run, "i int, j int, total double")
    total = {(r["i"], r["j"]): r["total"] / model.n for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    # The whitened rows are centred already; their mean is what rounding left.
    return max(
        abs(total[i, j] - total[i, -1] * total[j, -1] - (i == j)) for i in range(k) for j in range(i, k)
    )


SCHEMA = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector that takes part and each component, from 1 by falling variance.

    Vectors (``vec_id, embedding``) that are null or hold null or non-finite entries take no
    part, nor do entries of 2^40 or more and vectors of another length than the most frequent
    one, which have no place in one covariance. Repeated rows count and return repeatedly;
    null ids stay null; other columns are ignored. A component without variance has a null
    ``whitened`` and no part in ``identity_error``; ``explained`` is null if nothing varies.
    With fewer dimensions than components there are as many components as dimensions.
    """
    spark = vectors.sparkSession
    fine = usable(vectors)
    d = dimension(fine)
    fine = fine.filter(F.size("embedding") == d)
    model = fit(fine, d, components)
    if model is None:
        return spark.createDataFrame([], SCHEMA)
    error = identity_error(fine, model)
    k, alive = len(model.values), model.usable
    explained = [max(float(e), 0.0) / model.trace if model.trace > 0 else None for e in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, rows = whole(batch, d), batch.num_rows
            w = model.apply(x).ravel()
            own = np.repeat(np.arange(rows), k)
            deviation = _decimals(model.deviation(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(own)).cast(pa.int64()),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n)),
                    deviation.take(pa.array(own)),
                    pa.array(w, mask=~np.tile(alive, rows)),
                    pa.array(explained * rows, pa.float64()),
                    pa.array([error] * (rows * k), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return fine.mapInArrow(run, SCHEMA)


def as_long(number: Column) -> Column:
    """Null where it does not fit."""
    return number.try_cast("long")
