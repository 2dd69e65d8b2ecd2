"""Whitening of embeddings with eigenvectors that are right to double precision.

The covariance is summed exactly, in integers, by Spark. Its eigenvectors are first found in single precision and then
corrected by the matrix-multiplication iteration of Ogita and Aishima in extended precision; eigenvalues too close for
the iteration are separated by solving the small problem inside of their cluster, shifted by the cluster's mean.

What the driver holds is bounded by the number of dimensions: sums and covariance, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A vector's entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries beyond this count as this, so that every entry is a long.
LARGEST = 2.0**30
#: Steps of the correction; each doubles the digits, and clusters cost some more.
MOST_STEPS = 40

_EXTENDED = np.longdouble


# --- vectors ---------------------------------------------------------------------------------------------------------


def entries(column: pa.Array, dimensions: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer entries) of the usable vectors of a list column: one pair for each length, or for one length alone.

    A vector is usable unless it is null or empty or holds an entry that is null or not finite.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    values = column.values
    numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
    sizes = np.diff(offsets)
    usable = (odd[offsets[1:]] == odd[offsets[:-1]]) & (sizes > 0)
    if column.null_count:
        usable &= ~column.is_null().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[usable]) if dimensions is None else [dimensions]:
        rows = np.flatnonzero(usable & (sizes == size))
        if len(rows):
            picked = numbers[offsets[rows][:, None] + np.arange(size)]
            scaled = np.floor(SCALE * np.clip(picked, -LARGEST, LARGEST))
            yield rows, scaled.astype(np.int64) + SHIFT


def _limbs(values) -> tuple[np.ndarray, np.ndarray]:
    """Integers as high * 2**32 + low, so that sums of many stay exact."""
    high = values >> 32
    return high.astype(np.int64), (values - (high << 32)).astype(np.int64)


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact y.T @ y of integers: by floating-point blocks whose sums stay below 2**53, else by whole numbers."""
    most = int(np.abs(y).max(initial=1))
    rows = (1 << 53) // (most * most)
    if rows < 16:
        big = y.astype(object)
        return big.T @ big
    total = np.zeros((y.shape[1], y.shape[1]), np.int64)
    for k in range(0, len(y), rows):
        part = y[k : k + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


# --- eigenvectors ----------------------------------------------------------------------------------------------------


def _split(values: list[list[Fraction]]) -> np.ndarray:
    """Fractions as extended-precision numbers: the nearest double, and what is left."""
    high = np.array([[float(v) for v in row] for row in values])
    low = np.array([[float(v - Fraction(h)) for v, h in zip(row, hs)] for row, hs in zip(values, high.tolist())])
    return high.astype(_EXTENDED) + low.astype(_EXTENDED)


def _clusters(order: np.ndarray, values: np.ndarray, width: float) -> list[np.ndarray]:
    """Runs of neighbouring eigenvalues, each no further than ``width`` from the next."""
    ends = np.flatnonzero(np.diff(values[order]) > width) + 1
    return np.split(order, ends)


def eigenvectors(matrix: np.ndarray, steps: int = MOST_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix given in extended precision.

    Start: single precision. A step with X takes R = I - X'X and S = X'AX in extended precision; l_i = S_ii / (1 - R_ii)
    are the eigenvalues, and X + XE is closer to the eigenvectors, where E_ij = (S_ij + l_j R_ij) / (l_j - l_i). Where
    two eigenvalues are closer than the error of S lets one tell, E_ij = R_ij / 2, which only keeps X orthogonal; the
    vectors of such a cluster are then turned by the eigenvectors of X'(A - mI)X, m the cluster's mean: small numbers,
    in which the differences show. So clusters shrink from step to step until all differences that extended precision
    can see are resolved; equal eigenvalues keep some orthogonal basis of their space.
    """
    size = len(matrix)
    scale = np.abs(matrix).max(initial=0)
    if not size or scale == 0:
        return np.zeros(size, _EXTENDED), np.eye(size, dtype=_EXTENDED)
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_EXTENDED)
    eye, eps = np.eye(size, dtype=_EXTENDED), float(np.finfo(_EXTENDED).eps)
    last = np.inf
    for _ in range(steps):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else rounding over small gaps would bend X
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        reach = 2 * float(np.linalg.norm(off.astype(np.float64)) + np.linalg.norm(r.astype(np.float64)))
        width = max(reach, 4 * size * eps)
        order = np.argsort(values)
        apart = values[None, :] - values[:, None]
        near = np.abs(apart) <= width
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, apart))
        x = x + x @ e
        turned = 0.0
        for own in _clusters(order, values, width):
            if len(own) > 1:
                part = x[:, own]
                inner = part.T @ (a @ part) - values[own].mean() * (part.T @ part)
                inner = (inner + inner.T) / 2
                level = float(np.abs(inner).max())
                if level > 8 * size * eps:  # else all of it is rounding: equal eigenvalues
                    turn = np.linalg.eigh((inner / level).astype(np.float64))[1].astype(_EXTENDED)
                    x[:, own] = part @ turn
                    turned = max(turned, float(np.abs(turn - np.diag(np.diag(turn))).max()))
        change = float(np.abs(e).max()) + (turned if turned > 1e-12 else 0.0)
        if change < 64 * size * eps or last / 4 < change < 1e-6:  # done, or down to rounding over the smallest gap
            break
        last = change
    x = x @ (1.5 * eye - 0.5 * (x.T @ x))  # what is left of a lack of orthogonality is squared
    values = np.array([c @ (a @ c) / (c @ c) for c in x.T])
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    return values[order] * scale, x


# --- fit and transform -----------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """n vectors with exact sums of their integer entries, and eigenvalues (falling) with unit eigenvectors (columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    column: str = "embedding"
    #: x less ``middle`` less ``rest`` is x less its mean.
    middle: np.ndarray = field(init=False)
    rest: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        self.middle = np.array(middle, np.int64)
        self.rest = np.array([(s - self.n * m) / self.n for s, m in zip(self.sums, middle)])

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def rank(self) -> int:
        """Number of eigenvalues that are more than rounding."""
        return int((self.values > self.dimensions * np.finfo(_EXTENDED).eps * max(self.values[0], 0)).sum()) if self.dimensions else 0

    def explained(self, components: int) -> list[float | None]:
        return [float(v / _EXTENDED(self.trace)) if self.trace else None for v in self.values[:components]]

    def projection(self, components: int) -> np.ndarray:
        """Columns take a centred vector to its whitened components; NaN where the eigenvalue is zero."""
        used = min(components, self.dimensions)
        scale = np.full(used, np.nan, _EXTENDED)
        alive = min(used, self.rank())
        scale[:alive] = 1 / np.sqrt(self.values[:alive])
        return (self.vectors[:, :used] * scale).astype(np.float64)

    def whiten(self, x: np.ndarray, projection: np.ndarray) -> np.ndarray:
        return ((x - self.middle) - self.rest) @ projection

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """Sum over the dimensions of (n * x - sums)**2, exactly."""
        n = self.n
        most = n * int(np.abs(x - self.middle).max(initial=0)) + n
        wide = most * most * self.dimensions < 1 << 63
        y = (x - self.middle) if wide else (x - self.middle).astype(object)
        left = np.array([n * int(m) - s for m, s in zip(self.middle, self.sums)], np.int64 if wide else object)
        return ((n * y + left) ** 2).sum(axis=1)


def _each_batch(df: DataFrame, column: str, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch) if batch.num_rows else None
            if made is not None:
                yield made

    return df.select(F.col(f"`{column}`").cast("array<double>").alias("v")).mapInArrow(run, schema)


def _sums(df: DataFrame, column: str) -> tuple[int, list[int]] | None:
    """Number and sums of the usable vectors of the most frequent length (of equally frequent ones the longest)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = [x for _, x in entries(batch.column("v"))]
        if not parts:
            return None
        columns = zip(*((np.full(x.shape[1], x.shape[1]), np.arange(x.shape[1]), np.full(x.shape[1], len(x)), x.sum(axis=0)) for x in parts))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["size", "at", "n", "s"])

    summed = _each_batch(df, column, "size long, at long, n long, s long", work).groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    by_size = summed.groupBy("size").agg(F.max("n").alias("n"), F.collect_list(F.struct("at", "s")).alias("sums"))
    best = by_size.orderBy(F.desc("n"), F.desc("size")).first()
    return best and (best.n, [int(p.s) for p in sorted(best.sums)])


def _products(df: DataFrame, column: str, middle: np.ndarray) -> dict[tuple[int, int], int]:
    """Exact sums of products of entries less ``middle``, of dimensions i <= j; by Spark, one value for each pair."""
    upper = np.triu_indices(len(middle))
    i, j = pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, room = None, 1 << 62
        for batch in batches:
            for _, x in entries(batch.column("v"), len(middle)) if batch.num_rows else ():
                part = _gram(x - middle)[upper]
                most = int(np.abs(part).max())
                if part.dtype == object or most > room:  # what was gathered goes out before it could overflow
                    if total is not None:
                        yield rows(total)
                    total, room = None, 1 << 62
                if part.dtype == object:
                    yield rows(part)
                else:
                    total, room = (part if total is None else total + part), room - most
        if total is not None:
            yield rows(total)

    def rows(total: np.ndarray) -> pa.RecordBatch:
        high, low = _limbs(total)
        return pa.RecordBatch.from_arrays([i, j, pa.array(high), pa.array(low)], names=["i", "j", "high", "low"])

    vectors = df.select(F.col(f"`{column}`").cast("array<double>").alias("v"))
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("high", "low")]
    found = vectors.mapInArrow(run, "i int, j int, high long, low long").groupBy("i", "j").agg(*whole).toArrow()
    columns = (found.column(c).to_pylist() for c in ("i", "j", "high", "low"))
    return {(a, b): (int(high) << 32) + int(low) for a, b, high, low in zip(*columns)}


def fit_whitening(df: DataFrame, column: str = "embedding") -> Whitening | None:
    """Fit to all usable vectors of a list column, or None if there are none.

    Left out are vectors that are null or empty, that hold null or non-finite entries, or that have another length than
    most of them (of equally frequent lengths the longest counts). Entries c become whole numbers x = floor(1024 c) +
    100000; entries beyond 2**30 count as 2**30. Sums are exact; the covariance (divisor n) comes from sums of products
    of x less the whole number nearest to its mean, from which the exact remainder is then taken, so nothing cancels.
    Two passes over the vectors; what reaches the driver grows with the square of the number of dimensions alone.
    """
    found = _sums(df, column)
    if found is None:
        return None
    n, sums = found
    start = Whitening(n, sums, np.zeros(len(sums), _EXTENDED), np.eye(len(sums), dtype=_EXTENDED), 0.0, column)
    products = _products(df, column, start.middle)
    left = [s - n * int(m) for s, m in zip(sums, start.middle)]
    size = len(sums)
    exact = [[Fraction(n * products[min(i, j), max(i, j)] - left[i] * left[j], n * n) for j in range(size)] for i in range(size)]
    values, vectors = eigenvectors(_split(exact))
    return Whitening(n, sums, values, vectors, float(sum(exact[i][i] for i in range(size))), column)


def whiten(df: DataFrame, model: Whitening | None, components: int = 8, keep: list[str] | None = None) -> DataFrame:
    """Append ``whitened`` (array of double, the first ``components`` or as many as there are dimensions; null where an
    eigenvalue is zero) and ``deviation`` (decimal(38,0): sum over the dimensions of (n x - sum)**2, exact; null beyond
    38 digits) to the rows whose vector is usable and of the model's length. ``keep`` names the columns to carry along
    (default all); input columns called like a result are replaced. Repeated rows are all returned. Without model (no
    usable vectors) the result is empty.
    """
    taken = {"whitened", "deviation"}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    schema = T.StructType([df.schema[c] for c in kept]).add("whitened", T.ArrayType(T.DoubleType())).add("deviation", T.DecimalType(38, 0))
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    vector = F.col(f"`{model.column}`").cast("array<double>")
    rows = df.select(*(F.col(f"`{c}`") for c in kept), vector.alias("whitened"))  # a name that kept columns don't have
    sent = df.sparkSession.sparkContext.broadcast((model, model.projection(components)))
    kind = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, projection = sent.value
        for batch in batches:
            for chosen, x in entries(batch.column("whitened"), model.dimensions) if batch.num_rows else ():
                made = model.whiten(x, projection)
                flat = pa.array(made.ravel(), mask=np.isnan(made.ravel()))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * made.shape[1]), flat)
                far = model.deviations(x)
                far = pa.array(far).cast(kind) if far.dtype != object else pa.array([v if v < 10**38 else None for v in far], kind)
                rest = batch.take(pa.array(chosen))
                yield pa.RecordBatch.from_arrays([*(rest.column(c) for c in kept), lists, far], names=[*kept, "whitened", "deviation"])

    return rows.mapInArrow(run, schema)


def identity_error(whitened: DataFrame) -> float | None:
    """Largest absolute entry of the covariance (divisor n) of ``whitened`` less the identity, over all rows; components
    that are null (eigenvalue zero) are left out. None without rows. Rows are centred already, by the exact mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            lists = batch.column("w")
            if batch.num_rows:
                w = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                w = w[:, ~np.isnan(w[0])]
                total = w.T @ w if total is None else total + w.T @ w
                n += len(w)
        if n and total.size:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j]), pa.array(np.full(len(i), n))], names=["i", "j", "s", "n"])

    sums = whitened.select(F.col("whitened").alias("w")).mapInArrow(run, "i int, j int, s double, n long")
    cells = sums.groupBy("i", "j").agg((F.sum("s") / F.sum("n")).alias("c"))
    return cells.agg(F.max(F.abs(F.col("c") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]
