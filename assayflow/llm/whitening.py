"""Whitening of embeddings on their leading principal components, found by spectrum slicing.

Spark does what grows with the rows: the different vectors, their sums, their centred products, the
projections. All sums are of integers and exact, whatever the order of the tasks.

The covariance, as wide and high as vectors are long, comes to the driver. There the inertia of LDLᵀ
factors of the covariance minus a shift says how many eigenvalues lie above the shift; bisection with these
counts isolates each leading eigenvalue, Rayleigh quotient iteration takes it from there, and two
more counts, closely around the result, certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import staged

#: Entries are kept as floor(SCALE * entry).
SCALE = 256
COMPONENTS = 4
#: Components whose eigenvalue is below this share of the trace carry rounding only and are left out.
LEAST_SHARE = 1e-12
#: Sums leave tasks as four parts of 40 bits, so that adding them up cannot overflow.
PART_BITS, PARTS = 40, 4


def usable(column: str) -> Column:
    """Whether a vector has neither NULL nor non-finite entries."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(F.forall(column, finite), F.lit(False))


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the integers of every usable vector; beyond 64 bits they stop at the bounds."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return rows.where(usable("v")).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _parts(value: int) -> list[int]:
    low = [(value >> (PART_BITS * k)) & ((1 << PART_BITS) - 1) for k in range(PARTS - 1)]
    return [*low, value >> (PART_BITS * (PARTS - 1))]


def _whole(parts: list[int]) -> int:
    return sum(part << (PART_BITS * k) for k, part in enumerate(parts))


def exact_products(y: np.ndarray) -> np.ndarray:
    """yᵀy of integers, as Python integers: by floating point where no sum can reach 2^53, else by long ones."""
    d = y.shape[1]
    most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    out = np.zeros((d, d), object)
    rows = 2**53 // (most * most) if most else len(y)
    if rows < 1:
        y = y.astype(object)
        return y.T.dot(y) if len(y) else out
    for at in range(0, len(y), max(1, rows)):
        part = y[at : at + rows].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _sums(dimension: int, shift: list[int] | None):
    """Of a task's rows x: per column the sum, or with a shift the sums of x - shift and of its products."""
    kinds = [pa.int32(), pa.int32(), *[pa.int64()] * PARTS]
    names = ["i", "j", *[f"p{k}" for k in range(PARTS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(dimension, object), np.zeros((dimension, dimension), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), dimension)
            y = x
            if shift is not None:
                wide = max(abs(int(x.max())), abs(int(x.min())), *map(abs, shift)) >= 1 << 62
                y = x.astype(object) - np.array(shift, object) if wide else x - np.array(shift, np.int64)
                products += exact_products(y)
            # Halves, so that no sum of a batch leaves 64 bits.
            low = y & 0xFFFFFFFF
            sums += low.sum(axis=0).astype(object) + (((y - low) >> 32).sum(axis=0).astype(object) << 32)
        found = [(i, -1, *_parts(int(sums[i]))) for i in range(dimension)]
        if shift is not None:
            found += [(i, j, *_parts(int(products[i, j]))) for i in range(dimension) for j in range(i, dimension)]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    return run


def _total(fit: DataFrame, dimension: int, shift: list[int] | None) -> dict[tuple[int, int], int]:
    """The sums over all rows; at most one for each pair of columns comes to the driver."""
    schema = "i int, j int, " + ", ".join(f"p{k} long" for k in range(PARTS))
    partial = fit.select("x").mapInArrow(_sums(dimension, shift), schema)
    summed = partial.groupBy("i", "j").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(PARTS)])
    return {(r.i, r.j): _whole([r[f"p{k}"] for k in range(PARTS)]) for r in summed.collect()}


def inertia(matrix: np.ndarray, shift: float) -> tuple[int, int]:
    """How many eigenvalues of a symmetric matrix lie above the shift and how many on it.

    By the signs of D in LDLᵀ of the shifted matrix, with pivots of one or two rows chosen
    from all that is left (Bunch and Parlett); a pair of rows has one sign each.
    """
    m = matrix - shift * np.eye(len(matrix))
    bound = (1 + 17**0.5) / 8
    above = 0
    while len(m):
        off = np.abs(m)
        diagonal = off.diagonal().copy()
        np.fill_diagonal(off, 0)
        r = int(diagonal.argmax())
        most = off.max(initial=0)
        if diagonal[r] == 0 and most == 0:
            return above, len(m)
        if diagonal[r] >= bound * most:
            above += bool(m[r, r] > 0)
            rest = np.delete(np.arange(len(m)), r)
            column = m[rest, r]
            m = m[np.ix_(rest, rest)] - np.outer(column, column / m[r, r])
        else:
            above += 1
            pair = np.array(np.unravel_index(int(off.argmax()), off.shape))
            rest = np.delete(np.arange(len(m)), pair)
            columns = m[np.ix_(rest, pair)]
            m = m[np.ix_(rest, rest)] - columns @ np.linalg.solve(m[np.ix_(pair, pair)], columns.T)
        m = (m + m.T) / 2
    return above, 0


@dataclass
class Slices:
    """Counts of eigenvalues above shifts, each computed once."""

    matrix: np.ndarray

    def __post_init__(self):
        self.norm = float(np.abs(self.matrix).sum(axis=1).max(initial=0))
        self.counts = {-2 * self.norm - 1e-300: len(self.matrix), 2 * self.norm + 1e-300: 0}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = inertia(self.matrix, shift)[0]
        return self.counts[shift]

    def interval(self, number: int) -> tuple[float, float, int, int]:
        """The narrowest known interval (low, high] with the number-th largest eigenvalue, and the counts above its ends."""
        low = max(s for s, n in self.counts.items() if n >= number)
        high = min(s for s, n in self.counts.items() if n < number)
        return low, high, self.counts[low], self.counts[high]

    def isolate(self, number: int) -> tuple[float, float, int, int]:
        """Bisect until that eigenvalue is alone in its interval, or the interval is as narrow as rounding."""
        while True:
            low, high, at_low, at_high = self.interval(number)
            middle = (low + high) / 2
            if at_low - at_high == 1 or high - low <= 8 * np.finfo(float).eps * self.norm or not low < middle < high:
                return low, high, at_low, at_high
            self.above(middle)


def _solve(matrix: np.ndarray, shift: float, v: np.ndarray, norm: float) -> np.ndarray:
    """(matrix - shift) w = v, scaled to length 1; an exactly singular matrix is shifted by a rounding more."""
    eps = np.finfo(float).eps
    for nudge in (0.0, eps * norm, -4 * eps * norm, 64 * eps * norm):
        try:
            w = np.linalg.solve(matrix - (shift + nudge) * np.eye(len(matrix)), v)
        except np.linalg.LinAlgError:
            continue
        length = np.linalg.norm(w)
        if np.isfinite(length) and length > 0:
            return w / length
    return v


def leading_components(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a positive semidefinite matrix, falling, and their unit vectors as columns.

    Eigenvalues that carry rounding only (LEAST_SHARE) are left out. Of equal eigenvalues, any
    orthonormal vectors of their space are given. Raises if the counts do not certify a number.
    Cost on the driver: a factorisation for each count, some ten of them for each component.
    """
    d = len(matrix)
    size = float(np.abs(matrix).max(initial=0))
    if size == 0:
        return np.zeros(0), np.zeros((d, 0))
    scaled = matrix / size
    slices = Slices(scaled)
    eps, trace = np.finfo(float).eps, float(np.trace(scaled))
    rng = np.random.default_rng(1)
    values: list[float] = []
    vectors = np.zeros((d, 0))
    while len(values) < min(wanted, d):
        number = len(values) + 1
        low, high, at_low, at_high = slices.isolate(number)
        alone = at_low - at_high == 1
        v = rng.standard_normal(d)
        rho = (low + high) / 2
        for step in range(60):
            w = _solve(scaled, rho, v - vectors @ (vectors.T @ v), slices.norm)
            w -= vectors @ (vectors.T @ w)
            w /= np.linalg.norm(w)
            quotient = float(w @ scaled @ w)
            residual = float(np.linalg.norm(scaled @ w - quotient * w))
            if alone and not low <= quotient <= high:
                # Not yet near this eigenvalue alone: halve the interval and stay at its middle.
                slices.above((low + high) / 2)
                low, high, *_ = slices.interval(number)
                v, rho = w, (low + high) / 2
                continue
            done = residual <= 16 * eps * slices.norm and step > 0 and abs(float(abs(w @ v)) - 1) < 4 * eps * d
            v = w
            if done:
                break
            # Of eigenvalues that rounding cannot tell apart, the shift stays where they are.
            rho = quotient if alone else rho
        value = float(v @ scaled @ v)
        residual = float(np.linalg.norm(scaled @ v - value * v))
        slack = max(4 * residual, 64 * eps * slices.norm)
        if not (slices.above(value + slack) < number <= slices.above(value - slack)):
            raise ArithmeticError(f"eigenvalue {number} is not certified")
        if value <= LEAST_SHARE * trace:
            break
        values.append(value)
        vectors = np.column_stack([vectors, v if v[np.abs(v).argmax()] > 0 else -v])
    return np.array(values) * size, vectors


@dataclass
class Whitening:
    """What whitening needs: fit list size, sums, eigenvalues and their vectors as columns, trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def project(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Rows of integers whitened, and the exact squared lengths of n x - S, None beyond 64 bits."""
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        reach = self.n * most + max(map(abs, self.sums), default=0)
        if reach * reach * max(1, self.dimension) < 1 << 63:
            apart = self.n * x - np.array(self.sums, np.int64)
            lengths = (apart * apart).sum(axis=1).tolist()
        else:
            apart = self.n * x.astype(object) - np.array(self.sums, object)
            exact = [int(s) for s in (apart * apart).sum(axis=1)]
            lengths = [s if s < 1 << 63 else None for s in exact]
        centred = apart.astype(np.float64) / self.n
        return centred @ self.vectors / np.sqrt(self.values), lengths


def different_vectors(rows: DataFrame) -> tuple[DataFrame, int]:
    """Each x once, stored, of the length that most of them have (the longer one if even), and that length."""
    fit, _ = staged(rows.select("x").distinct(), "whitening-fit")
    lengths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dimension = lengths[0].d if lengths else 0
    return fit.where(F.size("x") == dimension), dimension


def fit_whitening(fit: DataFrame, dimension: int, wanted: int = COMPONENTS) -> Whitening:
    """Mean, covariance and leading components of the fit list, centred before anything is multiplied.

    Vectors are centred at the integer next to each mean, which loses nothing; what remains
    of the mean is below one half and taken off exactly.
    """
    n = fit.count()
    if not n or not dimension:
        return Whitening(n, [0] * dimension, np.zeros(0), np.zeros((dimension, 0)), 0.0)
    first = _total(fit, dimension, None)
    sums = [first[i, -1] for i in range(dimension)]
    shift = [(2 * s + n) // (2 * n) for s in sums]
    second = _total(fit, dimension, shift)
    rest = [second[i, -1] for i in range(dimension)]
    matrix = np.zeros((dimension, dimension))
    for i in range(dimension):
        for j in range(i, dimension):
            matrix[i, j] = matrix[j, i] = (n * second[i, j] - rest[i] * rest[j]) / (n * n)
    values, vectors = leading_components(matrix, wanted)
    return Whitening(n, sums, values, vectors, float(np.trace(matrix)))


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """The rows with deviation and whitened, one value per component; `rows` has x and vec_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whitened, lengths = model.project(_matrix(batch.column(1), model.dimension))
            k = whitened.shape[1]
            offsets = pa.array(np.arange(0, k * batch.num_rows + 1, k), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(whitened.reshape(-1)))
            yield pa.record_batch([batch.column(0), pa.array(lengths, pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    sized = rows.where(F.size("x") == model.dimension)
    return sized.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity, in its worst entry."""
    k = len(model.values)
    whitened = project(fit.select(F.lit(None).cast("long").alias("vec_id"), "x"), model).select(
        *[F.col("whitened")[i].alias(f"w{i}") for i in range(k)]
    )
    apart = [F.abs(F.covar_pop(f"w{i}", f"w{j}") - F.lit(float(i == j))) for i in range(k) for j in range(i, k)]
    return float(whitened.select(F.greatest(*apart, F.lit(0.0), F.lit(0.0))).head()[0])


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every usable vector.

    `vectors` has vec_id and embedding; other columns are ignored, repeated rows are rows like any
    other, and vec_id may be NULL. Vectors that are NULL or hold NULL or non-finite entries are
    dropped, as are those of another length than most different vectors have. Components are those
    that vary, at most `wanted`; vectors that are all equal, empty vectors and no rows give no rows.
    deviation is NULL where it does not fit 64 bits.
    """
    rows = integers(vectors)
    fit, dimension = different_vectors(rows)
    model = fit_whitening(fit, dimension, wanted)
    if not len(model.values):
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(fit, model)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    long = project(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
