"""Whitening of embeddings by slicing the spectrum of their covariance.

Spark sums the vectors exactly, then their centred products; what reaches the driver has the size of the covariance matrix.
There the number of eigenvalues above a shift is read off the pivots of an LDL' factorization of the
shifted matrix. Counts halve an interval until it holds the wanted eigenvalue alone, Rayleigh quotient
iteration converges inside it, and two more counts, close above and below the result, certify its number.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
# Entries are taken as whole numbers: SCALE times the entry, rounded down, and SHIFT.
SCALE, SHIFT = 1024, 100_000
# Eigenvalues under this share of the largest one count as zero: dividing by them would only scale rounding errors up.
RANK_SHARE = 1e-9
# Larger whole numbers are refused, as sums of them might not be exact.
LARGEST = 1 << 40

_PIVOT = (1 + math.sqrt(17)) / 8
_EPS = np.finfo(float).eps


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``matrix`` lie above ``shift``.

    By Sylvester's law these are the positive pivots of an LDL' factorization, here with pivots of one or two rows
    chosen for size. A block of two has one positive and one negative eigenvalue.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        size = np.abs(a)
        diagonal = np.diagonal(size).copy()
        np.fill_diagonal(size, 0)
        r = int(diagonal.argmax())
        if diagonal[r] >= _PIVOT * size.max():
            if diagonal[r] == 0:
                break
            pivot = a[r, r]
            positive += pivot > 0
            column = np.delete(a[:, r], r)
            a = np.delete(np.delete(a, r, 0), r, 1) - np.outer(column, column / pivot)
        else:
            pair = list(np.unravel_index(size.argmax(), size.shape))
            columns = np.delete(a[:, pair], pair, 0)
            positive += 1
            inner = a[np.ix_(pair, pair)]
            a = np.delete(np.delete(a, pair, 0), pair, 1) - columns @ np.linalg.solve(inner, columns.T)
    return int(positive)


class Spectrum:
    """Leading eigenvalues of a covariance matrix with unit vectors, each certified by counts."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = (matrix + matrix.T) / 2
        self.size = float(np.abs(self.matrix).sum(axis=1).max(initial=0.0))  # no eigenvalue is larger
        self.near = 8 * _EPS * self.size * max(1, len(matrix))  # what rounding may move a count by
        self.counts: dict[float, int] = {-self.size - self.near: len(matrix), self.size + self.near: 0}
        self.values: list[float] = []
        self.vectors: list[np.ndarray] = []

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = eigenvalues_above(self.matrix, shift)
        return self.counts[shift]

    def interval(self, number: int) -> tuple[float, float]:
        """Where earlier counts place eigenvalue ``number``, from 1 by falling size."""
        low = max(s for s, n in self.counts.items() if n >= number)
        high = min(s for s, n in self.counts.items() if n < number and s > low)
        return low, high

    def _alone(self, low: float, high: float) -> bool:
        return self.counts[low] - self.counts[high] == 1

    def _against_found(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for u in self.vectors:
                v = v - (u @ v) * u
        return v / np.linalg.norm(v)

    def _solved(self, shift: float, v: np.ndarray) -> np.ndarray:
        shifted = self.matrix - shift * np.eye(len(v))
        try:
            w = np.linalg.solve(shifted, v)
        except np.linalg.LinAlgError:
            w = np.linalg.solve(shifted + self.near * np.eye(len(v)), v)
        return self._against_found(w)

    def _converged(self, low: float, high: float) -> tuple[float, np.ndarray]:
        """Rayleigh quotient iteration from the middle of an interval."""
        middle = (low + high) / 2
        v = self._against_found(np.random.default_rng(len(self.values)).standard_normal(len(self.matrix)))
        for _ in range(3):
            v = self._solved(middle, v)
        value = float(v @ self.matrix @ v)
        for _ in range(20):
            if np.linalg.norm(self.matrix @ v - value * v) <= self.near / 4:
                break
            v = self._solved(value, v)
            value = float(v @ self.matrix @ v)
        return value, v

    def find(self, number: int) -> None:
        """Add eigenvalue ``number``; those before it are known.

        Eigenvalues that lie closer than rounding can tell share an interval; their vectors are made orthogonal.
        """
        while True:
            low, high = self.interval(number)
            while not self._alone(low, high) and high - low > 2 * self.near:
                self.above((low + high) / 2)
                low, high = self.interval(number)
            value, v = self._converged(low, high)
            if self.above(value + self.near) < number <= self.above(value - self.near):
                self.values.append(value)
                self.vectors.append(v if v[np.abs(v).argmax()] > 0 else -v)
                return
            low, high = self.interval(number)
            if high - low <= 2 * self.near:
                raise ArithmeticError(f"eigenvalue {number} can't be certified")
            self.above((low + high) / 2)


def leading(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, in falling order, and their unit vectors as columns; those that count as zero are left out."""
    spectrum = Spectrum(matrix)
    for number in range(1, min(components, len(matrix)) + 1):
        if spectrum.size == 0 or spectrum.above(RANK_SHARE * (spectrum.values or [spectrum.size])[0]) < number:
            break
        spectrum.find(number)
    return np.array(spectrum.values), np.array(spectrum.vectors).reshape(len(spectrum.values), len(matrix)).T


def whole_numbers(column: pa.ListArray, dimension: int) -> np.ndarray:
    """A row of whole numbers for each vector."""
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension)
    x = np.floor(SCALE * entries) + SHIFT
    if x.size and np.abs(x).max() > LARGEST:
        raise ValueError(f"an entry is larger than {LARGEST // SCALE}")
    return x.astype(np.int64)


def usable(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """``vec_id, embedding`` of the vectors to use, how many they are, and their dimension.

    Vectors that are null or hold null or non-finite entries are left out, as are those of another than the commonest
    length, the longest of several such; an empty vector is never used.
    """
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))  # NaN is larger than all
    sound = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(finite & (F.size("embedding") > 0))
    lengths = sound.groupBy(F.size("embedding").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if most is None:
        return sound, 0, 0
    return sound.where(F.size("embedding") == most["length"]), most["count"], most["length"]


def exact_sums(rows: DataFrame, dimension: int) -> list[int]:
    """The sum over all rows of each dimension of the whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(dimension, np.int64)
        counted = 0
        for batch in batches:
            if counted + batch.num_rows > 1 << 22:  # LARGEST times so many still fits
                yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dimension), pa.int32()), "part": sums})
                sums, counted = np.zeros(dimension, np.int64), 0
            sums = sums + whole_numbers(batch.column("embedding"), dimension).sum(axis=0)
            counted += batch.num_rows
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dimension), pa.int32()), "part": sums})

    parts = rows.select("embedding").mapInArrow(run, "dim int, part long")
    total = parts.groupBy("dim").agg(F.sum(F.col("part").cast("decimal(28,0)")).alias("total"))
    return [int(r["total"]) for r in total.orderBy("dim").collect()]


def mean_products(rows: DataFrame, n: int, mean: np.ndarray, onto: np.ndarray | None = None) -> np.ndarray:
    """The covariance, divisor ``n``, of the whole numbers, or of their centred form times ``onto``.

    Tasks centre and multiply; partial sums of the upper triangle are added by Spark.
    """
    width = len(mean) if onto is None else onto.shape[1]
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            centred = whole_numbers(batch.column("embedding"), len(mean)) - mean
            if onto is not None:
                centred = centred @ onto
            total += centred.T @ centred
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "part": total[i, j] / n})

    parts = rows.select("embedding").mapInArrow(run, "i int, j int, part double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("total")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[decimal.Decimal | None]:
    """The sum over dimensions of ``(n * x - sum)^2``, exactly; null when it has more than 38 digits."""
    quotient, rest = zip(*(divmod(s, n) for s in sums))  # n x - sum = n (x - quotient) - rest
    y = x - np.array(quotient, np.int64)
    largest = int(np.abs(y).max(initial=1))
    if max(largest, n) * largest * len(sums) >= 1 << 62:
        y = y.astype(object)
    squares, mixed = (y * y).sum(axis=1).tolist(), (y * np.array(rest, y.dtype)).sum(axis=1).tolist()
    last = sum(r * r for r in rest)
    found = (n * n * s - 2 * n * m + last for s, m in zip(squares, mixed))
    return [decimal.Decimal(d) if d < 10**38 else None for d in found]


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each usable vector and component.

    Entries ``c`` become the whole numbers ``floor(1024 c) + 100000``; all usable vectors (see ``usable``) are fitted. A component
    is a unit eigenvector of their covariance, numbered by falling eigenvalue and with its largest entry positive.
    ``deviation`` is the exact sum over dimensions of ``(n x - sum)^2`` as a decimal, ``whitened`` the
    centred vector's projection over the root of the eigenvalue, ``explained`` the eigenvalue's share of the trace, and
    ``identity_error`` how far the covariance of ``whitened``, measured over all vectors, is from the identity.

    Repeated rows each count. Where there are fewer eigenvalues than components that do not count as zero, as with few or equal
    vectors, the rest are left out; an empty table, or one without a usable vector, gives an empty result. Equal eigenvalues have any orthogonal
    vectors of their space. An entry beyond 2^30 fails the job. Other columns are not read.
    """
    rows, n, dimension = usable(vectors)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    sums = exact_sums(rows, dimension)
    mean = np.array([s / n for s in sums])
    covariance = mean_products(rows, n, mean)
    values, columns = leading(covariance, components)
    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema)
    onto = columns / np.sqrt(values)
    error = float(np.abs(mean_products(rows, n, mean, onto) - np.eye(len(values))).max())
    explained = values / np.trace(covariance)
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column("embedding"), dimension)
            many = batch.num_rows
            each = pa.array(np.repeat(np.arange(many), k))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id").take(each),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), many),
                    "n": np.full(many * k, n, np.int64),
                    "deviation": pa.array(deviations(x, n, sums), pa.decimal128(38, 0)).take(each),
                    "whitened": ((x - mean) @ onto).ravel(),
                    "explained": np.tile(explained, many),
                    "identity_error": np.full(many * k, error),
                }
            )

    return rows.mapInArrow(run, schema)
