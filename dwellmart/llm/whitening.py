"""Whitening of embeddings from variances alone (polarisation covariance).

Vectors are taken as whole numbers, floor(scale * entry). Over the fit list, each distinct vector once,
tasks sum the exact squared centred values of every dimension and of the sum of every pair of dimensions;
the covariance of a pair is half of what the variance of the sum exceeds the two variances by. Squares are
summed in whole numbers of any size and only divided in the end, so the matrix that eigh gets is rounded
once, whatever the order of the tasks.

With n vectors and their sums S, a value is centred as n * x - S, a whole number; for a pair it is
n * (x_i + x_j) - (S_i + S_j). The fit list is shuffled once and stored; it is read for the sums, for the
squares and for the check of the result. The driver gets d * (d + 1) / 2 sums for d dimensions, whatever
the number of rows.

Nulls and odd rows: a vector that is null, empty, or holds null or non-finite entries is left out, and so
is one that hasn't the dimension most vectors have (of equally frequent ones the larger), unless a dimension is given. An
entry too large for a long fails the job. Repeated rows are all returned but fitted once; a frequent
vector is combined before the shuffle. Components whose eigenvalue is nothing but rounding have a null
``whitened``, ``explained`` is null where all vectors are equal. An empty table gives an empty result.
Texts aren't read. Only the column ``keep`` and the vector are; other columns may have any names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.session import written

SCALE = 256
SLICE_ROWS = 1024  # 2 ** 10 products of two LIMB-bit numbers stay below 2 ** 62
LIMB, PART = 26, 40
PARTS = 5  # of PART bits each, in which a sum travels; the last takes whatever is left
_LARGE = 1 << 62


def whole_vectors(rows: DataFrame, vector: str, keep: str, dimension: int | None = None, scale: int = SCALE) -> DataFrame:
    """(keep, x) of the rows that take part; x is an array of longs."""
    entry = F.col(f"`{vector}`")
    finite = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    sound = rows.select(F.col(f"`{keep}`"), entry.alias("x")).where(entry.isNotNull() & (F.size(entry) > 0) & finite)
    if dimension is None:
        sizes = sound.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        dimension = sizes["d"] if sizes else 0
    whole = F.transform("x", lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    return sound.where(F.size("x") == dimension).select(F.col(f"`{keep}`"), whole.alias("x"))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors of an Arrow list column, one a row."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: 64-bit numbers where they suffice, else Python's."""
    largest = max((int(abs(int(v))) for v in (x.min(), x.max())), default=0) if x.size else 0
    if 2 * (n * largest + max(map(abs, sums), default=0)) < _LARGE:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array([int(s) for s in sums], object)


def squares(y: np.ndarray) -> list[int]:
    """Exact sums of the squares of each column, of at most SLICE_ROWS rows."""
    if y.dtype == object:
        return [int(v) for v in (y * y).sum(axis=0)]
    y = np.abs(y)
    limbs = [y & ((1 << LIMB) - 1)]
    if int(y.max(initial=0)) >> LIMB:
        limbs += [(y >> LIMB) & ((1 << LIMB) - 1), y >> (2 * LIMB)]
    total = [0] * y.shape[1]
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs[: i + 1]):
            product = (a * b).sum(axis=0)
            weight = (1 if i == j else 2) << (LIMB * (i + j))
            total = [t + int(p) * weight for t, p in zip(total, product)]
    return total


def _parts(value: int) -> list[int]:
    """The value in numbers that a table of longs holds and sums: lower ones of PART bits, one for the rest."""
    parts = []
    for _ in range(PARTS - 1):
        parts.append(value & ((1 << PART) - 1))
        value >>= PART
    return parts + [value]


def _joined(parts: list[int]) -> int:
    return sum(int(p) << (PART * i) for i, p in enumerate(parts))


_SUMMED = "i INT, j INT, " + ", ".join(f"p{k} LONG" for k in range(PARTS))


def _totals(frame: DataFrame, run) -> dict[tuple[int, int], int]:
    """Exact totals by (i, j) of what ``run`` yields, a dict of numbers for each batch of a task."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple[int, int], int] = defaultdict(int)
        for batch in batches:
            for key, value in run(batch) if batch.num_rows else ():
                own[key] += value
        rows = [(*key, *_parts(value)) for key, value in own.items()]
        if rows:
            kinds = [pa.int32(), pa.int32()] + [pa.int64()] * PARTS
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *[f"p{k}" for k in range(PARTS)]])

    summed = frame.mapInArrow(emit, _SUMMED).groupBy("i", "j").agg(*[F.sum(f"p{k}") for k in range(PARTS)])
    return {(row[0], row[1]): _joined(list(row)[2:]) for row in summed.collect()}


@dataclass(frozen=True)
class Whitening:
    """n vectors, their sums, the largest eigenvalues and their vectors (columns), the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def real(self) -> np.ndarray:
        """Components that are more than rounding."""
        return self.values > max(self.trace, 0.0) * len(self.sums) * np.finfo(float).eps

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def whitened(self, z: np.ndarray) -> np.ndarray:
        """Of centred values; NaN in components without variance."""
        scale = np.where(self.real, np.sqrt(np.where(self.real, self.values, 1.0)), np.nan)
        return (z.astype(float) / self.n) @ self.vectors / scale


def covariance(fit: DataFrame, dimension: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, covariance matrix) of a table of distinct vectors in column x."""

    def sums(batch: pa.RecordBatch):
        x = matrix(batch.column(0), dimension)
        yield (-1, -1), len(x)
        low, high = x & 0xFFFFFFFF, x >> 32
        for i, (a, b) in enumerate(zip(low.sum(axis=0), high.sum(axis=0))):
            yield (i, i), int(a) + (int(b) << 32)

    found = _totals(fit.select("x"), sums)
    n = found.pop((-1, -1), 0)
    total = [found.get((i, i), 0) for i in range(dimension)]
    if not n:
        return 0, total, np.zeros((dimension, dimension))

    def squared(batch: pa.RecordBatch):
        rows = matrix(batch.column(0), dimension)
        for at in range(0, len(rows), SLICE_ROWS):
            z = centred(rows[at : at + SLICE_ROWS], n, total)
            for i in range(dimension):
                # Dimension i alone, then with each later one.
                y = np.concatenate([z[:, i : i + 1], z[:, i + 1 :] + z[:, i : i + 1]], axis=1)
                for j, value in enumerate(squares(y)):
                    yield (i, i + j), value

    q = _totals(fit.select("x"), squared)
    cov = np.zeros((dimension, dimension))
    for i in range(dimension):
        cov[i, i] = q[i, i] / n**3
        for j in range(i):
            cov[i, j] = cov[j, i] = (q[j, i] - q[i, i] - q[j, j]) / (2 * n**3)
    return n, total, cov


def fit_whitening(vectors: DataFrame, components: int) -> tuple[Whitening, DataFrame]:
    """The whitening of a column x of whole vectors of one dimension, and the stored fit list."""
    first = vectors.first()
    dimension = len(first["x"]) if first else 0
    fit = written(vectors.select("x").distinct(), "fit-list")
    n, sums, cov = covariance(fit, dimension)
    values, columns = np.linalg.eigh(cov) if n else (np.zeros(0), np.zeros((dimension, 0)))
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(n, sums, values[order], columns[:, order], float(np.trace(cov))), fit


def identity_error(model: Whitening, fit: DataFrame) -> float | None:
    """The largest absolute entry of the covariance of the whitened fit list minus the identity, measured
    on the whitened values themselves; None if no component has variance."""
    real, dimension = model.real, len(model.sums)
    if not real.any():
        return None

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = int(real.sum())
        sums, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            w = model.whitened(model.centred(matrix(batch.column(0), dimension)))[:, real]
            sums += w.sum(axis=0)
            products += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([sums, products.ravel()])])], names=["m"])

    found = fit.select("x").mapInArrow(moments, "m ARRAY<DOUBLE>").select(F.posexplode("m")).groupBy("pos").agg(F.sum("col"))
    flat = np.array([value for _, value in sorted(map(tuple, found.collect()))])
    size = int(real.sum())
    mean = flat[:size] / model.n
    cov = flat[size:].reshape(size, size) / model.n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(size)).max())


def whiten(rows: DataFrame, vector: str = "embedding", keep: str = "vec_id", components: int = 4, dimension: int | None = None) -> DataFrame:
    """For each row that takes part: ``keep``, n, deviation (exact, DECIMAL(38,0)), and arrays by component
    (falling eigenvalue) of whitened values and explained shares, and the identity error of all."""
    vectors = whole_vectors(rows, vector, keep, dimension)
    model, fit = fit_whitening(vectors, components)
    error = identity_error(model, fit)
    size = len(model.sums)
    explained = [float(v) / model.trace if model.trace > 0 else None for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z = model.centred(matrix(batch.column(1), size))
            exact = z.dtype != object and size * int(np.abs(z).max()) ** 2 < _LARGE
            deviations = (z * z).sum(axis=1) if exact else [sum(int(v) ** 2 for v in row) for row in z]
            values = [[None if v != v else v for v in row] for row in model.whitened(z).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.n] * len(z), pa.int64()),
                 pa.array([Decimal(int(d)) for d in deviations], pa.decimal128(38, 0)),
                 pa.array(values, pa.list_(pa.float64()))],
                names=["key", "n", "deviation", "whitened"],
            )

    kind = vectors.schema[keep].dataType.simpleString()
    done = vectors.select(F.col(f"`{keep}`").alias("key"), "x").mapInArrow(
        run, f"key {kind}, n LONG, deviation DECIMAL(38,0), whitened ARRAY<DOUBLE>"
    )
    shares = F.array(*[F.lit(e).cast("double") for e in explained]) if explained else F.array().cast("array<double>")
    return done.select(
        F.col("key").alias(keep), "n", "deviation", "whitened", shares.alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
