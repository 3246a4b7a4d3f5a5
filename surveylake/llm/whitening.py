"""Whitening of embeddings: exact distributed covariance, eigenvectors refined from float32 by matrix products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.common import table, written

#: Entries are counted in steps of 1 / STEPS, from ORIGIN.
STEPS, ORIGIN = 64, 1_000_000
COMPONENTS = 16
#: Entries beyond this number of steps have no exact products in 38 digits; rows that hold one are left out.
LARGEST = 1 << 40
#: Whole numbers up to this are exact as doubles.
EXACT = 1 << 53
#: The precision of refinement: that of the machine's widest float, at least double.
WIDE = np.longdouble
ROUNDS = 64
#: Vectors that a task multiplies at a time.
CHUNK = 1 << 14


def whole_steps(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`vec_id` and `x`, its vector's entries as whole steps, of the rows with a vector of finite entries.

    Left out are rows whose vector is null or empty or holds null, non-finite or unimaginably large entries.
    """
    entries = F.transform(F.col(vector), lambda c: F.floor(F.lit(float(STEPS)) * c.cast("double")))
    # NaN is above every number, and a null entry makes the test null.
    fits = F.forall(F.col(vector), lambda c: F.coalesce(F.abs(STEPS * c.cast("double")) < LARGEST, F.lit(False)))
    held = df.where(F.col(vector).isNotNull()).where(fits & (F.size(vector) > 0))
    return held.select(F.col(key).alias("vec_id"), F.transform(entries, lambda c: c.cast("long") + ORIGIN).alias("x"))


def _matrices(batches, column: int, dims: int, most: int = CHUNK) -> Iterator[np.ndarray]:
    """The lists of whole numbers of a column as matrices of some rows."""
    for batch in batches:
        values = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        for first in range(0, len(values), most):
            yield values[first : first + most]


def _whole(values: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _added(parts: DataFrame) -> dict[tuple[int, int], int]:
    """The sums of partial results by row and column of a matrix: as many as it has cells, whatever the number of rows."""
    return {(r.i, r.j): int(r.v) for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


CELLS = "i int, j int, v decimal(38,0)"


def totals(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension, exactly."""

    def add(batches):
        count, sums = 0, np.zeros(dims, object)
        for x in _matrices(batches, 0, dims):
            count += len(x)
            sums += x.sum(0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array([0] * (dims + 1), pa.int32()), pa.array(range(dims + 1), pa.int32()), _whole([*sums, count])], ["i", "j", "v"])

    found = _added(fit.select("x").mapInArrow(add, CELLS))
    return found.get((0, dims), 0), [found.get((0, j), 0) for j in range(dims)]


def products(rows: np.ndarray) -> np.ndarray:
    """The sum over the rows of the products of each two columns, as whole numbers without rounding."""
    largest = int(np.abs(rows).max(initial=0))
    if largest * largest * len(rows) < EXACT:
        rows = rows.astype(np.float64)
        return (rows.T @ rows).astype(np.int64).astype(object)
    if largest * largest >= EXACT:
        rows = rows.astype(object)
        return rows.T @ rows
    step = max(1, EXACT // (largest * largest))
    return sum(products(rows[k : k + step]) for k in range(0, len(rows), step))


def scatter(fit: DataFrame, dims: int, n: int, sums: list[int]) -> list[list[int]]:
    """n * n times the covariance, exactly.

    Vectors are centred on the whole part of the mean before they are multiplied, so the products stay small; the
    rest of the mean, less than one step, is taken off in whole numbers.
    """
    centre = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]

    def add(batches):
        total = np.zeros((dims, dims), object)
        for x in _matrices(batches, 0, dims):
            total += products(x - centre)
        i, j = np.divmod(np.arange(dims * dims), dims)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _whole(total.ravel())], ["i", "j", "v"])

    found = _added(fit.select("x").mapInArrow(add, CELLS))
    return [[n * found[i, j] - rest[i] * rest[j] for j in range(dims)] for i in range(dims)]


def wide_matrix(numerators: list[list[int]], divisor: int) -> np.ndarray:
    """Whole numbers divided by one, in the widest precision: high and low part of each are added."""
    high = np.array([[float(v) for v in row] for row in numerators], np.float64)
    low = np.array([[float(v - int(h)) for v, h in zip(row, tops)] for row, tops in zip(numerators, high.tolist())])
    return (high.astype(WIDE) + low.astype(WIDE)) / WIDE(divisor)


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """The places of the values in falling order, cut where neighbours are more than `gap` apart."""
    order = np.argsort(-values, kind="stable")
    return np.split(order, np.flatnonzero(-np.diff(values[order]) > gap) + 1)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix given in the widest precision.

    Eigenvectors computed in float32 are corrected by `refined`, first in double and then in the widest precision.
    """
    scale = np.abs(matrix).max(initial=0) or WIDE(1)
    a = matrix / scale
    vectors = np.linalg.eigh(a.astype(np.float32))[1]
    for kind in (np.float64, WIDE):
        values, vectors = refined(a.astype(kind), vectors.astype(kind))
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    return values[order] * scale, vectors / np.sqrt((vectors * vectors).sum(0))


def refined(a: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, and the approximate eigenvectors corrected by the iteration of Ogita and Aishima.

    Products of the vectors, plain and through the matrix, tell how far they are from orthogonal and from
    diagonalising it; one more product applies the correction, which doubles the right digits. It divides by
    differences of eigenvalues. Those closer together than the present error are a cluster: within it vectors are only
    made orthogonal, and the matrix in its space, less its mean eigenvalue, is solved by itself and the vectors are
    turned by the solution, so that they can be told apart next time. Ends when corrections no longer get smaller.
    """
    one, tiny = np.eye(len(a), dtype=a.dtype), np.finfo(a.dtype).eps * len(a)
    least, stalled = np.inf, 0
    for _ in range(ROUNDS):
        off = one - vectors.T @ vectors
        seen = vectors.T @ (a @ vectors)
        values = np.diag(seen) / (1 - np.diag(off))
        error = 2 * (_norm(seen - np.diag(values)) + _norm(a) * _norm(off))
        gap = values - values[:, None]
        apart = np.abs(gap) > error
        step = np.where(apart, (seen + values * off) / np.where(apart, gap, 1), off / 2)
        vectors = vectors + vectors @ step
        moved = float(np.abs(step).max())
        for run in clusters(values, error):
            if len(run) > 1:
                own = vectors[:, run]
                mean = values[run].mean()
                inner = own.T @ (a @ own - mean * own)
                mixed = float(np.abs(inner - np.diag(np.diag(inner))).max())
                if mixed > tiny:
                    vectors[:, run] = own @ _solved(inner)
                    moved = max(moved, mixed)
        stalled = stalled + 1 if moved > least / 2 else 0
        least = min(least, moved)
        if moved <= tiny or stalled > 3:
            break
    for _ in range(2):  # corrections between close eigenvalues are large enough to bend the vectors again
        vectors = vectors + vectors @ ((one - vectors.T @ vectors) / 2)
    return np.diag(vectors.T @ (a @ vectors)) / np.diag(vectors.T @ vectors), vectors


def _norm(matrix: np.ndarray) -> float:
    return float(np.sqrt((matrix * matrix).sum()))


def _solved(inner: np.ndarray) -> np.ndarray:
    """The eigenvectors, in double precision, of a small symmetric matrix of whatever scale."""
    scaled = (inner + inner.T) / (2 * np.abs(inner).max())
    return np.linalg.eigh(scaled.astype(np.float64))[1].astype(inner.dtype)


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: the fit list's length and sums, and its components by falling eigenvalue.

    A vector is centred by the sums and multiplied with `vectors` (a column a component), and divided by the roots of
    `values`. `explained` are the values as shares of the trace. Components without spread are not among them.
    """

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """The sum over dimensions of (n * x - S) ** 2, exactly; null where that is no 64-bit number."""
        bound = max(map(abs, [self.n * int(x.max(initial=0)), self.n * int(x.min(initial=0)), *self.sums])) * 2
        if bound < 1 << 62:
            d = self.n * x - np.array(self.sums, np.int64)
            if int(np.abs(d).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
                return (d * d).sum(1)
        d = self.n * x.astype(object) - np.array(self.sums, object)
        return np.array([v if v < 1 << 63 else None for v in (d * d).sum(1)], object)


def fitted(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the vectors `x` of a written table, all of `dims` entries. The driver sees dims * dims sums."""
    n, sums = totals(fit, dims)
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
    covariance = wide_matrix(scatter(fit, dims, n, sums), n * n)
    values, vectors = eigen(covariance)
    spread = values > values.max() * dims * np.finfo(np.float64).eps
    kept = np.flatnonzero(spread)[:components]
    explained = values[kept] / (np.trace(covariance) or 1)
    return Whitening(n, sums, values[kept].astype(np.float64), vectors[:, kept].astype(np.float64), explained.astype(np.float64))


def identity_error(fit: DataFrame, model: Whitening, dims: int) -> float:
    """The largest entry of the covariance of the whitened fit list less the identity, measured on all its rows."""
    k = len(model.values)
    scale = Decimal(1).scaleb(-18)

    def add(batches):
        total = np.zeros((k, k + 1))
        for x in _matrices(batches, 0, dims):
            w = model.whitened(x)
            total[:, :k] += w.T @ w
            total[:, k] += w.sum(0)
        i, j = np.divmod(np.arange(k * (k + 1)), k + 1)
        values = pa.array([Decimal(v).quantize(scale) for v in total.ravel().tolist()], pa.decimal128(38, 18))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], ["i", "j", "v"])

    # Decimals, so that the sum does not depend on the order in which tasks end.
    parts = fit.select("x").mapInArrow(add, "i int, j int, v decimal(38,18)")
    sums = np.zeros((k, k + 1))
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[row.i, row.j] = float(row.v) / model.n
    return float(np.abs(sums[:, :k] - np.outer(sums[:, k], sums[:, k]) - np.eye(k)).max(initial=0))


def whitened(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """`vec_id`, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error` of each row and component.

    Rows are those of `whole_steps`, of the length that most of them have (ties: the longer). The fit list holds each
    distinct vector once, so copies weigh nothing; tasks drop copies before they are shuffled. Repeated rows and null
    keys are returned as they are. Components without spread are left out, so equal vectors give no rows, as does an
    empty table.
    """
    held = whole_steps(df, key, vector)
    lengths = held.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("dims")).first()
    dims = common.dims if common else 0
    held = held.where(F.size("x") == dims)
    fit = written(held.select("x").distinct(), "fit-list")
    model = fitted(fit, dims, components)
    error = identity_error(fit, model, dims)
    k = len(model.values)

    def project(batches):
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            for x, first in zip(_matrices([batch], 1, dims), range(0, batch.num_rows, CHUNK)):
                keys = batch.column(0).slice(first, len(x)).take(pa.array(np.repeat(np.arange(len(x)), k)))
                numbers = np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))
                deviation = pa.array(np.repeat(model.deviations(x), k), pa.int64())
                explained = np.tile(model.explained, len(x))
                columns = [keys, numbers, np.full(len(keys), model.n), deviation, model.whitened(x).ravel(), explained, np.full(len(keys), error)]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], NAMES)

    kinds = ["int", "bigint", "bigint", "double", "double", "double"]
    schema = ", ".join([f"vec_id {held.schema['vec_id'].dataType.simpleString()}", *[f"{n} {t}" for n, t in zip(NAMES[1:], kinds)]])
    return held.mapInArrow(project, schema)


NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
