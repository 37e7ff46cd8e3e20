"""Operator 11: whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

An entry c counts as x = floor(1024 * c) + 100000, a whole number. With X the table of the rows'
x minus their mean, the right singular vectors of X are the components (unit eigenvectors of the
covariance), and squared singular values over the number of rows are their variances.

* The bidiagonalisation makes orthonormal v1, v2, .. (as long as a vector) and u1, u2, .. (as long
  as the table) with X V = U B and B upper bidiagonal, by products X v and X'u in turn. Both are
  made in one pass over the table: a task multiplies its rows by v and those products by its rows
  again, and returns two small vectors of sums.
* No u is ever stored: every u is X w for a w that the driver keeps, and a product of two of them
  is w'(X'u), of which the pass has returned X'u. So new vectors on either side are orthogonalised
  against all earlier ones (twice) without another pass and without a column of the table's length.
* The bidiagonal matrix is as small as the number of steps; its singular value decomposition gives
  components and deviations. Where a step meets an invariant subspace (repeated or zero variances),
  it goes on with a new direction, so no component of a repeated variance is lost.

Rows are centred before they are multiplied: n * x - S is a whole number (S: the sums), which is
then divided by n. Vectors of up to ``FULL_WIDTH`` entries take as many steps as they have entries.
For wider ones the steps end when the wanted components are settled to rounding; there, of
components with exactly the same variance, only those may be found that the first direction meets.

Bounds: the driver holds a few vectors for each step, and a few sums from each task (tasks are
joined to twice the number of cores). A task holds one Arrow batch of rows.

Defined results: a vector that is null or holds a null, not-a-number or infinite entry, or one
whose x is beyond 2^52 in size, takes no part, nor does a row without an id or an empty vector. A
shorter vector counts as filled up with zeros. Repeated rows and rows of one id count and come out
each. A component without variance (fewer different rows than components, or constant entries) has
no whitened values and isn't returned; an empty table, or one of equal rows, gives no rows. A
deviation beyond the range of a long is null. Components' signs: the entry of largest size is
positive. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagecraft.llm.common import Scratch

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
LARGEST = float(1 << 52)
# A direction is settled when its residual is below this share of the largest singular value.
SETTLED = 1e-15
# Vectors of up to so many entries take all steps.
FULL_WIDTH = 512
# Deviations below this share of the largest one are rounding.
NO_VARIANCE = 1e-9

Pass = Callable[[np.ndarray], tuple[float, np.ndarray]]


@dataclasses.dataclass(frozen=True)
class Whitening:
    """Rows and sums of the fit list, components (one a row), their variances, and the trace."""

    n: int
    sums: np.ndarray  # whole numbers (object where int64 doesn't hold n * x)
    components: np.ndarray
    variances: np.ndarray
    trace: float
    steps: int


# -- the table ----------------------------------------------------------------
def integer_rows(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and x (array of whole numbers) of the rows that take part."""
    v = F.col(vector_column)
    fit = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= LARGEST))
    return (
        table.where(F.col(id_column).isNotNull() & v.isNotNull() & (F.size(v) > 0))
        .where(fit)
        .select(
            F.col(id_column).cast("bigint").alias("vec_id"),
            F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + F.lit(SHIFT)).alias("x"),
        )
    )


def packed(rows: DataFrame, width: int) -> DataFrame:
    """vec_id and the row's x as bytes, so that a batch is one matrix without a copy."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            sizes = np.asarray(column.value_lengths())
            x = np.full((len(sizes), width), SHIFT, dtype=np.int64)
            begins = np.cumsum(sizes) - sizes
            x[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(begins, sizes)] = flat
            ends = np.arange(len(sizes) + 1, dtype=np.int32) * (8 * width)
            blob = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), blob], names=["vec_id", "x"])

    return rows.mapInArrow(pack, "vec_id bigint, x binary")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a packed column as a matrix of whole numbers."""
    _, offsets, data = column.buffers()
    first = int(np.frombuffer(offsets, np.int32)[column.offset]) if len(column) else 0
    return np.frombuffer(data, np.int64, count=len(column) * width, offset=first).reshape(-1, width)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: as int64 where ``sums`` is, else as Python's whole numbers."""
    return n * (x if sums.dtype != object else x.astype(object)) - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x minus the mean, rounded once."""
    return deviations(x, n, sums).astype(np.float64) / n


def summed(table: DataFrame, columns: str, add: Callable[[pa.Array], np.ndarray], size: int) -> np.ndarray:
    """The sum over all batches of ``add(batch's packed column)``, in the order of the tasks."""
    tasks = 2 * table.sparkSession.sparkContext.defaultParallelism

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size)
        for batch in batches:
            sums += add(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    parts = table.select(columns).coalesce(tasks).mapInArrow(total, "sums binary").collect()
    return sum((np.frombuffer(p["sums"]) for p in parts), np.zeros(size))


# -- bidiagonalisation --------------------------------------------------------
def _orthogonal(x: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in to:
            x = x - (v @ x) * v
    return x


def _new_direction(seed: int, to: list[np.ndarray], width: int) -> np.ndarray:
    x = _orthogonal(np.random.default_rng(seed).normal(size=width), to)
    return x / np.linalg.norm(x)


def bidiagonalise(product: Pass, width: int, rank: int, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(singular values, right singular vectors as rows, steps) of a table X: the ``wanted``
    largest. ``product(w)`` is (|X w|^2, X'X w), one pass; X has at most ``rank`` singular values."""
    vs: list[np.ndarray] = [_new_direction(0, [], width)]
    ws: list[np.ndarray] = []  # u = X w
    backs: list[np.ndarray] = []  # X'u
    alphas: list[float] = []
    betas: list[float] = []
    largest = 0.0
    while True:
        # The next u: X v less its shares in all earlier ones, of which beta * u is the last.
        w = vs[-1]
        for _ in range(2):
            for earlier, back in zip(ws, backs):
                w = w - (back @ w) * earlier
        square, back = product(w)
        alpha = float(np.sqrt(max(square, 0.0)))
        largest = max(largest, alpha)
        if alpha > 1e-13 * largest:
            w, back = w / alpha, back / alpha
        else:
            alpha, w, back = 0.0, np.zeros(width), np.zeros(width)  # X v is within the earlier ones
        alphas.append(alpha)
        ws.append(w)
        backs.append(back)
        # The next v: X'u less its shares in all earlier ones, of which alpha * v is the last.
        rest = _orthogonal(back, vs)
        beta = float(np.linalg.norm(rest))
        bidiagonal = np.diag(alphas) + np.diag(betas, 1)
        left, values, right = np.linalg.svd(bidiagonal)
        steps = len(alphas)
        top = min(wanted, steps)
        settled = width > FULL_WIDTH and steps >= wanted and bool((beta * np.abs(left[-1, :top]) <= SETTLED * max(values[0], 1e-300)).all())
        lost = beta <= 1e-13 * max(largest, 1e-300)
        if steps >= min(width, rank) or (settled and not lost):
            vectors = right[:top] @ np.array(vs)
            return values[:top], vectors, steps
        vs.append(_new_direction(steps, vs, width) if lost else _orthogonal(rest / beta, vs))
        vs[-1] = vs[-1] / np.linalg.norm(vs[-1])
        betas.append(0.0 if lost else beta)


def fit(table: DataFrame, width: int, wanted: int) -> Whitening:
    """Whitening of a packed table (vec_id, x)."""
    n = table.count()
    if not n:
        return Whitening(0, np.zeros(width), np.zeros((0, width)), np.zeros(0), 0.0, 0)
    sums, most = _exact_sums(table, width)
    small = n * most < 1 << 62
    sums = np.array(sums, dtype=np.int64 if small else object)

    def both(w: np.ndarray) -> Callable[[pa.Array], np.ndarray]:
        def add(column: pa.Array) -> np.ndarray:
            x = centred(matrix(column, width), n, sums)
            y = x @ w
            return np.concatenate([[y @ y], y @ x])

        return add

    def product(w: np.ndarray) -> tuple[float, np.ndarray]:
        got = summed(table, "x", both(w), width + 1)
        return got[0], got[1:]

    def squares(column: pa.Array) -> np.ndarray:
        return np.array([(centred(matrix(column, width), n, sums) ** 2).sum()])

    trace = float(summed(table, "x", squares, 1)[0]) / n
    if trace <= 0:
        return Whitening(n, sums, np.zeros((0, width)), np.zeros(0), 0.0, 0)
    values, vectors, steps = bidiagonalise(product, width, min(n, width), wanted)
    some = values > NO_VARIANCE * values[0]
    vectors = vectors[some]
    vectors = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return Whitening(n, sums, vectors * signs[:, None], values[some] ** 2 / n, trace, steps)


def _exact_sums(table: DataFrame, width: int) -> tuple[list[int], int]:
    """(sums of each entry, largest size of an entry), as Python's whole numbers."""
    tasks = 2 * table.sparkSession.sparkContext.defaultParallelism

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, most = [0] * width, 0
        for batch in batches:
            x = matrix(batch.column(0), width)
            if len(x):
                # Entries are below 2^53; their upper and lower halves sum up without overflow.
                high, low = (x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist()
                sums = [s + (h << 26) + l for s, h, l in zip(sums, high, low)]
                most = max(most, int(np.abs(x).max()))
        yield pa.RecordBatch.from_arrays([pa.array([",".join(map(str, [*sums, most]))])], names=["sums"])

    parts = [list(map(int, p["sums"].split(","))) for p in table.select("x").coalesce(tasks).mapInArrow(total, "sums string").collect()]
    sums = [sum(c) for c in zip(*(p[:-1] for p in parts))]
    return sums, max(p[-1] for p in parts)


# -- whitening ----------------------------------------------------------------
def _whitened(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """(n * x - S, whitened values) of a matrix of rows."""
    away = deviations(x, model.n, model.sums)
    return away, (away.astype(np.float64) / model.n) @ model.components.T / np.sqrt(model.variances)


def identity_error(table: DataFrame, width: int, model: Whitening) -> float:
    """The largest entry, in size, of the whitened rows' covariance minus the identity."""
    k = len(model.components)

    def add(column: pa.Array) -> np.ndarray:
        _, y = _whitened(matrix(column, width), model)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    got = summed(table, "x", add, k + k * k) / model.n
    covariance = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(table: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, component (from 1, by falling variance), n, deviation (the sum of (n * x - S)^2),
    whitened, explained (the component's share of all variance) and identity_error: a row for
    each row that takes part and each component that has variance."""
    spark = table.sparkSession
    scratch = Scratch(spark)
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = scratch.written(integer_rows(table, id_column, vector_column), "integer-rows")
    width = rows.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return spark.createDataFrame([], schema)
    fitted = scratch.written(packed(rows, width), "packed-rows")
    scratch.drop("integer-rows")
    model = fit(fitted, width, components)
    k = len(model.components)
    if not k:
        return spark.createDataFrame([], schema)
    error = identity_error(fitted, width, model)
    explained = model.variances / model.trace

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            away, values = _whitened(x, model)
            rows = len(x)
            sizes = np.abs(away).astype(np.float64)
            if (sizes**2).sum(axis=1).max(initial=0) < 1 << 62:
                square = pa.array((away.astype(np.int64) ** 2).sum(axis=1))
            else:
                exact = [sum(int(a) ** 2 for a in row) for row in away]
                square = pa.array([a if a < 1 << 63 else None for a in exact], pa.int64())
            of = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n)),
                    square.take(of),
                    pa.array(values.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return fitted.mapInArrow(apply, schema)


def whitening_query(spark, sf_dir: str) -> DataFrame:
    """Op 11: all embeddings, whitened to their 8 largest components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
