"""Operator 1: exact top-k inner products through a pivot-distance index.

A component x of a vector counts as floor(256 * x). One more coordinate, sqrt(M^2 - |v|^2) with M
the largest norm, gives every vector the norm M; then a query q (whose coordinate is 0) has
|q - v|^2 = |q|^2 + M^2 - 2 q.v, so the highest inner products are the smallest distances.

* Index: a vector belongs to its nearest pivot (its cell) and, by the distance to that pivot, to
  a ring of the cell. A directory holds each ring's number of vectors and least and greatest
  distance: at most ``MOST_PIVOTS * (RINGS + 1)`` rows, so it is collected and sent to tasks.
* Search: by the triangle inequality no vector of a ring is nearer to q than the gap between
  d(q, pivot) and the ring's range of distances, nor than half of d(q, pivot) minus q's distance
  to its nearest pivot. Rings are visited in order of these bounds: first until they hold k
  vectors besides the query's own row, which bounds the k-th distance; then all rings whose bound
  is within it. The rest cannot hold a better vector.
* A ring's vectors are dealt out in chunks of about ``CHUNK`` and queries in blocks of about
  ``QUERY_BLOCK``, so a group in a task is bounded, also where many rows are one vector. A group
  is one matrix product and returns k candidates of each query at most. A chunk is sent to the
  blocks that hold a query which visits it.

Pivots are fitted to a sample of ``SAMPLE`` vectors (k-means on the driver); the index holds
every row and the result is exact whatever the pivots.

Defined results: a vector that is null or empty or holds a null or non-finite component, or one whose
whole number is beyond 2^52 in size, and a row without an id, take no part. Scores are exact; one
beyond the range of a long counts as the nearest long. A shorter vector counts as filled up with zeros. Scores tie to the smaller
vec_id. Rows of one vec_id are one candidate, with its best score, and one query, with the best
of its rows. Fewer than k candidates give fewer rows; an empty table gives none. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagecraft.llm.common import Scratch

K = 5
SCALE = 256
# Pivots: half the square root of the number of vectors, within these bounds.
FEWEST_PIVOTS, MOST_PIVOTS = 48, 1024
RINGS = 12
SAMPLE = 8192
CHUNK = 1024
QUERY_BLOCK = 4096
# Whole components from this size on (as a double holds them no longer) take no part.
LARGEST = float(1 << 52)
# Distances are floating point; bounds give way by this share of the norm that all vectors have.
SLACK = 1e-6
LONG = (1 << 63) - 1


@dataclasses.dataclass(frozen=True)
class Index:
    """Pivots (rows, in the lifted space), M squared, the width of a ring, and the directory:
    cell, ring, chunks, vectors and distance range of each ring, as columns."""

    pivots: np.ndarray
    norm2: float
    width: float
    rings: dict[str, np.ndarray] | None = None


def integer_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and v (array of whole numbers) of the rows that take part."""
    v = F.col(vector_column)
    fit = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * SCALE >= LARGEST))
    return (
        table.where(F.col(id_column).isNotNull() & v.isNotNull() & (F.size(v) > 0))
        .where(fit)
        .select(
            F.col(id_column).cast("bigint").alias("vec_id"),
            F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint")).alias("v"),
        )
    )


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of an array column as a matrix, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.asarray(column.value_lengths())
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def lifted(vectors: np.ndarray, norm2: float) -> np.ndarray:
    """Vectors with the coordinate that gives them all the norm M."""
    rest = np.sqrt(np.maximum(norm2 - (vectors**2).sum(axis=1), 0.0))
    return np.column_stack([vectors, rest])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def fit_pivots(sample: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of the sample, begun at rows spread over it."""
    sample = np.unique(sample, axis=0)
    if not len(sample):
        return sample
    centres = sample[np.unique(np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int))]
    for _ in range(rounds):
        nearest = distances(sample, centres).argmin(axis=1)
        used = np.unique(nearest)
        centres = np.stack([sample[nearest == c].mean(axis=0) for c in used])
    return centres


def build_index(vectors: DataFrame) -> tuple[Index, DataFrame, int]:
    """(index, vectors with cell and ring, width of a vector) of a table vec_id, v."""
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    told = vectors.agg(F.max(squares).alias("norm2"), F.max(F.size("v")).alias("width"), F.count("*").alias("n")).first()
    width = told["width"] or 1
    norm2 = float(told["norm2"] or 0) * (1 + 1e-12)
    n_pivots = max(FEWEST_PIVOTS, min(MOST_PIVOTS, math.isqrt(told["n"]) // 2))
    first = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    sample = lifted(matrix(first.column("v"), width), norm2) if first.num_rows else np.zeros((0, width + 1))
    pivots = fit_pivots(sample, n_pivots)
    near = distances(sample, pivots).min(axis=1) if len(sample) else np.zeros(1)
    index = Index(pivots, norm2, max(float(near.max()) / RINGS, 1e-9))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = distances(lifted(matrix(batch.column(1), width), norm2), index.pivots)
            cell = d.argmin(axis=1) if len(d) else np.zeros(0, int)
            least = d[np.arange(len(d)), cell]
            ring = np.minimum(least // index.width, RINGS).astype(np.int32)  # the last ring is open
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(ring), pa.array(least)],
                names=["vec_id", "v", "cell", "ring", "d"],
            )

    if not len(pivots):
        placed = vectors.select("*", F.lit(0).alias("cell"), F.lit(0).alias("ring"), F.lit(0.0).alias("d"))
    else:
        placed = vectors.mapInArrow(assign, "vec_id bigint, v array<bigint>, cell int, ring int, d double")
    rows = (
        placed.groupBy("cell", "ring")
        .agg(F.count("*").alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
        .orderBy("cell", "ring")
        .collect()
    )
    rings = {c: np.array([r[c] for r in rows]) for c in ("cell", "ring", "n", "low", "high")}
    rings["chunks"] = -(-rings["n"] // CHUNK)
    return dataclasses.replace(index, rings=rings), placed, width


def ring_bounds(index: Index, queries: np.ndarray) -> np.ndarray:
    """For each query and ring, a distance that no vector of the ring goes below."""
    points = np.column_stack([queries, np.zeros(len(queries))])
    to_pivot = distances(points, index.pivots)
    d = to_pivot[:, index.rings["cell"]]
    outside = np.maximum(index.rings["low"][None, :] - d, d - index.rings["high"][None, :])
    half = (d - to_pivot.min(axis=1)[:, None]) / 2
    return np.maximum(np.maximum(outside, half), 0.0) - SLACK * (1 + math.sqrt(index.norm2))


def home_rings(index: Index, bounds: np.ndarray, k: int, own: int = 1) -> np.ndarray:
    """Mask of the rings that a query visits first: nearest first, until they hold k + own vectors."""
    order = np.argsort(bounds, axis=1, kind="stable")
    held = np.cumsum(index.rings["n"][order], axis=1)
    first = held - index.rings["n"][order] < k + own
    mask = np.zeros(bounds.shape, dtype=bool)
    np.put_along_axis(mask, order, first, axis=1)
    return mask


def visits(queries: DataFrame, index: Index, width: int, k: int, query_blocks: int, later: bool) -> DataFrame:
    """A row for each query and chunk of vectors that it visits. ``queries`` has query_id, v and
    kth (the k-th best score so far; null at first, or where there are fewer than k)."""
    schema = "cell int, ring int, chunk int, query_block int, query_id bigint, v array<bigint>, kth bigint"

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rings = index.rings
        slack = SLACK * (1 + math.sqrt(index.norm2))
        several = max(16, (1 << 20) // max(len(rings["n"]), 1))
        for whole in batches:
            for at in range(0, whole.num_rows, several):
                batch = whole.slice(at, several)
                q = matrix(batch.column(1), width)
                bounds = ring_bounds(index, q)
                mask = home_rings(index, bounds, k)
                if later:
                    kth = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
                    reach2 = (q**2).sum(axis=1) + index.norm2 - 2 * kth
                    reach = np.where(np.isnan(kth), np.inf, np.sqrt(np.maximum(reach2, 0.0)) + slack)
                    mask = ~mask & (bounds <= reach[:, None])
                row, ring = np.nonzero(mask)
                times = rings["chunks"][ring]
                chunk = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, ring = np.repeat(row, times), np.repeat(ring, times)
                taken = batch.take(pa.array(row))
                block = _spread(taken.column(0).to_numpy(), query_blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rings["cell"][ring], pa.int32()),
                        pa.array(rings["ring"][ring], pa.int32()),
                        pa.array(chunk, pa.int32()),
                        pa.array(block, pa.int32()),
                        *taken.columns,
                    ],
                    names=["cell", "ring", "chunk", "query_block", "query_id", "v", "kth"],
                )

    return queries.select("query_id", "v", "kth").mapInArrow(visit, schema)


def _spread(ids: np.ndarray, n: int) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % n


def whole_products(vectors: pa.ChunkedArray, queries: pa.ChunkedArray, width: int):
    """A function of some of the queries that gives their inner products with the vectors, exact, as
    int64; one beyond the range of a long counts as the nearest long."""
    v, q = matrix(vectors, width), matrix(queries, width)
    bound = float(np.sqrt((v**2).sum(axis=1).max(initial=0)) * np.sqrt((q**2).sum(axis=1).max(initial=0)))
    if bound < 1 << 52:  # every partial sum is a whole number that a double holds
        return lambda some: (matrix(some, width) @ v.T).astype(np.int64)
    if bound < 1 << 62:
        v = v.astype(np.int64)
        return lambda some: matrix(some, width).astype(np.int64) @ v.T
    v = v.astype(np.int64).astype(object)
    return lambda some: np.clip(matrix(some, width).astype(np.int64).astype(object) @ v.T, -LONG, LONG).astype(np.int64)


def best_of(scores: np.ndarray, take: int) -> np.ndarray:
    """Mask of each row's ``take`` highest scores, those further left first among equal ones."""
    least = np.partition(scores, scores.shape[1] - take, axis=1)[:, scores.shape[1] - take][:, None]
    more, tied = scores > least, scores == least
    return more | (tied & (np.cumsum(tied, axis=1) <= take - more.sum(axis=1, keepdims=True)))


def scored(chunks: DataFrame, wanted: DataFrame, width: int, k: int) -> DataFrame:
    """query_id, vec_id and score: of each visited chunk, a query's k best vectors (only those
    that reach ``kth`` where it is known)."""

    def best(key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if vectors.num_rows and queries.num_rows:
            vectors = vectors.sort_by("vec_id")
            ids = vectors.column("vec_id").to_numpy()
            v = vectors.column("v")
            repeats = int(np.unique(ids, return_counts=True)[1].max())
            take = min(k * repeats, len(ids))
            all_q = queries.column("query_id").to_numpy()
            known = ~np.asarray(queries.column("kth").is_null())
            all_kth = queries.column("kth").fill_null(0).to_numpy()
            exact = whole_products(v, queries.column("v"), width)
            for at in range(0, len(all_q), 512):
                q_ids, kth = all_q[at : at + 512], all_kth[at : at + 512]
                scores = exact(queries.column("v").slice(at, 512))
                own = q_ids[:, None] == ids[None, :]
                fine = ~own & ~(known[at : at + 512, None] & (scores < kth[:, None]))
                row, nth = np.nonzero(best_of(np.where(own, -LONG - 1, scores), take) & fine)
                out_q.append(q_ids[row])
                out_v.append(ids[nth])
                out_s.append(scores[row, nth])
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table({"query_id": join(out_q), "vec_id": join(out_v), "score": join(out_s)})

    by = ["cell", "ring", "chunk", "query_block"]
    return (
        chunks.groupBy(*by)
        .cogroup(wanted.groupBy(*by))
        .applyInArrow(best, "query_id bigint, vec_id bigint, score bigint")
    )


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best."""
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def top_k(table: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the k rows with the highest inner product with each row
    that meets ``is_query`` (a condition on ``vec_id``), among all rows but its own."""
    vectors = integer_vectors(table, id_column, vector_column)
    index, placed, width = build_index(vectors)
    if not len(index.pivots):
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    queries = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    query_blocks = -(-queries.count() // QUERY_BLOCK) or 1
    sizes = {(int(c), int(r)): int(n) for c, r, n in zip(*(index.rings[x] for x in ("cell", "ring", "chunks")))}
    several = [x for key, n in sizes.items() if n > 1 for x in (F.lit(key[0] * (RINGS + 1) + key[1]), F.lit(n))]
    chunks_of = F.coalesce(F.create_map(*several)[F.col("cell") * (RINGS + 1) + F.col("ring")], F.lit(1)) if several else F.lit(1)
    chunks = placed.select("cell", "ring", F.pmod(F.xxhash64("vec_id"), chunks_of).cast("int").alias("chunk"), "vec_id", "v")
    scratch = Scratch(table.sparkSession)
    chunks = scratch.written(chunks, "chunks")

    def search(wanted: DataFrame, name: str) -> DataFrame:
        """Candidates from the chunks that ``wanted`` visits; a chunk goes to those blocks of queries
        that visit it, and to no others."""
        wanted = scratch.written(wanted, f"{name}-visits")
        by = scratch.written(wanted.select("cell", "ring", "chunk", "query_block").distinct(), f"{name}-visited")
        return scored(chunks.join(by, ["cell", "ring", "chunk"]), wanted, width, k)

    near = visits(queries.withColumn("kth", F.lit(None).cast("bigint")), index, width, k, query_blocks, False)
    near = scratch.written(search(near, "near"), "near")
    kth = ranked(near, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    far = search(visits(queries.join(kth, "query_id", "left"), index, width, k, query_blocks, True), "far")
    return ranked(near.unionByName(far), k)


def topk_query(spark, sf_dir: str) -> DataFrame:
    """Op 1: the 5 best of all embeddings for each vec_id that 50 divides."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(table, F.col("vec_id") % 50 == 0)


TOPK_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score
FROM scores
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""
