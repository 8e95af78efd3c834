"""Integer k-means whose rounds rule centroids out by stored distances to pivots (LAESA).

Distances of every vector to a few fixed pivots are stored once. By the triangle
inequality no centroid is nearer to a vector than the largest difference of their
distances to a pivot, so each round computes exact integer distances only to the
centroids that this bound leaves.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorisk.llm.common import map_batches, materialise

#: Largest component after scaling: squares of 64 differences then fit a long, with room for sums.
MOST = 1 << 24
_LONG = pa.int64()


@dataclass(frozen=True)
class Clustering:
    """``dims`` components of a vector, ``scale`` before rounding down, ``seed`` of the hash that picks the first centroids."""

    dims: int = 64
    scale: int = 1024
    clusters: int = 8
    rounds: int = 10
    pivots: int = 12
    seed: str = "3"


def integer_vectors(vectors: DataFrame, how: Clustering, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Columns of ``key`` and v: vectors of exactly ``dims`` finite components, each scaled and rounded down.

    Others go. A component beyond ±2^24 counts as that bound.
    """
    x = F.col(column)
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    kept = vectors.where(x.isNotNull() & (F.size(x) == how.dims)).where(~odd)
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(e.cast("double") * how.scale, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int"))
    return kept.select(F.col(key).alias("key"), whole.alias("v"))


def _first(vectors: DataFrame, seed: str, n: int) -> np.ndarray:
    """The ``n`` vectors with the smallest hash of ``seed:key``; of a repeated key the smallest vector first."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(named, 256), "v").limit(n).select("v").collect()
    return np.array([r.v for r in rows], np.int64)


def _components(column: pa.ListArray, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to rows."""
    gap = a.astype(np.int64) - b
    return np.einsum("ij,ij->i", gap, gap)


def nearest(v: np.ndarray, table: np.ndarray, centroids: np.ndarray, centroid_table: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each row of ``v``, and how many distances were computed.

    ``table`` and ``centroid_table`` hold distances to the pivots. The centroid with the
    least bound is measured first; then those whose bound does not exceed the least
    distance so far. Bounds are lowered by more than rounding can raise them. Of equal
    distances the smaller number wins, so a bound equal to the distance is measured too.
    """
    bound = np.zeros((len(v), len(centroids)))
    for p in range(table.shape[1]):
        np.maximum(bound, np.abs(table[:, p, None] - centroid_table[None, :, p]), out=bound)
    bound = np.maximum(bound * (1 - 1e-12) - 1e-6, 0) ** 2 * (1 - 1e-12)
    best = bound.argmin(1)
    least, computed = squared(v, centroids[best]), len(v)
    bound[np.arange(len(v)), best] = np.inf
    for c in range(len(centroids)):
        rows = np.flatnonzero(bound[:, c] <= least)
        gaps = squared(v[rows], centroids[c])
        better = (gaps < least[rows]) | ((gaps == least[rows]) & (c < best[rows]))
        best[rows[better]], least[rows[better]] = c, gaps[better]
        computed += len(rows)
    return best, least, computed


def _pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(v, p) for p in pivots], 1).astype(float))


def _assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """Columns key, cluster, distance."""
    dims, known = centroids.shape[1], _pivot_distances(centroids, pivots)
    schema = T.StructType([table.schema["key"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, far = _components(batch["v"], dims), _components(batch["far"], len(pivots))
            best, least, _ = nearest(v, far, centroids, known)
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(best, pa.int32()), pa.array(least, _LONG)], ["key", "cluster", "distance"])

    return map_batches(table, work, schema)


def _cluster_sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> list:
    """Rows cluster, dim, total, n: sums over each cluster. Every task sends clusters times dims rows at most."""
    k, dims, known = *centroids.shape, _pivot_distances(centroids, pivots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            v, far = _components(batch["v"], dims), _components(batch["far"], len(pivots))
            best, _, _ = nearest(v, far, centroids, known)
            for c in np.unique(best):
                members = best == c
                totals[c] += v[members].sum(0, dtype=np.int64)
                n[c] += members.sum()
        cluster, dim = np.divmod(np.arange(k * dims), dims)
        columns = [cluster, dim, totals.ravel(), n[cluster]]
        there = np.repeat(n > 0, dims)
        yield pa.RecordBatch.from_arrays([pa.array(c[there], _LONG) for c in columns], ["cluster", "dim", "total", "n"])

    sums = map_batches(table, work, "cluster bigint, dim bigint, total bigint, n bigint")
    exact = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("total", "n")]
    return sums.groupBy("cluster", "dim").agg(*exact).collect()


def cluster(vectors: DataFrame, how: Clustering = Clustering(), key: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """The table key, cluster, distance of all kept vectors, and the final centroids.

    Ties of distance go to the smaller number; an empty cluster keeps its centroid. With
    fewer kept vectors than clusters there are as many clusters as vectors, and none of
    an empty table. The driver holds the centroids, the pivots and one sum for each
    component of a centroid, whatever the number of vectors.
    """
    whole = materialise(integer_vectors(vectors, how, key, column), "vectors")
    centroids = _first(whole, how.seed, how.clusters)
    if not len(centroids):
        return whole.select("key", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance")), centroids
    pivots = _first(whole, f"pivot-{how.seed}", how.pivots)
    schema = T.StructType([*whole.schema, T.StructField("far", T.ArrayType(T.DoubleType()))])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _pivot_distances(_components(batch["v"], how.dims), pivots)
            offsets = pa.array(np.arange(len(far) + 1) * len(pivots), pa.int32())
            column = pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "far"])

    table = materialise(map_batches(whole, measured, schema), "pivot-table")
    for _ in range(how.rounds):
        moved = centroids.copy()
        for r in _cluster_sums(table, centroids, pivots):
            moved[r.cluster, r.dim] = int(r.total) // int(r.n)
        centroids = moved
    return materialise(_assigned(table, centroids, pivots), "assigned"), centroids


def with_inertia(assigned: DataFrame) -> DataFrame:
    """Adds cluster_inertia and inertia, the distances summed over the cluster and over all; null if beyond a long.

    One row for each cluster is broadcast.
    """
    summed = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_of_cluster"))
    everything = summed.agg(F.sum("_of_cluster").alias("_of_all"))

    def long(name: str) -> Column:
        return F.col(name).try_cast("bigint")

    sums = summed.crossJoin(F.broadcast(everything))  # one row
    return assigned.join(F.broadcast(sums), "cluster").select(
        *assigned.columns, long("_of_cluster").alias("cluster_inertia"), long("_of_all").alias("inertia")
    )
