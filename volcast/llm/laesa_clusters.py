"""Centroid clustering of integer vectors with a LAESA pivot table.

Every vector's distances to a few fixed pivots are worked out once and stored beside it.  In each
round the driver knows the centroids' distances to the pivots, and the largest difference of a
vector's and a centroid's pivot distances is a lower bound of their own distance.  The centroid with
the smallest bound gets an exact integer distance; of the others only those whose bound does not
exceed it survive and get theirs.  Bounds are lowered by more than their rounding error and ties
survive, so the result is that of comparing all centroids.

Vectors stay in their partitions: a round sends one sum per centroid and task, at most
``k * dims`` numbers come to the driver, and the centroids go out with the next round's tasks.  The
stored table is in the shared checkpoint folder, so a lost executor's tasks are run again from it.

Defined cases: vectors of another length, null, or with null or non-finite components take no part;
a null id takes part but becomes a seed only after all others; rows that repeat an id are vectors of
their own (of equal seed hashes the smaller components come first); equal vectors get equal results;
with fewer than ``k`` vectors there are fewer centroids; an empty table gives no rows; other columns
are ignored.  Scaled components must stay below 2**27 in absolute value, so that distances fit a
long: a larger one is an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volcast.llm.common import written

LIMIT = 1 << 27
#: Pivots, and the rows (smallest hashes) that they are picked from.
PIVOTS, PIVOT_SAMPLE = 16, 256
SLICE = 4096


def integer_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of long): floor(scale * x) of the vectors that take part."""
    x = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    usable = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return (x.where(F.size("x") == dims).where(usable)
            .select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("v")))


def smallest_hashes(vectors: DataFrame, prefix: str, n: int) -> list[list[int]]:
    """The ``n`` vectors with the smallest hashes of prefix and id, in that order (a bounded top-n)."""
    h = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    return [r.v for r in vectors.select(h.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(n).collect()]


def spread_out(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows of ``sample``, each the one with the largest sum of distances to those before."""
    chosen, total = [0], np.zeros(len(sample))
    for _ in range(min(n, len(sample)) - 1):
        total += np.sqrt(((sample - sample[chosen[-1]]) ** 2).sum(1).astype(float))
        total[chosen] = -1.0
        chosen.append(int(total.argmax()))
    return sample[chosen]


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((v - p) ** 2).sum(1).astype(np.float64)) for p in pivots], axis=1)


def nearest(v: np.ndarray, stored: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of every row of ``v``, and the number of exact distances worked out."""
    of_centroid = pivot_distances(centroids, pivots)
    bound = np.zeros((len(v), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(stored[:, p, None] - of_centroid[None, :, p]), out=bound)
    bound = np.maximum(0.0, bound - 1e-9 * (1.0 + stored.max(1)[:, None] + of_centroid.max(1)[None]))
    cluster = bound.argmin(1)
    best = ((v - centroids[cluster]) ** 2).sum(1)
    survives = bound * bound <= best[:, None].astype(np.float64)
    survives[np.arange(len(v)), cluster] = False
    exact = len(v) + int(survives.sum())
    for c in range(len(centroids)):
        rows = np.flatnonzero(survives[:, c])
        if len(rows):
            d = ((v[rows] - centroids[c]) ** 2).sum(1)
            better = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
            best[rows[better]], cluster[rows[better]] = d[better], c
    return cluster, best, exact


def _rows(batch: pa.RecordBatch, dims: int, n_pivots: int):
    """(ids, vectors, stored distances) of slices of a batch of the stored table."""
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        yield (part.column(0), part.column(1).flatten().to_numpy().astype(np.int64).reshape(-1, dims),
               part.column(2).flatten().to_numpy().reshape(-1, n_pivots))


def pivot_table(spark: SparkSession, vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vec_id, v, stored (distances to the pivots), written once."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                v = part.column(1).flatten().to_numpy().reshape(-1, pivots.shape[1])
                d = pivot_distances(v, pivots)
                offsets = np.arange(0, d.size + 1, d.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(np.arange(0, v.size + 1, v.shape[1], dtype=np.int32),
                                                              pa.array(v.ravel().astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(d.ravel()))], ["vec_id", "v", "stored"])

    return written(spark, vectors.mapInArrow(run, "vec_id long, v array<int>, stored array<double>"), "laesa-table")


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: componentwise floor of the mean; an empty one stays."""
    k, dims = centroids.shape

    def sums(batches):
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for _, v, stored in _rows(batch, dims, len(pivots)):
                cluster, _, _ = nearest(v, stored, centroids, pivots)
                count += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster).tolist():
                    total[c] += v[cluster == c].sum(0)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(count[held]),
                                          pa.array(total[held].tolist(), pa.list_(pa.int64()))], ["c", "n", "sums"])

    parts = table.mapInArrow(sums, "c int, n long, sums array<long>").select("c", "n", F.posexplode("sums").alias("i", "s"))
    new = centroids.copy()
    for r in parts.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        new[r.c, r.i] = int(r.s) // r.n
    return new


def assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for ids, v, stored in _rows(batch, dims, len(pivots)):
                cluster, distance, _ = nearest(v, stored, centroids, pivots)
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)],
                                                 ["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, "vec_id long, cluster int, distance long")


def centroid_clusters(spark: SparkSession, vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024,
                      seed: str = "3:", n_pivots: int = PIVOTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    ints = integer_vectors(vectors, dims, scale, id_col, vector_col)
    widest = ints.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()[0]
    if widest is None:
        return spark.createDataFrame([], schema)
    if widest >= LIMIT:
        raise ValueError(f"a scaled component reaches {widest}; distances of such vectors do not fit a long")
    centroids = np.array(smallest_hashes(ints, seed, k), dtype=np.int64)
    pivots = spread_out(np.array(smallest_hashes(ints, "pivot:", PIVOT_SAMPLE), dtype=np.int64), n_pivots)
    table = pivot_table(spark, ints, pivots)
    for _ in range(rounds):
        centroids = moved(table, centroids, pivots)
    out = written(spark, assigned(table, centroids, pivots), "laesa-clusters")
    sums = {r.cluster: int(r.s) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    of_cluster = [sums.get(c, 0) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return out.select("vec_id", "cluster", "distance",
                      F.get(F.array(*[F.lit(s).cast("long") for s in of_cluster]), F.col("cluster")).alias("cluster_inertia"),
                      F.lit(sum(of_cluster)).cast("long").alias("inertia"),
                      F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"))
