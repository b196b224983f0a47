"""Clustering of integer vectors around centroids by a bisector tournament.

A vector's components x become the integers floor(scale * x). For each pair of centroids w < c, the driver precomputes the
bisector between them in integers: normal 2 (c - w) and threshold |c|^2 - |w|^2. A vector is nearer to c exactly when
normal . vector > threshold, so k - 1 sign tests leave one centroid: the winner so far meets the next number, zero favours the
smaller number, and only the last winner's distance is computed. Tests run in blocks of an Arrow batch, in 64-bit floats
while a bound proves all sums exact (below 2^53), else in Python integers; the result is the same.

Each round is one scan: a task adds up its vectors per cluster, Spark sums these rows (at most k * dims a task, so a cluster
with most of the vectors is nothing special), and k * dims sums reach the driver. Nothing else is collected; the centroids
(k * dims integers) travel with the tasks. Rounds read the table again instead of keeping copies of it.

Defined cases: a vector that is null, has another number of components or a null, NaN or infinite one is left out; repeated rows
are vectors of their own; a null id may not start a centroid while others are left; equal ids are told apart by their
vectors; fewer vectors than k give that many clusters; an empty table gives an empty result; other columns are ignored. A component or
distance that 64 bits can't hold is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cadenza.llm.common import cut_table

CLUSTERS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
#: Sums below this bound are exact in 64-bit floats.
EXACT = 1 << 53


def usable(vector: Column, dims: int) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & good, F.lit(False))


def vectors(df: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(id, v) of the rows with a usable vector, v in doubles."""
    v = F.col(vector_col).cast("array<double>")
    return df.filter(usable(v, dims)).select(F.col(id_col).alias("id"), v.alias("v"))


def quantised(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of an Arrow column of vectors, as 64-bit integers."""
    x = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
    if x.size and not np.abs(x).max() < 2.0 ** 63:
        raise ValueError("a component doesn't fit in 64 bits")
    return x.astype(np.int64)


class Bisectors(NamedTuple):
    """normals[w, c] and thresholds[w, c] in Python integers: v is nearer to c than to w when normals . v > thresholds. Both are kept
    as floats too, used while ``weight`` (largest sum of a normal's absolute components) and ``reach`` (largest threshold) prove them exact."""
    normals: np.ndarray
    thresholds: np.ndarray
    weight: int
    reach: int
    as_floats: tuple[np.ndarray, np.ndarray]


def bisectors(centroids: np.ndarray) -> Bisectors:
    c = centroids.astype(object)
    square = (c * c).sum(axis=1)
    normals, thresholds = 2 * (c[None, :, :] - c[:, None, :]), square[None, :] - square[:, None]
    return Bisectors(normals, thresholds, int(np.abs(normals).sum(axis=2).max()), int(np.abs(thresholds).max()),
                     (normals.astype(np.float64), thresholds.astype(np.float64)))


def largest(v: np.ndarray) -> int:
    return max(int(v.max()), -int(v.min()), 1) if v.size else 1


def tournament(v: np.ndarray, pairs: Bisectors) -> np.ndarray:
    """The nearest centroid of each row; ties go to the smaller number."""
    winner = np.zeros(len(v), dtype=np.int64)
    exact = max(largest(v) * pairs.weight, pairs.reach) < EXACT
    normals, thresholds = pairs.as_floats if exact else (pairs.normals, pairs.thresholds)
    v = v.astype(np.float64 if exact else object)
    for c in range(1, len(normals)):
        held = winner.copy()
        for w in np.unique(held):
            rows = np.flatnonzero(held == w)
            winner[rows[v[rows] @ normals[w, c] > thresholds[w, c]]] = c
    return winner


def squared(v: np.ndarray, centroids: np.ndarray, winner: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows to their centroids."""
    far = largest(v) + largest(centroids)
    kind = np.int64 if far * far * v.shape[1] < 1 << 63 else object
    d = v.astype(kind) - centroids.astype(kind)[winner]
    d = (d * d).sum(axis=1)
    if kind is object and len(d) and max(d) >= 1 << 63:
        raise ValueError("a squared distance doesn't fit in 64 bits")
    return d.astype(np.int64)


def first_centroids(rows: DataFrame, k: int, scale: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:id``, as integers (k rows reach the driver)."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = rows.select(h.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([[int(x) for x in np.floor(scale * np.array(r["v"], dtype=np.float64))] for r in start], dtype=object)


def moved(rows: DataFrame, centroids: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of each non-empty cluster's components."""
    pairs = bisectors(centroids)
    k = len(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), dtype=object), [0] * k
        for b in batches:
            v = quantised(b.column(0), dims, scale)
            winner = tournament(v, pairs)
            small = largest(v) * len(v) < 1 << 63
            for c in np.unique(winner):
                mine = v[winner == c]
                total[c] += (mine if small else mine.astype(object)).sum(axis=0).astype(object)
                count[c] += len(mine)
        met = [c for c in range(k) if count[c]]
        yield pa.RecordBatch.from_arrays([
            pa.array([c for c in met for _ in range(dims)], pa.int32()), pa.array([p for _ in met for p in range(dims)], pa.int32()),
            pa.array([Decimal(int(total[c, p])) for c in met for p in range(dims)], pa.decimal128(38, 0)),
            pa.array([count[c] for c in met for _ in range(dims)], pa.int64())], ["cluster", "place", "total", "n"])

    part = rows.select("v").mapInArrow(sums, "cluster int, place int, total decimal(38,0), n long")
    new = centroids.copy()
    for r in part.groupBy("cluster", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("n").alias("n")).collect():  # k * dims
        new[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return new


def fit(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
        scale: int = SCALE, seed: int = 1) -> np.ndarray:
    """The centroids after ``rounds`` rounds, as integers (k rows at most)."""
    rows = vectors(df, id_col, vector_col, dims)
    centroids = first_centroids(rows, k, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids, dims, scale)
    return centroids


def assign(df: DataFrame, centroids: np.ndarray, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(id, cluster, distance) per usable vector; distance is the exact squared one."""
    rows = vectors(df, id_col, vector_col, dims)
    if not len(centroids):
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
    pairs = bisectors(centroids)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = quantised(b.column(1), dims, scale)
            winner = tournament(v, pairs)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(winner, pa.int32()), pa.array(squared(v, centroids, winner), pa.int64())],
                                             ["id", "cluster", "distance"])

    return rows.mapInArrow(nearest, f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance long")


def digest(centroid) -> str:
    """SHA-256 of a centroid's components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
            scale: int = SCALE, seed: int = 1) -> DataFrame:
    """One row per usable vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    centroids = fit(df, id_col, vector_col, k, rounds, dims, scale, seed)
    found = cut_table(assign(df, centroids, id_col, vector_col, dims, scale))
    per = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # at most k rows
    facts = [(c, s, sum(per.values()), digest(centroids[c])) for c, s in per.items()]
    facts = df.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
