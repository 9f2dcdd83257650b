"""Centroid clustering in whole numbers, with nearest centroids by the threshold algorithm.

Every dimension keeps a list of all centroids in order of their value there.  A vector walks each list
outward from its own value, one centroid of each list at a time, nearer side first.  A
centroid met for the first time gets its exact distance.  What no list has shown yet is at least as far
in every dimension as the list's frontier, so the walk ends once the sum of the squared frontier distances
strictly exceeds the best exact distance (or all centroids were met).  Strictly, since a centroid
of equal distance and smaller number would still win.

A round is one pass over the stored vectors: a task adds up its vectors by centroid, and only these sums
(as many rows as centroids) leave it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.frames import map_arrow, quoted, stored

WIDTH, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
#: Numbers of (vectors x centroids x dimensions) that a task holds at a time.
_BLOCK = 1 << 21


class SortedLists:
    """The centroids of each dimension by value, with an end mark on either side."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        order = np.argsort(centroids, axis=0, kind="stable")
        far = np.full((1, centroids.shape[1]), 1 << 40)
        self.values = np.concatenate([-far, np.take_along_axis(centroids, order, axis=0), far])
        edge = np.zeros((1, centroids.shape[1]), dtype=order.dtype)
        self.owners = np.concatenate([edge, order, edge])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (the smallest of equally near ones) and its squared distance."""
        step = max(1, _BLOCK // max(self.centroids.size, 1))
        parts = [self._walk(vectors[i:i + step]) for i in range(0, len(vectors), step)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, d = self.centroids.shape
        lists = np.arange(d)
        up = np.column_stack([np.searchsorted(self.values[:, j], x[:, j]) for j in lists])
        down = up - 1
        best, label = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), k)
        out_label, out_best = label.copy(), best.copy()
        met = np.zeros((len(x), k), dtype=bool)
        at = np.arange(len(x))
        while len(at):
            below, above = x - self.values[down, lists], self.values[up, lists] - x
            lower = below <= above
            gap = np.where(lower, below, above)
            shown = np.where(lower, self.owners[down, lists], self.owners[up, lists])
            down, up = down - lower, up + ~lower
            here = np.zeros_like(met)
            here[np.arange(len(x))[:, None], shown] = True
            here &= ~met
            met |= here
            row, number = np.nonzero(here)
            exact = np.full(met.shape, np.iinfo(np.int64).max)
            exact[row, number] = ((x[row] - self.centroids[number]) ** 2).sum(axis=1)
            first = exact.argmin(axis=1)
            least = exact[np.arange(len(x)), first]
            better = (least < best) | ((least == best) & (first < label))
            best, label = np.where(better, least, best), np.where(better, first, label)
            going = ((gap * gap).sum(axis=1) <= best) & ~met.all(axis=1)
            out_label[at[~going]], out_best[at[~going]] = label[~going], best[~going]
            x, up, down, best, label, met, at = (a[going] for a in (x, up, down, best, label, met, at))
        return out_label, out_best


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(id, v): the vectors of ``width`` components, none null or non-finite, each as floor(scale * x)."""
    # Beyond this a squared distance may not fit a long.
    limit = math.isqrt((2 ** 63 - 1) // width) // 2
    scaled = F.transform(quoted(vector_column).cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))
    fits = F.forall(quoted(vector_column).cast("array<double>"),
                    lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float(limit) / scale)))
    whole = rows.where((F.size(quoted(vector_column)) == width) & fits)
    return whole.select(quoted(id_column).alias("id"), scaled.cast("array<int>").alias("v"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.asarray(batch.column("v").flatten()).astype(np.int64).reshape(-1, width)


def _moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: each the floor of the mean of its vectors, or itself where it has none."""
    k, d = centroids.shape

    def sums(batches):
        lists = SortedLists(centroids)
        total = np.zeros((k, d + 1), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch, d)
            label, _ = lists.nearest(x)
            order = np.argsort(label, kind="stable")
            held, start, n = np.unique(label[order], return_index=True, return_counts=True)
            if len(held):
                total[held, :d] += np.add.reduceat(x[order], start, axis=0)
                total[held, d] += n
        some = np.flatnonzero(total[:, d])
        ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * (d + 1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.ListArray.from_arrays(ends, pa.array(total[some].ravel()))], ["cluster", "sums"])

    parts = map_arrow(points.select("v"), sums, "cluster long, sums array<bigint>")
    found = parts.groupBy("cluster").agg(*[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(d + 1)]).collect()  # k rows at most
    out = centroids.copy()
    for r in found:
        out[r[0]] = np.array(r[1:d + 1], dtype=np.int64) // r[d + 1]
    return out


def first_centroids(points: DataFrame, count: int, salt: str = "2:") -> np.ndarray:
    """The vectors of the ids with the smallest SHA-256 of ``salt`` and the decimal id, in that order."""
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256)
    rows = points.where("id is not null").select(key.alias("key"), "v").orderBy("key", "v").limit(count).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def clusters(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", centroids: int = CENTROIDS,
             rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every whole vector after ``rounds`` rounds, and the final centroids.

    A null vector, one of another width, and one with a null or non-finite component has no row, nor has one
    with a component of 2^27 / scale or more (for width 64), whose distance may not fit a long.  Equal
    vectors and repeated ids are rows of their own; among rows of one id the smaller vector starts a centroid
    first.  A vector whose id is null is assigned and counted but starts no centroid.  With fewer vectors
    than ``centroids`` there are as many centroids as vectors with an id; without any there are no rows.
    Columns beyond the two named are not read.
    """
    kind = rows.schema[id_column].dataType.simpleString()
    points = stored(whole_vectors(rows, id_column, vector_column, width, scale), "centroid-points")
    centres = first_centroids(points, centroids)
    if not len(centres):
        return rows.sparkSession.createDataFrame([], f"id {kind}, cluster int, distance long"), centres
    for _ in range(rounds):
        centres = _moved(points, centres)

    def assigned(batches):
        lists = SortedLists(centres)
        for batch in batches:
            label, distance = lists.nearest(_matrix(batch, width))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(label.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return stored(map_arrow(points, assigned, f"id {kind}, cluster int, distance long"), "centroid-labels"), centres


def centroid_digest(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centre.tolist())).encode()).hexdigest()


def with_inertia(labels: DataFrame, centres: np.ndarray) -> DataFrame:
    """``labels`` with the inertia of the cluster and of all, and the digest of the centroid.

    Sums that do not fit a long are null.
    """
    spark = labels.sparkSession
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = {r[0]: int(r[1]) for r in labels.groupBy("cluster").agg(total).collect()}  # one row a centroid
    fitting = lambda n: n if n < 2 ** 63 else None
    every = fitting(sum(by_cluster.values()))
    table = [(c, fitting(n), every, centroid_digest(centres[c])) for c, n in sorted(by_cluster.items())]
    about = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return labels.join(F.broadcast(about), "cluster")
