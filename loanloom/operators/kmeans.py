"""K-means with all restarts, and all cluster counts, in one scan a round; and the silhouette by plain distances.

A round meets every row with the centres of every run that still moves.  A task adds up its rows by run
and cluster; as many rows as there are centres leave it.  Seeds are drawn as in k-means++, by weighted
reservoirs: the next centre of a run is the row with the least ``-log(u) / squared distance to its centres``, with u a hash of
row, run and step, so that one scan gives all runs their next centre and a retried task the same one.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.session import materialise

#: A run has settled when its centres together move no farther (root of the summed squares); and rounds at most.
TOLERANCE, ROUNDS = 1e-3, 300
#: Rows of a block of the silhouette, and blocks at most: blocks of very many rows are larger, as each row's sums are handed on once a block.
SILHOUETTE_BLOCK, SILHOUETTE_BLOCKS = 65_536, 24
_ROWS = 4096
#: Rows that meet at once, and the square of a distance, as a share of the rows' squared lengths, below which it is taken by differences.
_HIGH, _WIDE, _CLOSE = 256, 512, 1e-5


@dataclass
class Centres:
    """The fitted centres of one run."""
    centres: np.ndarray
    cost: float
    rounds: int

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, vectors: DataFrame) -> DataFrame:
        """``vectors`` with the number of the nearest centre as ``prediction``; ties go to the smaller number."""
        x = vector_to_array("features")
        options = []
        for number, centre in enumerate(self.centres):
            squares = [(x[j] - F.lit(float(c))) * (x[j] - F.lit(float(c))) for j, c in enumerate(centre)]
            options.append(F.struct(sum(squares[1:], squares[0]).alias("distance"), F.lit(number).alias("number")))
        return vectors.withColumn("prediction", F.array_min(F.array(*options))["number"])


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) from row hashes."""
    x = h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)
    return np.maximum(out, 0.0)


def nearest(far: np.ndarray, ends: Sequence[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """From the distances (centre, row): those to the nearest centre of each run, and 1 where a row belongs to a centre; ties go to the smaller number.

    A centre at a time meets all rows: rows are many and the centres of a run few.
    """
    near, member = [], np.zeros(far.shape)
    for a, b in zip(ends[:-1], ends[1:]):
        least, label = far[a].copy(), np.zeros(far.shape[1], dtype=np.int16)
        for c in range(a + 1, b):
            closer = far[c] < least
            np.copyto(least, far[c], where=closer)
            np.copyto(label, c - a, where=closer)
        np.equal(label, np.arange(b - a, dtype=np.int16)[:, None], out=member[a:b], casting="unsafe")
        near.append(least)
    return near, member


def _pieces(batch: pa.RecordBatch, width: int):
    """Row hashes and matrix of some rows at a time."""
    x = np.asarray(batch.column("x").flatten(), dtype=float).reshape(-1, width)
    h = np.asarray(batch.column("h")).view(np.uint64)
    for i in range(0, len(x), _ROWS):
        yield h[i:i + _ROWS], x[i:i + _ROWS]


def _rows(vectors: DataFrame, key: str) -> DataFrame:
    return vectors.select(F.xxhash64(key).alias("h"), vector_to_array("features").alias("x"))


def seeds(rows: DataFrame, width: int, runs: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """First centres of each run (cluster count, seed): a scan for each centre, for all runs at once."""
    chosen: list[list] = [[] for _ in runs]
    for step in range(max(k for k, _ in runs)):
        open_ = [(r, seed, np.array(chosen[r], dtype=float).reshape(-1, width)) for r, (k, seed) in enumerate(runs) if k > step]

        def least(batches, step=step, open_=open_):
            best: dict[int, tuple[float, list]] = {}
            for batch in batches:
                for h, x in _pieces(batch, width):
                    for r, seed, centres in open_:
                        u = _uniform(h, seed * 1009 + step)
                        far = squared_distances(centres, x).min(axis=0) if len(centres) else np.ones(len(x))
                        with np.errstate(divide="ignore"):
                            key = -np.log(u) / far
                        at = int(key.argmin())
                        if r not in best or key[at] < best[r][0]:
                            best[r] = (float(key[at]), x[at].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([k for k, _ in best.values()], pa.float64()),
                                              pa.array([c for _, c in best.values()], pa.list_(pa.float64()))], ["run", "key", "centre"])

        drawn = rows.mapInArrow(least, "run int, key double, centre array<double>")
        for row in drawn.groupBy("run").agg(F.min(F.struct("key", "centre"))["centre"].alias("centre")).collect():  # a row a run
            chosen[row["run"]].append(row["centre"])
    return [np.array(c, dtype=float).reshape(-1, width) for c in chosen]


def fit_many(vectors: DataFrame, runs: Sequence[tuple[int, int]], key: str = "customer_id") -> list[Centres]:
    """A fit for each run (cluster count, seed) over the vector column ``features``; every scan serves all runs.

    A cluster that loses its rows keeps its centre.  A table without rows has no centres.
    """
    kept = vectors.is_cached
    vectors.persist()    # a lost part is read again from the written table
    try:
        first = vectors.select(vector_to_array("features").alias("x")).first()
        if first is None:
            return [Centres(np.zeros((0, 0)), 0.0, 0) for _ in runs]
        rows, width = _rows(vectors, key), len(first["x"])
        centres = seeds(rows, width, runs)
        costs, rounds, moving = [np.inf] * len(runs), [0] * len(runs), list(range(len(runs)))
        for turn in range(1, ROUNDS + 1):
            totals = _totals(rows, width, [(r, centres[r]) for r in moving])
            still = []
            for r in moving:
                new = centres[r].copy()
                costs[r], rounds[r] = 0.0, turn
                for c in range(len(new)):
                    if (r, c) in totals:
                        n, cost, sums = totals[r, c]
                        costs[r] += cost
                        new[c] = np.array(sums) / n
                if ((new - centres[r]) ** 2).sum() > TOLERANCE ** 2:
                    still.append(r)
                centres[r] = new
            moving = still
            if not moving:
                break
        # The cost of the centres as they now are.
        final = _totals(rows, width, list(enumerate(centres)))
        for r in range(len(runs)):
            costs[r] = sum(v[1] for (run, _), v in sorted(final.items()) if run == r)
    finally:
        if not kept:
            vectors.unpersist()
    return [Centres(c, cost, n) for c, cost, n in zip(centres, costs, rounds)]


def _totals(rows: DataFrame, width: int, runs: list[tuple[int, np.ndarray]]) -> dict[tuple[int, int], tuple[int, float, list]]:
    """(rows, squared distance, sums) of each run's clusters."""
    stacked = np.concatenate([c for _, c in runs])
    ends = np.cumsum([0] + [len(c) for _, c in runs])

    def added(batches):
        n, cost, sums = np.zeros(len(stacked)), np.zeros(len(stacked)), np.zeros((len(stacked), width))
        for batch in batches:
            for _, x in _pieces(batch, width):
                near, member = nearest(squared_distances(stacked, x), ends)
                n += member.sum(axis=1)
                sums += member @ x
                for a, b, d in zip(ends[:-1], ends[1:], near):
                    cost[a:b] += member[a:b] @ d
        run = np.repeat([r for r, _ in runs], np.diff(ends))
        cluster = np.concatenate([np.arange(b - a) for a, b in zip(ends[:-1], ends[1:])])
        some = np.flatnonzero(n)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * width), pa.array(sums[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(run[some].astype(np.int32)), pa.array(cluster[some].astype(np.int32)),
                                          pa.array(n[some].astype(np.int64)), pa.array(cost[some]), lists], ["run", "cluster", "n", "cost", "sums"])

    parts = rows.mapInArrow(added, "run int, cluster int, n long, cost double, sums array<double>")
    found = parts.groupBy("run", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                                                *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)]).collect()  # a row a centre
    return {(r["run"], r["cluster"]): (r["n"], r["cost"], list(r[4:])) for r in found}


def best_of(fits: Sequence[Centres]) -> Centres:
    """The fit of least cost, the first of equal ones."""
    return min(fits, key=lambda f: f.cost)


# -- silhouette -----------------------------------------------------------------

def _distances_to(labelled: DataFrame, others: list, clusters: int, width: int) -> DataFrame:
    """(h, own, sums, counts): each row's summed distance to, and number of, the ``others`` of each cluster but itself."""
    hashes = np.array([r["h"] for r in others], dtype=np.int64)
    names = np.array([r["own"] for r in others], dtype=np.int64)
    points = np.array([r["x"] for r in others], dtype=float).reshape(-1, width)
    member = np.zeros((len(others), clusters))
    member[np.arange(len(others)), names] = 1.0

    def measured(batches):
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), dtype=float).reshape(-1, width)
            h = np.asarray(batch.column("h"))
            sums, counts = np.zeros((len(x), clusters)), np.zeros((len(x), clusters))
            for i in range(0, len(x), 512):
                part = x[i:i + 512]
                # Differences, not the expanded square: equal points have distance 0.
                far = np.zeros((len(part), len(points)))
                for j in range(width):
                    far += (part[:, j, None] - points[None, :, j]) ** 2
                other = (h[i:i + 512, None] != hashes[None, :]).astype(float)
                sums[i:i + 512], counts[i:i + 512] = (np.sqrt(far) * other) @ member, other @ member
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * clusters)
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("own"), pa.ListArray.from_arrays(ends, pa.array(sums.ravel())),
                                              pa.ListArray.from_arrays(ends, pa.array(counts.ravel()))], ["h", "own", "sums", "counts"])

    return labelled.mapInArrow(measured, "h long, own int, sums array<double>, counts array<double>")


def _in_cells(labels: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by cell (rows of equal labels in every clustering), their cells, and 1 where a cell lies in a cluster."""
    cells, cell = np.unique(labels, axis=0, return_inverse=True)
    cell = cell.ravel()
    member = np.zeros((len(cells), ends[-1]))
    member[np.arange(len(cells))[:, None], cells + ends[:-1]] = 1.0
    order = np.argsort(cell, kind="stable")
    return order, cell[order], member


def pair_sums(x: np.ndarray, x_labels: np.ndarray, y: np.ndarray, y_labels: np.ndarray, clusters: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Summed distances of each row of ``x`` to the rows of each cluster (of all clusterings, side by side) in ``y``, and of each row of ``y`` to those in ``x``.

    ``*_labels`` hold a row's cluster in each clustering.  Every distance is measured once, for both rows and all clusterings.
    """
    ends = np.cumsum([0, *clusters])
    centre = (x.sum(axis=0) + y.sum(axis=0)) / (len(x) + len(y))
    (x_order, x_cell, x_member), (y_order, y_cell, y_member) = _in_cells(x_labels, ends), _in_cells(y_labels, ends)
    x, y = (x - centre)[x_order], (y - centre)[y_order]
    x_square, y_square = (x * x).sum(axis=1), (y * y).sum(axis=1)
    left = np.column_stack([-2 * x, x_square, np.ones(len(x))])
    right = np.column_stack([y, np.ones(len(y)), y_square])
    x_sums, y_sums = np.zeros((len(x), ends[-1])), np.zeros((len(y), ends[-1]))
    tiles = []
    for c in range(0, len(y), _WIDE):
        cell = y_cell[c:c + _WIDE]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        tiles.append((c, min(c + _WIDE, len(y)), np.ascontiguousarray(right[c:c + _WIDE].T), first if 8 * len(first) <= len(cell) else None,
                      y_member[cell[first]] if 8 * len(first) <= len(cell) else y_member[cell]))
    room = np.empty(_HIGH * _WIDE)
    for a in range(0, len(x), _HIGH):
        b = min(a + _HIGH, len(x))
        # The rows of y get their sums by cell, or by cluster where the cells are more.
        names, place = np.unique(x_cell[a:b], return_inverse=True)
        by_cell = len(names) < ends[-1]
        tally = (place == np.arange(len(names))[:, None]).astype(float) if by_cell else np.ascontiguousarray(x_member[x_cell[a:b]].T)
        for c, d, columns, first, member in tiles:
            far = np.matmul(left[a:b], columns, out=room[:(b - a) * (d - c)].reshape(b - a, d - c))
            # Squares of short distances are lost in those of the rows: they are taken by differences, so equal points have distance 0.
            close = _CLOSE * (x_square[a:b].max() + y_square[c:d].max())
            if far.min() <= close:
                i, j = np.nonzero(far <= close)
                far[i, j] = ((x[a + i] - y[c + j]) ** 2).sum(axis=1)
            np.sqrt(far, out=far)
            met = (tally @ far).T
            y_sums[c:d] += met @ x_member[names] if by_cell else met
            x_sums[a:b] += (far if first is None else np.add.reduceat(far, first, axis=1)) @ member
    return x_sums[np.argsort(x_order)], y_sums[np.argsort(y_order)]


def row_silhouettes(sums: np.ndarray, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Silhouettes of rows from their summed distances to all clusters, their own cluster and the sizes of all; 0 for a row alone, or with no other cluster."""
    rows = np.arange(len(own))
    with np.errstate(divide="ignore", invalid="ignore"):
        means = np.where(counts > 0, sums / counts, np.inf)
        inside = sums[rows, own] / (counts[own] - 1)
        means[rows, own] = np.inf
        outside = means.min(axis=1)
        value = (outside - inside) / np.maximum(inside, outside)
    return np.where((counts[own] > 1) & np.isfinite(outside) & (np.maximum(inside, outside) > 0), value, 0.0)


def plain_silhouettes(labelled: DataFrame, clusters: Sequence[int], block: int = SILHOUETTE_BLOCK) -> list[float | None]:
    """Mean silhouette by Euclidean distance of each clustering of the same rows (``x``, ``labels``: a cluster in each), every row against every other.

    The rows are dealt into blocks and every pair of blocks is a group of its own, which measures each distance once for both
    rows and all clusterings, so the work grows with the square of the rows.  Sums meet in parts of a block.  Nothing but counts
    and results reaches the driver.  A row alone in its cluster counts 0.  None where there are no rows.
    """
    cores = labelled.sparkSession.sparkContext.defaultParallelism
    clusters, size = list(clusters), len(clusters)
    numbered = materialise(labelled.select("x", "labels", F.monotonically_increasing_id().alias("id")), "silhouette")
    sizes = {(r["pos"], r["col"]): r["count"] for r in numbered.select(F.posexplode("labels")).groupBy("pos", "col").count().collect()}  # a row a cluster
    rows = sum(n for (pos, _), n in sizes.items() if pos == 0)
    if not rows:
        return [None] * size
    counts = [np.array([sizes.get((i, c), 0) for c in range(k)], dtype=float) for i, k in enumerate(clusters)]
    # Pairs enough for all cores.
    blocks = max(min(-(-rows // block), SILHOUETTE_BLOCKS), min(-(-rows // 512), math.ceil(math.sqrt(8 * cores))))
    ends = np.cumsum([0, *clusters])

    def measured(table):
        table = table.sort_by("id")
        at = table.column("block").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
        labels = table.column("labels").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
        names = np.unique(at)
        sides = [(int(n), x[at == n], labels[at == n]) for n in (names[0], names[-1])]
        told = pair_sums(*sides[0][1:], *sides[1][1:], clusters)
        out = []
        # A block met with itself gives its sums once, and with them the rows' own clusters.
        for (n, _, own), sums in zip(sides[:len(names)], told):
            same = table.column("pair")[0].as_py() == n * (blocks + 1)
            out += [(n * (1 << 32) + i, sums[i:i + _ROWS].tobytes(), own[i:i + _ROWS].astype(np.int32).tobytes() if same else None)
                    for i in range(0, len(own), _ROWS)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], names=["part", "sums", "own"])

    def scored(table):
        sums = sum(np.frombuffer(v.as_py()).reshape(-1, ends[-1]) for v in table.column("sums"))
        own = np.frombuffer(table.column("own").drop_null()[0].as_py(), dtype=np.int32).reshape(len(sums), -1)
        totals = [float(row_silhouettes(sums[:, ends[i]:ends[i + 1]], own[:, i], counts[i]).sum()) for i in range(size)]
        return pa.table([pa.array(range(size), pa.int32()), pa.array(totals, pa.float64())], names=["number", "total"])

    this, other = F.col("block"), F.col("other")
    pairs = (numbered.withColumn("block", (F.col("id") % blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .withColumn("pair", F.least(this, other) * blocks + F.greatest(this, other)).drop("other"))
    # More parts than pairs, so that few pairs share a part.
    sums = (pairs.repartition(2 * blocks * (blocks + 1), "pair").groupBy("pair").applyInArrow(measured, "part long, sums binary, own binary"))
    totals = {r["number"]: r["total"] for r in sums.groupBy("part").applyInArrow(scored, "number int, total double")
              .groupBy("number").agg(F.sum("total").alias("total")).collect()}  # a row a clustering
    return [totals[i] / rows for i in range(size)]


def plain_silhouette(assigned: DataFrame, clusters: int, sample: int | None = None, key: str = "customer_id",
                     block: int = SILHOUETTE_BLOCK) -> float | None:
    """Mean silhouette by Euclidean distance over every row of ``assigned`` (``features``, ``prediction``), as :func:`plain_silhouettes`.

    Only where a caller asks for a ``sample`` is each row measured against so many rows of each cluster, drawn by the hash of
    their unique keys; that is an estimate.  None where there are no rows.
    """
    own = F.col("prediction").cast("int")
    if sample is None:
        return plain_silhouettes(assigned.select(vector_to_array("features").alias("x"), F.array(own).alias("labels")), [clusters], block)[0]
    labelled = assigned.select(F.xxhash64(key).alias("h"), vector_to_array("features").alias("x"), own.alias("own"))
    first = labelled.first()
    if first is None:
        return None
    place = F.row_number().over(Window.partitionBy("own").orderBy("h"))
    drawn = labelled.withColumn("place", place).where(F.col("place") <= sample).select("h", "x", "own").collect()
    measured = _distances_to(labelled, drawn, clusters, len(first["x"]))
    means = [F.when(F.col("counts")[c] > 0, F.col("sums")[c] / F.col("counts")[c]) for c in range(clusters)]
    inside = F.coalesce(*[F.when(F.col("own") == c, m) for c, m in enumerate(means)])
    outside = F.array_min(F.array(*[F.when(F.col("own") != c, m) for c, m in enumerate(means)]))
    widest = F.greatest(inside, outside)
    value = F.when(inside.isNull() | outside.isNull() | (widest == 0), 0.0).otherwise((outside - inside) / widest)
    return measured.agg(F.avg(value)).first()[0]


# The scans travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
