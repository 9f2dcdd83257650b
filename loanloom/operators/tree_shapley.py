"""Exact Shapley values of tree ensembles, by the paths to their leaves.

A leaf is a table row: its value, and for each feature on its path the merged interval (low, high] that the splits
leave and the share of training weight that takes the same turns (the product of cover ratios of that feature's splits).
With a set S of known features a leaf counts as the product of 0/1 (is the row inside?) over its features in S
and of these shares over the rest.  The Shapley weights k! (m - 1 - k)! / m! are the integrals of u^k (1 - u)^(m - 1 - k),
so the sum over all subsets of the other features is the integral over u of the polynomial

    product over j of (share_j (1 - u) + inside_j u)

of degree m - 1, which Gauss-Legendre nodes integrate exactly.  It depends on the row only by the 2^m cases of inside, so a
task works out the cases of a leaf once and its rows look theirs up; long paths and few rows are integrated row by row.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.columns import half_even
from loanloom.session import ensure_checkpoint_dir

#: Numbers that a task holds at a time while it meets rows with leaves, and values of the rows that it takes together.
_BLOCK, _VALUES = 1 << 22, 1 << 22
#: Features of a path whose cases are put in a table at most, and rows that look them up at a time.
_TABLE, _STRIP = 10, 8192


@dataclass
class Leaves:
    """Leaves whose paths have the same number of features, as arrays of (leaf, feature on the path)."""
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def leaf_paths(nodes: dict[int, tuple], weight: float = 1.0) -> list[tuple[float, dict[int, tuple[float, float, float]]]]:
    """(value, {feature: (low, high, share)}) of every leaf of one tree.

    ``nodes`` maps a node's number to (left, right, feature, threshold, cover, value); the root is 0 and a leaf has left
    -1.  Rows up to the threshold go left.
    """
    found, open_ = [], [(0, {})]
    while open_:
        at, path = open_.pop()
        left, right, feature, threshold, cover, value = nodes[at]
        if left < 0:
            found.append((weight * value, path))
            continue
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, ends in ((left, (low, min(high, threshold))), (right, (max(low, threshold), high))):
            open_.append((child, {**path, feature: (*ends, share * nodes[child][4] / cover if cover else 0.0)}))
    return found


def grouped(paths: Sequence[tuple[float, dict]]) -> tuple[list[Leaves], float]:
    """The leaves by path length, and the value of no known feature."""
    by_length: dict[int, list] = {}
    base = 0.0
    for value, path in paths:
        base += value * float(np.prod([p[2] for p in path.values()]))
        by_length.setdefault(len(path), []).append((value, path))
    groups = []
    for length, leaves in sorted(by_length.items()):
        if length:
            ends = np.array([[p for p in path.values()] for _, path in leaves])
            groups.append(Leaves(np.array([list(path) for _, path in leaves]), ends[..., 0], ends[..., 1], ends[..., 2],
                                 np.array([v for v, _ in leaves])))
    return groups, base


def _parts(inside: np.ndarray, g: Leaves) -> np.ndarray:
    """Contribution of each leaf and feature on its path, where ``inside`` (case, leaf, feature) tells which intervals hold the row."""
    nodes, weights = np.polynomial.legendre.leggauss((g.feature.shape[1] + 1) // 2)
    u, weights = (nodes + 1) / 2, weights / 2
    absent = g.share[..., None] * (1 - u)
    factor = np.where(inside[..., None], absent + u, absent)
    # The product over the other features, without division: a share may be 0.
    before, after = np.ones_like(factor), np.ones_like(factor)
    np.cumprod(factor[:, :, :-1], axis=2, out=before[:, :, 1:])
    np.cumprod(factor[:, :, :0:-1], axis=2, out=after[:, :, -2::-1])
    return (inside - g.share) * ((before * after) @ weights) * g.value[:, None]


def _row_by_row(x: np.ndarray, g: Leaves, out: np.ndarray) -> None:
    leaves, length = g.feature.shape
    order = np.argsort(g.feature.ravel(), kind="stable")
    held, start = np.unique(g.feature.ravel()[order], return_index=True)
    step = max(1, _BLOCK // (leaves * length * ((length + 1) // 2)))
    for i in range(0, len(x), step):
        at = x[i:i + step][:, g.feature]
        part = _parts((at > g.low) & (at <= g.high), g)
        out[held, i:i + step] += np.add.reduceat(part.reshape(len(at), -1)[:, order], start, axis=1).T


def _by_pattern(columns: np.ndarray, g: Leaves, out: np.ndarray) -> None:
    """A row meets a leaf of m features in one of 2^m ways: these are worked out once, and a row looks its own up."""
    leaves, length = g.feature.shape
    cases = (np.arange(1 << length)[:, None] >> np.arange(length) & 1).astype(bool)
    step = max(1, _BLOCK // (cases.size * ((length + 1) // 2)))
    for first in range(0, leaves, step):
        some = Leaves(*[v[first:first + step] for v in (g.feature, g.low, g.high, g.share, g.value)])
        inside = np.broadcast_to(cases[:, None, :], (len(cases), len(some.value), length))
        tables = np.ascontiguousarray(_parts(inside, some).transpose(1, 2, 0))
        for i in range(0, columns.shape[1], _STRIP):
            strip, sums = columns[:, i:i + _STRIP], out[:, i:i + _STRIP]
            for feature, low, high, table in zip(some.feature.tolist(), some.low.tolist(), some.high.tolist(), tables):
                case = np.zeros(strip.shape[1], dtype=np.uint16)
                for j, f in enumerate(feature):
                    held = strip[f] <= high[j] if high[j] < np.inf else strip[f] > low[j]
                    if -np.inf < low[j] and high[j] < np.inf:
                        held &= strip[f] > low[j]
                    case |= np.left_shift(held, j, dtype=np.uint16)
                case = case.astype(np.intp)
                for j, f in enumerate(feature):
                    sums[f] += table[j].take(case)


def contributions(x: np.ndarray, groups: Sequence[Leaves]) -> np.ndarray:
    """Shapley values of each row (of ``x``) and feature."""
    columns, out = np.ascontiguousarray(x.T), np.zeros(x.shape[::-1])
    for g in groups:
        length = g.feature.shape[1]
        if length <= _TABLE and len(x) > 1 << length:
            _by_pattern(columns, g, out)
        else:
            _row_by_row(x, g, out)
    return np.ascontiguousarray(out.T)


def tree_covers(df: DataFrame, trees: Sequence[dict[int, tuple]], inputs: Sequence[str]) -> list[dict[int, tuple]]:
    """Trees given as {node: (left, right, feature, threshold, value)} with the rows of ``df`` in each node as covers, in one pass."""
    conditions = []
    for number, nodes in enumerate(trees):
        open_ = [(0, F.lit(True))]
        while open_:
            at, here = open_.pop()
            conditions.append((number, at, here))
            left, right, feature, threshold, _ = nodes[at]
            if left >= 0:
                below = F.col(f"`{inputs[feature]}`").cast("double") <= F.lit(float(threshold))
                open_ += [(left, here & below), (right, here & ~below)]
    counts = df.agg(*[F.count_if(c).alias(f"n{i}") for i, (_, _, c) in enumerate(conditions)]).first()
    covers = {(number, at): counts[i] for i, (number, at, _) in enumerate(conditions)}
    return [{at: (*n[:4], float(covers[number, at]), n[4]) for at, n in nodes.items()} for number, nodes in enumerate(trees)]


def model_paths(model: PipelineModel, spark: SparkSession) -> list[tuple[float, dict]]:
    """Leaf paths of a fitted forest or boosting model; their number is bounded by its depth and number of trees.

    A forest's values add up to the probability of class 1, those of boosting to its log-odds.  Covers are the weights
    of the training rows.  The nodes come from the model's stored form.
    """
    last = model.stages[-1]
    boosting = isinstance(last, GBTClassificationModel)
    if not boosting and not isinstance(last, RandomForestClassificationModel):
        raise TypeError(f"no trees in {type(last).__name__}")
    folder = f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
    last.write().save(folder)
    trees: dict[int, dict[int, tuple]] = {}
    for tree, n in spark.read.parquet(f"{folder}/data").select("treeID", "nodeData").collect():
        if n.split.numCategories != -1 and n.leftChild >= 0:
            raise ValueError("splits by category are not supported")
        stats = n.impurityStats
        cover, value = (stats[0], 2 * n.prediction) if boosting else (sum(stats), stats[1] / sum(stats))
        threshold = n.split.leftCategoriesOrThreshold[0] if n.leftChild >= 0 else 0.0
        trees.setdefault(tree, {})[n.id] = (n.leftChild, n.rightChild, n.split.featureIndex, threshold, cover, value)
    weights = list(last.treeWeights) if boosting else [1.0 / len(trees)] * len(trees)
    return [leaf for t, nodes in sorted(trees.items()) for leaf in leaf_paths(nodes, weights[t])]


def tree_contributions(paths: Sequence[tuple[float, dict]], data: DataFrame, inputs: Sequence[str], key: str = "customer_id") -> DataFrame:
    """(key, phi, explained): exact Shapley values of every row of ``data`` in the order of ``inputs``, and the value they sum to.

    A NULL input counts as 0, as in training.
    """
    groups, base = grouped(paths)
    width = len(inputs)

    def answer(keys, x):
        phi = contributions(x, groups)
        ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
        return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(ends, pa.array(phi.ravel())), pa.array(base + phi.sum(axis=1))],
                                          [key, "phi", "explained"])

    def explained(batches):
        keys, rows, held = [], [], 0
        for batch in batches:
            keys.append(batch.column(0))
            rows.append(np.asarray(batch.column("x").flatten(), dtype=float).reshape(-1, width))
            held += rows[-1].size
            if held >= _VALUES:
                yield answer(pa.concat_arrays(keys), np.concatenate(rows))
                keys, rows, held = [], [], 0
        if rows:
            yield answer(pa.concat_arrays(keys), np.concatenate(rows))

    vector = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in inputs])
    kind = data.schema[key].dataType.simpleString()
    return data.select(key, vector.alias("x")).mapInArrow(explained, f"`{key}` {kind}, phi array<double>, explained double")


def mean_contributions(values: DataFrame, inputs: Sequence[str], k: int = 20) -> DataFrame:
    """Mean absolute contribution per feature over all rows, the ``k`` largest first."""
    sums = values.agg(*[F.avg(F.abs(F.col("phi")[i])).alias(f"s{i}") for i in range(len(inputs))])
    lines = F.array(*[F.struct(F.lit(c).alias("feature"), half_even(F.col(f"s{i}"), 6).alias("mean_abs_shap")) for i, c in enumerate(inputs)])
    return sums.select(F.inline(lines)).orderBy(F.desc("mean_abs_shap"), "feature").limit(k)


# The work travels with its task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
