"""Centroid clustering against plain loops: ties, repeated and broken vectors, few and no rows."""

import hashlib
import math

import numpy as np
import pytest

from loanloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, id string, v int, cluster string"


def brute(rows, k, rounds, width, scale=centroids.SCALE):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((far(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(held[n]) for x in zip(*held[n])] if n in held else c for n, c in enumerate(centres)]
    return sorted((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), centres


@pytest.mark.parametrize("width, k, spread", [(3, 7, 4), (16, 5, 2), (2, 12, 1)])
def test_rounds_equal_plain_loops(spark, width, k, spread):
    draw = np.random.default_rng(width)
    rows = [(i, [float(x) for x in draw.integers(-spread, spread + 1, width) / 4]) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[8][1])]          # a repeated row and a repeated id
    table = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA)
    labels, centres = centroids.clusters(table, centroids=k, rounds=3, width=width)
    expected, by_hand = brute(rows, k, 3, width)
    assert sorted(tuple(r) for r in labels.collect()) == expected and centres.tolist() == by_hand
    told = centroids.with_inertia(labels, centres).collect()
    for r in told:
        assert r["inertia"] == sum(d for _, _, d in expected)
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, by_hand[r["cluster"]])).encode()).hexdigest()


def test_walk_stops_early_and_ties_go_to_the_smaller_number():
    lists = centroids.SortedLists(np.array([[0, 0], [4, 0], [0, 4], [4, 0], [1000, 1000]]))
    label, distance = lists.nearest(np.array([[2, 0], [4, 1], [2, 2], [900, 900], [-50, -50]]))
    assert label.tolist() == [0, 1, 0, 4, 0] and distance.tolist() == [4, 1, 8, 20000, 5000]
    draw = np.random.default_rng(5)
    many, points = draw.integers(-10 ** 6, 10 ** 6, (300, 2)), draw.integers(-10 ** 6, 10 ** 6, (500, 2))
    exact = ((points[:, None] - many) ** 2).sum(axis=2)
    label, distance = centroids.SortedLists(many).nearest(points)
    assert (label == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2]), (2, None), (3, [0.1]), (4, [0.1, None]), (5, [nan, 0.0]), (6, [0.0, inf]), (7, [0.0, -inf]),
            (8, [1e30, 0.0]), (None, [0.3, -0.3]), (9, [-0.001, 0.0])]
    table = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA)
    labels, centres = centroids.clusters(table, width=2, rounds=2)
    found = {r["id"]: r for r in labels.collect()}
    assert set(found) == {1, None, 9} and len(centres) == 2     # a null id starts no centroid
    assert brute([(9, [-0.001, 0.0])], 1, 1, 2)[1] == [[-1, 0]]


def test_no_rows(spark):
    for table in (spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, None, "x", 1, "y")], SCHEMA)):
        labels, centres = centroids.clusters(table)
        assert centroids.with_inertia(labels, centres).collect() == [] and not len(centres)
