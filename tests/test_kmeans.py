import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from loanloom.operators import kmeans, segments


def vectors(spark, points):
    rows = [(f"c{i}", Vectors.dense([float(v) for v in p])) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, ["customer_id", "features"]).repartition(4)


def blobs(seed, centres, n=60, spread=0.4):
    draw = np.random.default_rng(seed)
    return np.concatenate([draw.normal(c, spread, (n, len(c))) for c in centres])


def cost(points, centres):
    return ((points[:, None] - np.array(centres)) ** 2).sum(axis=2).min(axis=1).sum()


def test_runs_of_several_counts_are_fixed_points(spark):
    points = blobs(1, [(0, 0), (5, 0), (0, 5), (6, 6)])
    df = vectors(spark, points)
    runs = [(k, 42 + i) for k in (1, 2, 4, 6) for i in range(3)]
    for (k, _), fit in zip(runs, kmeans.fit_many(df, runs)):
        assert fit.centres.shape == (k, 2) and fit.cost == pytest.approx(cost(points, fit.centres), rel=1e-6)
        label = ((points[:, None] - fit.centres) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(k):
            if (label == c).any():
                assert fit.centres[c] == pytest.approx(points[label == c].mean(axis=0), abs=1e-3)
    best, found = segments.fit_kmeans(df, 4, restarts=6)
    truth = cost(points, [points[i * 60:(i + 1) * 60].mean(axis=0) for i in range(4)])
    assert found == pytest.approx(truth, rel=1e-3)
    told = {r["customer_id"]: r["prediction"] for r in best.transform(df).collect()}
    assert len({told[f"c{i}"] for i in range(60)}) == 1 and len(set(told.values())) == 4


def test_partitions_do_not_matter_and_seeds_do(spark):
    df = vectors(spark, blobs(2, [(0, 0, 0), (2, 2, 0)], spread=1.0))
    one, two = (kmeans.fit_many(d, [(3, 1)])[0] for d in (df, df.repartition(7)))
    assert one.centres == pytest.approx(two.centres)
    rows = kmeans._rows(df, "customer_id")
    first, other = kmeans.seeds(rows, 3, [(3, 1), (3, 2)])
    assert not np.allclose(first, other)


def test_seeds_lie_far_apart(spark):
    # All points of a place are one centre; the next must come from the other place.
    df = vectors(spark, [(0.0, 0.0)] * 50 + [(9.0, 9.0)])
    for seed in range(5):
        chosen = kmeans.seeds(kmeans._rows(df, "customer_id"), 2, [(2, seed)])[0]
        assert sorted(map(tuple, chosen)) == [(0.0, 0.0), (9.0, 9.0)]


def test_few_rows(spark):
    df = vectors(spark, [(1.0, 2.0)] * 3)
    fit = kmeans.fit_many(df, [(2, 1)])[0]
    assert fit.cost == 0 and fit.centres.shape == (2, 2)
    empty = kmeans.fit_many(df.limit(0), [(2, 1)])[0]
    assert len(empty.centres) == 0 and kmeans.plain_silhouette(df.limit(0).selectExpr("*", "0 as prediction"), 2) is None


def brute_silhouette(points, label):
    far = np.sqrt(((points[:, None] - points) ** 2).sum(axis=2))
    out = []
    for i in range(len(points)):
        same = (label == label[i]) & (np.arange(len(points)) != i)
        others = [far[i][label == c].mean() for c in set(label) if c != label[i]]
        a, b = (far[i][same].mean() if same.any() else None), (min(others) if others else None)
        out.append(0.0 if a is None or b is None or max(a, b) == 0 else (b - a) / max(a, b))
    return np.mean(out)


def test_exact_silhouette_equals_brute_force(spark):
    points = np.concatenate([blobs(3, [(0, 0), (3, 0), (0, 2)], n=30, spread=0.8), [[50.0, 50.0]], [[0.0, 0.0]] * 2])
    fit = kmeans.fit_many(vectors(spark, points), [(4, 3)])[0]
    assigned = fit.transform(vectors(spark, points))
    label = np.array([r["prediction"] for r in sorted(assigned.collect(), key=lambda r: int(r["customer_id"][1:]))])
    expected = brute_silhouette(points, label)
    for block in (1000, 20):
        assert kmeans.plain_silhouette(assigned, 4, None, block=block) == pytest.approx(expected, abs=1e-9)
    # A sample that holds every row is exact, a smaller one is near.
    assert kmeans.plain_silhouette(assigned, 4, 1000) == pytest.approx(expected, abs=1e-9)
    assert kmeans.plain_silhouette(assigned, 4, 20) == pytest.approx(expected, abs=0.08)


def test_ties_go_to_the_smaller_number_and_scans_keep_their_sums():
    draw = np.random.default_rng(4)
    far = draw.integers(0, 4, size=(9, 500)).astype(float)
    near, member = kmeans.nearest(far, [0, 4, 5, 9])
    for a, b, d in zip([0, 4, 5], [4, 5, 9], near):
        assert (member[a:b].argmax(axis=0) == far[a:b].argmin(axis=0)).all() and (member[a:b].sum(axis=0) == 1).all()
        assert (d == far[a:b].min(axis=0)).all()


def test_the_sweep_measures_every_row_against_every_other(spark):
    points = blobs(5, [(0, 0), (2, 0), (0, 3)], n=600, spread=1.0)
    df = vectors(spark, points)
    ks, far = [2, 3], np.sqrt(((points[:, None] - points) ** 2).sum(axis=2))
    sweep = {r["k"]: r["silhouette"] for r in segments.k_sweep(df, ks, restarts=2).collect()}
    fits = kmeans.fit_many(df, [(k, 42 + i) for k in ks for i in range(2)])
    for n, k in enumerate(ks):
        centres = kmeans.best_of(fits[2 * n:2 * n + 2]).centres
        label = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        sums = np.stack([far[:, label == c].sum(axis=1) for c in range(k)], axis=1)
        size = np.bincount(label, minlength=k)
        own = np.arange(k) == label[:, None]
        inside, outside = (sums / (size - 1))[own], np.where(own, np.inf, sums / size).min(axis=1)
        assert sweep[k] == pytest.approx(((outside - inside) / np.maximum(inside, outside)).mean(), abs=1e-9)


def test_rows_of_equal_and_missing_keys_count_each(spark):
    points = blobs(6, [(0, 0), (3, 1)], n=20, spread=1.0)
    df = vectors(spark, points).selectExpr("if(customer_id < 'c2', null, 'same') as customer_id", "features", "cast(substr(customer_id, 2) >= 20 as int) as prediction")
    assert kmeans.plain_silhouette(df, 2) == pytest.approx(brute_silhouette(points, np.arange(40) // 20), abs=1e-9)


@pytest.mark.parametrize("counts", [(2, 3), (9, 8, 7, 6)])
def test_pairs_of_blocks_hold_every_distance(counts, monkeypatch):
    """Few and many cells, blocks of several tiles, equal points, and points far from the origin."""
    monkeypatch.setattr(kmeans, "_HIGH", 64)
    monkeypatch.setattr(kmeans, "_WIDE", 48)
    draw = np.random.default_rng(7)
    x, y = draw.normal(1e6, 1, (150, 3)), draw.normal(1e6, 1, (130, 3))
    y[:40] = x[:40]
    a, b = (np.stack([draw.integers(0, k, n) for k in counts], axis=1) for n in (150, 130))
    got_x, got_y = kmeans.pair_sums(x, a, y, b, counts)
    far = np.sqrt(((x[:, None] - y) ** 2).sum(axis=2))
    told_x = np.concatenate([np.stack([far[:, b[:, i] == c].sum(axis=1) for c in range(k)], axis=1) for i, k in enumerate(counts)], axis=1)
    told_y = np.concatenate([np.stack([far[a[:, i] == c].sum(axis=0) for c in range(k)], axis=1) for i, k in enumerate(counts)], axis=1)
    assert np.allclose(got_x, told_x, rtol=0, atol=1e-7) and np.allclose(got_y, told_y, rtol=0, atol=1e-7)
