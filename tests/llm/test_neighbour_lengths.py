"""The permutation index on vectors of unequal length, at the share of a full block."""

import numpy as np
import pytest

from loanloom.llm import neighbours
from loanloom.llm.frames import read_table


@pytest.fixture(scope="module")
def unit_vectors(spark):
    rows = read_table(spark, "/root/testdata/sf0.1", "embeddings").orderBy("vec_id").collect()
    return np.array([r["embedding"] for r in rows], dtype=float)


@pytest.mark.parametrize("sigma", [0.0, 0.5, 1.0])
def test_recall_on_unequal_lengths(unit_vectors, monkeypatch, sigma):
    monkeypatch.setattr(neighbours, "RERANK_LEAST", 1)
    rng = np.random.default_rng(11)
    x = unit_vectors * np.exp(sigma * rng.normal(size=len(unit_vectors)))[:, None]
    pivots = x[rng.permutation(len(x))[:neighbours.PIVOTS]]
    pivots /= np.linalg.norm(pivots, axis=1)[:, None]
    block = neighbours.Block(np.arange(len(x)), x, pivots)
    hits = []
    for q in range(0, len(x), 20):
        ids, scores = block.search(x[q], neighbours.pivot_places(x[q:q + 1], pivots)[0], 20)
        assert len(ids) == 20 and scores == pytest.approx(x[ids] @ x[q])
        hits.append(len(set(ids).intersection(np.argsort(-(x @ x[q]), kind="stable")[:20])) / 20)
    assert np.mean(hits) >= 0.95


def test_through_the_query_on_unequal_lengths(spark, unit_vectors):
    rng = np.random.default_rng(12)
    x = unit_vectors * np.exp(rng.normal(size=len(unit_vectors)))[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(frame).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = [len(found[q].intersection([i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20])) / 20 for q in range(0, len(x), 20)]
    assert np.mean(hits) >= 0.95


def test_lengths_of_very_large_and_small_vectors():
    assert neighbours.lengths_of(np.array([[3e200, 4e200], [3e-200, 4e-200], [0.0, 2.0]])) == pytest.approx([5e200, 5e-200, 2.0])
