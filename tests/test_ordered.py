"""Order statistics against brute force, hot values and groups included."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import ordered


def skewed(seed, n=3000):
    """A third of the rows share one value, one group holds half of all rows."""
    rng = np.random.default_rng(seed)
    value = np.where(rng.random(n) < 1 / 3, 7.25, np.round(rng.lognormal(2, 2, n), 3))
    group = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 6, n))
    return group.tolist(), value.tolist()


@pytest.mark.parametrize("buckets", [1, 4, 256])
@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_numpy(spark, seed, buckets):
    _, value = skewed(seed)
    df = spark.createDataFrame([(v,) for v in value] + [(None,)], "v double")
    probs = [0.0, 0.01, 0.25, 0.45, 0.5, 0.55, 0.75, 0.99, 1.0]
    got = ordered.quantile_values(df, "v", probs, buckets=buckets)
    assert got == pytest.approx(np.percentile(value, [100 * p for p in probs]).tolist(), rel=1e-12)


def test_grouped_quantiles(spark):
    group, value = skewed(3)
    df = spark.createDataFrame(list(zip(group, value)), "g int, v double").repartition(7)
    got = {r["g"]: (r["a"], r["b"]) for r in
           ordered.exact_quantiles(df, "v", {"a": 0.5, "b": 0.9}, by=["g"], buckets=32).collect()}
    for g in set(group):
        mine = [v for k, v in zip(group, value) if k == g]
        assert got[g] == pytest.approx((np.percentile(mine, 50), np.percentile(mine, 90)), rel=1e-12)


def test_quantiles_without_the_small_copy(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SMALL_ROWS", 0)
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert ordered.quantile_values(df, "v", [0.25, 0.5], buckets=8) == [25.0, 50.0]


def test_quantile_of_nothing_is_an_error(spark):
    with pytest.raises(ValueError):
        ordered.quantile_values(spark.createDataFrame([], "v double"), "v", [0.5])


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [1, 16])
def test_running_totals(spark, descending, buckets):
    group, value = skewed(4)
    df = (spark.createDataFrame(list(zip(group, value)), "g int, v double")
          .groupBy("g", "v").agg(F.count("*").alias("n")))
    got = ordered.running_totals(df, "v", {"n": "run"}, by=["g"], descending=descending, buckets=buckets,
                                 totals={"n": "all"}).collect()
    for r in got:
        mine = [v for k, v in zip(group, value) if k == r["g"]]
        expected = sum(v >= r["v"] if descending else v <= r["v"] for v in mine)
        assert (r["run"], r["all"]) == (expected, len(mine))


def test_order_cuts_split_exactly(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"))
    cuts = ordered.order_cuts(df, "h", {"c": 0.2}, by=["g"], buckets=16)
    counts = (df.join(cuts, "g").groupBy("g")
              .agg(F.count("*").alias("n"), F.sum((F.col("h") <= F.col("c")).cast("int")).alias("k")).collect())
    assert all(r["k"] == int(0.2 * r["n"] + 0.5) for r in counts)


def test_ranges_follow_a_binary_search(spark):
    bounds, values = [1.0, 2.0, 5.0, 9.0, 9.5], [-1.0, 1.0, 1.5, 2.0, 8.9, 9.0, 10.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in ordered.with_range(df, "v", [*bounds, float("inf")]).select(ordered.BUCKET).collect()]
    assert got == [int(np.searchsorted(bounds, v, side="right")) for v in values]
    empty = spark.createDataFrame([(None,)], "v double")
    assert ordered.with_range(empty, "v", bounds).first()[ordered.BUCKET] == 0
