"""Mixed rows of sampled Shapley values."""

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT

from loanloom.operators import models
from loanloom.operators.distributions import sample_rows
from loanloom.plans.bank import Bank


def test_mixed_rows_reach_the_model_as_vectors(spark, sf, monkeypatch):
    b, seen, plain = Bank.of(spark, sf), [], models._predicted

    def noted(model, rows, inputs):
        seen.append((rows.schema["x"].dataType, rows.limit(50).collect()))
        return plain(model, rows, inputs)

    monkeypatch.setattr(models, "_predicted", noted)
    data, inputs = b.training()
    values = models.shapley_values(b.trained(models.LOGISTIC), data.where("split = 'test'").limit(20), inputs, rounds=1)
    kind, rows = seen[0]
    assert kind == VectorUDT() and all(len(r["x"]) == len(inputs) for r in rows)
    off = values.groupBy("customer_id").agg({"phi": "sum", "gap": "max"}).collect()
    assert len(off) == 20 and all(abs(r["sum(phi)"] - r["max(gap)"]) < 1e-9 for r in off)


def test_a_walk_of_few_steps_gives_whole_vectors():
    size = 3
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["a"]), pa.array([1], pa.int32()), pa.array([[1.0, 2.0, 3.0]]), pa.array([[1.0, 0.0, 0.0]]), pa.array([[2, 0, 1]], pa.list_(pa.int32()))],
        ["customer_id", "round", "x", "z", "order"])
    found = [r for out in models._walks(size)([batch]) for r in out.to_pylist()]
    assert [r["x"]["values"] for r in found] == [[1.0, 0.0, 0.0], [1.0, 0.0, 3.0], [1.0, 2.0, 3.0]]
    assert [(r["own"], r["after"]) for r in found] == [(-1, 2), (2, 1), (1, -1)] and {r["x"]["type"] for r in found} == {1}


def test_background_rows_are_those_of_a_plain_sample(spark):
    data = spark.range(400).selectExpr("if(id % 50 = 0, null, concat('C', id div 2)) customer_id", "id div 2 v", "id div 2 w")
    for n in (1, 7, 33, 1000):
        told, found = ([tuple(r) for r in df.collect()] for df in (sample_rows(data, n, seed=3), models.background_rows(data, n, 3)))
        assert [r[0] for r in found] == [r[0] for r in told] and len(found) == min(n, 400)
        assert [r for r in found if r[0]][:-1] == [r for r in told if r[0]][:-1]
    keys = models.background_rows(data, 7, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in keys and keys.count("v#") > 0
