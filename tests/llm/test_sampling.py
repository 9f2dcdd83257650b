"""Bounded samples of labelled ids: repeated rows count once."""

from pyspark.sql import functions as F

from loanloom.llm import quality, sampling


def test_ids_with_many_rows_are_all_drawn(spark):
    rows = spark.range(200_000).select((F.col("id") % 100).alias("id"), (F.col("id") % 2).cast("int").alias("label"))
    keys, counts = sampling.sampled_keys(rows, 20_000)
    assert keys.count() == keys.distinct().count() == 100 and counts == {0: 50, 1: 50}


def test_bound_holds_and_an_id_may_have_both_labels(spark):
    rows = spark.range(5000).select("id", F.lit(1).alias("label")).union(spark.range(3).select("id", F.lit(0).alias("label")))
    keys, counts = sampling.sampled_keys(rows, 40)
    assert {r["label"]: r["count"] for r in keys.groupBy("label").count().collect()} == {0: 3, 1: 40} and counts == {0: 3, 1: 5000}


def test_repeated_labels_do_not_change_a_model(spark):
    docs = spark.createDataFrame([(i, f"a calm text with words {i} " * 5 if i % 2 else f"LOUD!! TEXT!! {i} ## " * 5) for i in range(60)], "doc_id long, text string")
    labels = spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    one, two = (quality.fit(docs, x) for x in (labels, labels.union(labels).union(labels)))
    assert (one.log_priors == two.log_priors).all() and abs(one.means[1] - two.means[1]).max() < 1e-9
