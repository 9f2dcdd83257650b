"""Time lines of customers with few and with many repayments, buckets for any number of cores."""

import random

import pytest
from pyspark.sql import functions as F

from loanloom import session
from loanloom.operators import features, models
from loanloom.plans.bank import Bank
from test_features import longest, repayments


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordinary_customers_are_not_cut(spark, sf, monkeypatch):
    monkeypatch.setattr(features, "_cut", None)
    rows = Bank.of(spark, sf).repayments()
    found = features.repayment_features(rows, ["o_orderkey"])
    assert found.count() == rows.select("customer_id").distinct().count()


def test_only_long_time_lines_are_cut(spark, monkeypatch):
    rng = random.Random(4)
    histories = {f"c{i}": "".join(rng.choices("MMOL", k=60 if i < 2 else rng.randint(1, 20))) for i in range(30)}
    data, cut, plain = repayments(spark, histories), [], features._cut
    data = data.withColumn("customer_id", F.when(F.col("customer_id") != "c0", F.col("customer_id")))    # one has no id

    def noted(rows, *rest):
        cut.extend(r[0] for r in rows.select("customer_id").distinct().collect())
        return plain(rows, *rest)

    monkeypatch.setattr(features, "_cut", noted)
    told = {r["customer_id"]: r.asDict() for r in features.repayment_features(data, ranges=7).collect()}
    del cut[:]
    monkeypatch.setattr(features, "LONG_HISTORY", 50)
    found = {r["customer_id"]: r.asDict() for r in features.repayment_features(data).collect()}
    assert set(cut) == {None, "c1"} and found.keys() == told.keys() == {None, *histories} - {"c0"}
    for c, row in found.items():
        assert row == pytest.approx(told[c]) and row["max_consecutive_missed"] == longest(histories[c or "c0"])


def test_cores_have_as_many_buckets():
    assert [session.bucket_count(n, 12) for n in (0, 900_000, 5_400_000, 12_000_000)] == [12, 12, 12, 24]
    assert [session.bucket_count(n, 8) for n in (0, 900_000, 5_400_000, 12_000_000)] == [8, 8, 8, 16]


def test_split_and_folds_from_hashes_made_before(spark, sf, monkeypatch):
    passes, plain = [], models.order_cuts
    monkeypatch.setattr(models, "order_cuts", lambda df, *rest, **more: passes.append("md5" in planned(df)) or plain(df, *rest, **more))
    models.training_set(Bank.of(spark, sf).matrix())
    assert passes == [False, False]
