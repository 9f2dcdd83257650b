import datetime
import functools
import random

import pytest
from pyspark.sql import functions as F

from loanloom.operators import features, repayment_state

DAY = datetime.date(2023, 1, 1)


def payments(spark, seed, customers=12, rows=40):
    draw = random.Random(seed)
    out = []
    for c in range(customers):
        odds = draw.choice([0.1, 0.5, 0.9, 1.0])
        for i in range(draw.randint(1, rows)):
            missed = draw.random() < odds
            out.append((f"c{c}", DAY + datetime.timedelta(days=draw.randrange(300)), i, 100.0, 0.0 if missed else 90.0,
                        "Missed" if missed else draw.choice(["On-Time", "Late"])))
    return spark.createDataFrame(out, "customer_id string, due_date date, no long, emi_amount double, paid_amount double, payment_status string").repartition(4)


def rows_of(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("cuts", [[], [100], [40, 90, 91, 250], list(range(20, 300, 40))])
def test_any_cut_into_months_equals_the_whole(spark, cuts):
    df = payments(spark, len(cuts))
    ends = [DAY + datetime.timedelta(days=c) for c in cuts]
    parts = [df.where((F.col("due_date") >= a) & (F.col("due_date") < b)) for a, b in zip([DAY, *ends], [*ends, datetime.date(2030, 1, 1)])]
    state = functools.reduce(repayment_state.grown, [repayment_state.state_of(p, ["no"], ranges=3) for p in parts])
    assert rows_of(repayment_state.features_of(state)) == rows_of(features.repayment_features(df, ["no"]))
    assert state.where("not state.in_order").count() == 0


def test_merging_is_associative(spark):
    df = payments(spark, 9)
    months = [repayment_state.state_of(df.where(F.col("due_date").between(DAY + datetime.timedelta(days=a), DAY + datetime.timedelta(days=a + 99))), ["no"])
              for a in (0, 100, 200)]
    left = repayment_state.grown(repayment_state.grown(months[0], months[1]), months[2])
    right = repayment_state.grown(months[0], repayment_state.grown(months[1], months[2]))
    assert rows_of(repayment_state.features_of(left)) == rows_of(repayment_state.features_of(right))


def test_payments_out_of_order_are_told(spark):
    kind = "customer_id string, due_date date, no long, emi_amount double, paid_amount double, payment_status string"
    old = spark.createDataFrame([("a", DAY, 1, 1.0, 0.0, "Missed"), ("b", DAY, 1, 1.0, 1.0, "On-Time"), ("d", None, 1, 1.0, 1.0, "On-Time")], kind)
    before = DAY - datetime.timedelta(days=1)
    new = spark.createDataFrame([("a", before, 2, 1.0, 0.0, "Missed"), ("b", None, 2, 1.0, 0.0, "Missed"), ("c", DAY, 1, 1.0, 0.0, "Missed"),
                                 ("d", DAY, 2, 1.0, 0.0, "Missed")], kind)
    state = repayment_state.grown(*[repayment_state.state_of(x, ["no"]) for x in (old, new)])
    assert {r["customer_id"]: r["state"]["in_order"] for r in state.collect()} == {"a": False, "b": False, "c": True, "d": True}


def test_stored_state_joins_the_next_month_without_moving(spark):
    df = payments(spark, 5)
    kept = repayment_state.stored_state(repayment_state.state_of(df.where(F.col("due_date") < DAY + datetime.timedelta(days=150)), ["no"]), 12)
    new = repayment_state.state_of(df.where(F.col("due_date") >= DAY + datetime.timedelta(days=150)), ["no"])
    state = repayment_state.grown(kept, new)
    assert rows_of(repayment_state.features_of(state)) == rows_of(features.repayment_features(df, ["no"]))
