import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from loanloom.operators import features, models

DAY = datetime.date(2023, 1, 1)
WORD = {"M": "Missed", "O": "On-Time", "L": "Late"}


def repayments(spark, histories):
    rows = [(c, DAY + datetime.timedelta(days=30 * i), 100.0, 0.0 if s == "M" else 100.0, WORD[s])
            for c, history in histories.items() for i, s in enumerate(history)]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(
        rows, "customer_id string, due_date date, emi_amount double, paid_amount double, payment_status string")


def longest(history):
    return max((len(list(g)) for k, g in itertools.groupby(history) if k == "M"), default=0)


@pytest.mark.parametrize("ranges", [1, 2, 17, None])
def test_longest_missed_run(spark, ranges):
    rng = random.Random(11)
    histories = {"mid": "MMOMMML", "none": "OO", "all": "MMM", "tail": "OMM", "head": "MMO", "one": "M",
                 "hot": "".join(rng.choices("MMMO", k=400)), "hot_all": "M" * 300,
                 **{f"r{i}": "".join(rng.choices("MOL", k=rng.randint(1, 20))) for i in range(40)}}
    got = {r[0]: r[1] for r in features.missed_streak(repayments(spark, histories), ranges=ranges).collect()}
    assert got == {c: longest(h) for c, h in histories.items()}


def test_rates_do_not_depend_on_the_cuts(spark):
    rng = random.Random(3)
    data = repayments(spark, {f"c{i}": "".join(rng.choices("MOL", k=5 + 40 * (i == 0))) for i in range(6)})
    plain = features.repayment_features(data, ranges=1).orderBy("customer_id").collect()
    cut = features.repayment_features(data, ranges=30).orderBy("customer_id").collect()
    for a, b in zip(plain, cut, strict=True):
        assert a.asDict() == pytest.approx(b.asDict())


TIED = "customer_id string, due_date date, emi_amount double, paid_amount double, payment_status string, k long"


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_null_ties_and_crowded_dates_follow_one_order(spark, ranges):
    rng = random.Random(7)
    rows = []
    for customer, n, days in (("one_date", 150, 1), ("few_dates", 90, 3), ("many", 60, 60), ("null_dates", 40, 4)):
        for i in range(n):
            day = rng.randrange(days)
            date = None if customer == "null_dates" and day == 0 else DAY + datetime.timedelta(days=day)
            rows.append((customer, date, 1.0, 0.0, WORD[rng.choice("MMO")], None if i % 25 == 0 else i))
    # Ties that stay open after date and tie-break would hang on the row hash: one NULL tie for each date.
    seen, unique = set(), []
    for r in rows:
        if r[5] is not None or (r[0], r[1]) not in seen:
            unique.append(r)
            seen.add((r[0], r[1]) if r[5] is None else None)
    want = {}
    for customer in {r[0] for r in unique}:
        own = sorted((r for r in unique if r[0] == customer), key=lambda r: (r[1] is not None, r[1] or DAY, r[5] is not None, r[5] or 0))
        want[customer] = longest(["M" if r[4] == "Missed" else "O" for r in own])
    rng.shuffle(unique)
    got = features.missed_streak(spark.createDataFrame(unique, TIED), ["k"], ranges=ranges)
    assert {r[0]: r[1] for r in got.collect()} == want


def test_without_a_tie_break_the_order_is_the_same_for_any_cut(spark):
    rng = random.Random(9)
    rows = [("c", DAY, float(i), 0.0, WORD[rng.choice("MMO")], i) for i in range(200)]
    got = {features.missed_streak(spark.createDataFrame(rng.sample(rows, 200), TIED).repartition(n), ranges=r).first()[1]
           for n, r in ((1, 1), (3, 7), (5, 50))}
    assert len(got) == 1


def test_same_day_rows_follow_the_tie_break(spark):
    rows = [("c", DAY, 1.0, 0.0, s, k) for k, s in enumerate(["Missed", "On-Time", "Missed", "Missed"])]
    for ranges in (1, 10):
        assert features.missed_streak(spark.createDataFrame(rows, TIED), ["k"], ranges=ranges).first()[1] == 2


def test_repayment_invariants(spark):
    data = repayments(spark, {"a": "MMOL", "b": "OOO", "c": "L"})
    for r in features.repayment_features(data).collect():
        assert r["repayment_consistency_score"] + r["payment_delay_frequency"] == pytest.approx(1)
        assert r["late_payment_rate"] <= r["payment_delay_frequency"]
        assert 0 <= r["avg_payment_coverage"] <= 1


def test_coverage_is_clipped(spark):
    df = spark.createDataFrame([(120.0, 100.0), (50.0, 100.0), (5.0, 0.0), (0.0, 0.0), (50.0, -100.0), (-5.0, 0.0)], "paid double, due double")
    got = [r[0] for r in df.select(features.coverage(F.col("paid"), F.col("due"))).collect()]
    assert got == [1.0, 0.5, 1.0, None, 0.0, 0.0]


def transactions(spark, rows):
    return spark.createDataFrame(
        [(c, datetime.date.fromisoformat(d), float(a), k) for c, d, a, k in rows],
        "customer_id string, transaction_date date, amount double, transaction_type string")


def test_spending_features(spark):
    df = transactions(spark, [
        ("one", "2024-12-05", 40, "Debit"),
        ("two", "2024-11-05", 1, "Debit"), ("two", "2024-12-05", 1000, "Debit"),
        ("three", "2024-10-05", 1, "Debit"), ("three", "2024-11-05", 1, "Debit"), ("three", "2024-12-31", 100, "Debit"),
        ("credit", "2024-12-05", 10, "Credit"),
        ("edge", "2024-06-30", 5, "Debit"), ("old", "2024-06-29", 5, "Debit"),
    ])
    got = {r["customer_id"]: r for r in features.transaction_features(df).collect()}
    assert set(got) == {"one", "two", "three", "edge"}
    assert (got["one"]["spending_volatility"], got["one"]["avg_monthly_spend"]) == (0.0, 40.0)
    assert got["two"]["high_spend_month_flag"] == 0
    assert got["three"]["high_spend_month_flag"] == 1
    assert got["one"]["transaction_frequency"] == pytest.approx(1 / 6)
    kept = {r["customer_id"] for r in features.transaction_features(df, keep_credit_only=True).collect()}
    assert kept == {"one", "two", "three", "edge", "credit"}


def test_month_end_cutoff_is_clipped(spark):
    df = transactions(spark, [("a", "2024-08-31", 1, "Debit"), ("a", "2024-02-29", 1, "Debit"),
                              ("a", "2024-02-28", 1, "Debit")])
    days = {r["transaction_date"].isoformat() for r in features.recent(df).collect()}
    assert days == {"2024-08-31", "2024-02-29"}


def test_a_moment_keeps_its_time_of_day(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 12, 31, 12), ), (datetime.datetime(2024, 6, 30, 12), ), (datetime.datetime(2024, 6, 30, 11), )],
                               "transaction_date timestamp")
    assert features.recent(df).count() == 2


def test_cutoff_reaches_the_scan(spark, sf):
    from loanloom.plans.bank import Bank
    bank = Bank.of(spark, sf)
    plan = features.recent(bank.spending(), latest=bank.latest_date())._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_ratios_guard_their_denominators(spark):
    df = spark.createDataFrame(
        [(0.0, 0, 0.0, 0.0, 0, 0.0, 0.0, 12), (1200.0, 1, 600.0, 10.0, 6, 100.0, 30.0, 0)],
        "income double, has_loan long, loan_amount double, interest_rate_pct double, loan_tenure_months long, "
        "credit_limit double, cc_balance double, tenure_months long")
    none, some = features.with_ratios(df).select(*features.RATIO_FEATURES).collect()
    assert list(none)[:5] == [0, 0, 0, 0, 0]
    assert some.asDict() == {"credit_utilisation_ratio": 0.3, "income_to_loan_ratio": 2.0,
                             "emi_to_income_ratio": 1.0, "interest_burden_score": 60.0,
                             "loan_to_value_ratio": 6.0, "credit_age_score": 0.0}


def test_one_hot_and_levels(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y z", 2), ("c", None, 3)], "customer_id string, kind string, n int")
    levels = features.fit_levels(df, ["kind"])
    assert levels == {"kind": ["x", "y z"]}
    out = features.one_hot(df, levels)
    assert out.columns == ["customer_id", "n", "kind_x", "kind_y z"]
    assert [tuple(r) for r in out.orderBy("customer_id").collect()] == [("a", 1, 1, 0), ("b", 2, 0, 1), ("c", 3, 0, 0)]
    wide = spark.range(1001).select(F.concat(F.lit("v"), "id").alias("wide"), F.lit("k").alias("kind"))
    levels = features.fit_levels(wide, ["wide", "kind"])
    assert len(levels["wide"]) == 1001 and levels["kind"] == ["k"]
    table = features.level_table(wide, "wide")
    unseen = wide.limit(3).union(spark.createDataFrame([("new", "k"), (None, "k")], "wide string, kind string"))
    ids = features.with_level_id(unseen, "wide", table)
    assert ids.columns == ["kind", "wide_id"] and ids.where("wide_id is null").count() == 2


def test_wide_columns_become_ids(spark):
    people = spark.range(40).select(
        F.concat(F.lit("c"), "id").alias("customer_id"), F.when(F.col("id") < 39, F.concat(F.lit("v"), "id")).alias("city"),
        F.lit("s").alias("account_type"), F.lit("e").alias("employment_type"))
    levels = features.fit_levels(people, most=38)
    assert set(levels) == {"account_type", "employment_type"} and set(features.fit_levels(people, most=39)) == set(features.CATEGORICALS)
    out = features.wide_as_ids(features.one_hot(people, levels), levels)
    assert out.columns == ["customer_id", "account_type_s", "employment_type_e", "city_id"] or set(out.columns) == {
        "customer_id", "account_type_s", "employment_type_e", "city_id"}
    assert out.select("city_id").distinct().count() == 40 and out.where("city_id is null").count() == 1
    assert "city_id" not in models.model_inputs(out)


def test_column_selection(spark):
    df = spark.createDataFrame([("a", 1, 2.0, True, 0)], "customer_id string, n int, x double, b boolean, defaulted int")
    assert features.numeric_columns(df) == ["n", "x", "b"]
    assert features.select_present(df, ["x", "absent", "n"]).columns == ["x", "n"]
