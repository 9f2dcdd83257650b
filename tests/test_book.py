import pytest
from pyspark.sql import functions as F

from loanloom.operators import audit, book, clv, distributions, portfolio, segments


def test_clv_defaults_and_floor(spark):
    customers = spark.createDataFrame(
        [("a", 0.0, 0.0, 0.0, 1000.0, 1), ("b", 0.0, 0.0, 0.0, 1000.0, 24)],
        "customer_id string, loan_amount double, interest_rate_pct double, credit_limit double, income double, "
        "tenure_months long")
    risk = spark.createDataFrame([("b", 0.5)], "customer_id string, default_probability double")
    got = {r["customer_id"]: r["estimated_clv"] for r in clv.estimate_clv(customers, risk).collect()}
    assert got == {"a": pytest.approx(3 * 0.5 * 0.9), "b": pytest.approx(3 * 2 * 0.5)}


def test_quartiles_hold_a_quarter_each(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("customer_id"),
                                 F.col("id").cast("double").alias("estimated_clv"),
                                 F.lit(1.0).alias("annual_revenue_est"), F.lit(0.1).alias("default_probability"))
    tiers = clv.with_clv_tier(df, clv.fit_clv_cuts(df)).groupBy("clv_segment").count().collect()
    assert {r[1] for r in tiers} == {100}


def test_book_skips_absent_sides(spark):
    customers = spark.createDataFrame([("a", "x")], "customer_id string, city string")
    assert book.customer_360(customers).columns == ["customer_id", "city"]
    empty = spark.createDataFrame([], "customer_id string")
    assert book.customer_360(customers, risk=empty).columns == ["customer_id", "city"]
    none = spark.createDataFrame([], "customer_id string, segment int")
    assert book.customer_360(customers, segments=none, skip_empty=True).columns == ["customer_id", "city"]
    assert tuple(book.customer_360(customers, segments=none).first()) == ("a", "x", None)


def test_filters(spark):
    df = spark.createDataFrame([("a", "x", "Low Risk", 2), ("b", "y", "Low Risk", 3)],
                               "customer_id string, city string, risk_tier string, segment int")
    assert book.filter_book(df).count() == 2
    assert book.filter_book(df, city="x").count() == 1
    assert book.filter_book(df, segment="Churner").first()["customer_id"] == "b"
    assert book.filter_book(df, segment="Nobody").count() == 0
    assert book.filter_book(df.drop("city"), city="x").count() == 2


def test_city_rates_without_exposure(spark):
    df = spark.createDataFrame([("a", "x", 1, 0.0, 1, 600), ("b", "y", 0, 0.0, 1, 600), ("c", "z", 1, 10.0, 1, 700)],
                               "customer_id string, city string, has_loan int, loan_amount double, defaulted int, "
                               "credit_score int")
    sql = {r["city"]: r["npa_rate_pct"] for r in portfolio.city_npa(df).collect()}
    dash = {r["city"]: r["npa_rate_pct"] for r in portfolio.city_npa_dash(df).collect()}
    assert sql == {"x": None, "z": 100.0}
    assert dash == {"x": 0.0, "z": 100.0}


def test_empty_bands_are_listed(spark):
    df = spark.createDataFrame([("a", 30.0, 100.0, 1, 700)],
                               "customer_id string, cc_balance double, credit_limit double, defaulted int, "
                               "credit_score int")
    got = {r["utilisation_band"]: r["customer_count"] for r in portfolio.utilisation_bands_dash(df).collect()}
    assert got == {"Low (<30%)": 1, "Medium (30-60%)": 0, "High (60-90%)": 0, "Very High (>90%)": 0}


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 0, 5, 10)] + [(None,)], "v double")
    rows = {r["bin"]: r for r in distributions.histogram(df, "v", 20).collect()}
    assert len(rows) == 20 and rows[19]["n"] == 1 and rows[0]["n"] == 2 and rows[10]["n"] == 1
    assert rows[0]["midpoint"] == 0.25
    flat = spark.createDataFrame([(3.0,)] * 4, "v double")
    assert [r["n"] for r in distributions.histogram(flat, "v", 4).orderBy("bin").collect()] == [0, 0, 4, 0]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(f"c{i}", 1.0) for i in range(9)] + [("n", None)], "customer_id string, v double")
    assert [r[0] for r in distributions.top_k(df.repartition(4), "v", 3).collect()] == ["c0", "c1", "c2"]


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(2000).select(F.concat(F.lit("c"), "id").alias("customer_id"),
                                  F.when(F.col("id") < 1500, 0).otherwise(1).alias("segment"))
    a = distributions.sample_per_group(df, ["segment"], 100)
    b = distributions.sample_per_group(df.repartition(9), ["segment"], 100, salts=3)
    assert a.exceptAll(b).count() == 0
    assert {r[1] for r in a.groupBy("segment").count().collect()} == {100}
    assert distributions.sample_rows(df, 50).exceptAll(distributions.sample_rows(df.repartition(3), 50)).count() == 0


def test_documents(spark):
    report = spark.createDataFrame([("x", 1), ("y", 2)], "city string, n int")
    doc = book.as_document(report, "cities").first()
    assert doc["name"] == "cities" and '{"city":"x","n":1}' in doc["document"]


def test_audit_finds_orphans_of_a_hot_customer(spark):
    customers = spark.createDataFrame([("a",)], "customer_id string")
    facts = spark.createDataFrame([("a",)] * 5 + [("ghost",)] * 7, "customer_id string")
    got = {r["table"]: (r["rows"], r["orphans"], r["status"]) for r in
           audit.integrity_audit({"customers": customers, "facts": facts, "none": facts.limit(0)}).collect()}
    assert got == {"customers": (1, 0, "OK"), "facts": (12, 7, "CHECK"), "none": (0, 0, "CHECK")}
    metrics = spark.createDataFrame([("m1", 0.9), ("m2", 0.8)], "model string, auc_roc double")
    assert tuple(audit.auc_target(metrics).first()) == ("m1", 0.9, True)


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("c", None, 5.0)],
                               "customer_id string, income double, credit_score double")
    scaler = segments.fit_scaler(df, ["income", "credit_score", "absent"])
    assert scaler.columns == ["credit_score", "income"] or scaler.columns == ["income", "credit_score"]
    rows = segments.zscore(df, scaler).collect()
    assert sum(r["z_income"] for r in rows) == pytest.approx(0)
    assert {r["z_credit_score"] for r in rows} == {0.0}


def test_nearest_centroid_prefers_the_lowest_id(spark):
    df = spark.createDataFrame([("a", 0.0)], "customer_id string, income double")
    scaler = segments.Scaler(["income"], [0.0], [1.0])
    got = segments.nearest_centroid(df, scaler, {5: [1.0], 2: [-1.0], 7: [3.0]}).first()
    assert got["segment"] == 2
