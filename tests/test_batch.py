"""End to end: exported base tables in, all outputs and a clean audit out."""

import pytest

from loanloom import schemas
from loanloom.operators import models
from loanloom.plans import batch, views
from loanloom.plans.bank import Bank
from loanloom.sources import tables


@pytest.mark.parametrize("fmt, method", [("csv", "arima"), ("parquet", "seasonal")])
def test_batch_run(spark, sf, tmp_path, fmt, method):
    bank = Bank.of(spark, sf)
    exported = {"customers": bank.customers(), "repayment_history": bank.repayments(),
                "transactions": bank.transactions(*schemas.TRANSACTIONS.names)}
    for name, df in exported.items():
        tables.write_table(df.select(*schemas.BY_NAME[name].names), str(tmp_path / "in" / name), fmt)
    out = tmp_path / "out"
    audit = batch.run(spark, str(tmp_path / "in"), str(out), fmt, [models.LOGISTIC], cross_validated=False,
                      forecast_method=method, restarts=2)
    assert {r["status"] for r in audit.collect()} == {"OK"}
    risk = tables.read_table(spark, str(out / "risk_scored"), "risk_scored")
    assert risk.count() == 150 and risk.where("default_probability is null").count() == 0
    assert tables.read_table(spark, str(out / "customer_segments"), "customer_segments").count() == 150
    ahead = tables.read_table(spark, str(out / "revenue_forecast"), "revenue_forecast").where("type = 'forecast'")
    assert ahead.count() == 12
    loaded = tables.load_model(str(out / "models" / "Logistic_Regression"))
    matrix = spark.read.parquet(str(out / "feature_matrix"))
    assert loaded.transform(models.prepare(matrix)[0]).count() == 150


def test_stored_levels_keep_the_columns_of_the_model(spark, sf, tmp_path):
    from pyspark.sql import functions as F

    from loanloom.operators import features
    customers = Bank.of(spark, sf).customers()
    tables.write_levels(spark, features.fit_levels(customers), str(tmp_path / "levels"))
    levels = tables.read_levels(spark, str(tmp_path / "levels"))
    assert levels == features.fit_levels(customers)
    gone = levels["city"][0]
    later = customers.where(F.col("city") != gone).withColumn("city", F.when(F.col("city") == levels["city"][1], "Atlantis").otherwise(F.col("city")))
    matrix = features.one_hot(later, levels)
    assert [c for c in matrix.columns if c.startswith("city_")] == [f"city_{v}" for v in levels["city"]]
    assert matrix.agg(F.sum(f"city_{gone}")).first()[0] == 0


def test_sql_runs_on_the_views(spark, sf):
    views.publish_bank(spark, sf)
    monthly = spark.sql("""
        SELECT DATE_TRUNC('month', due_date::DATE) AS m, COUNT(*) AS n FROM repayment_history GROUP BY 1 ORDER BY 1""")
    assert monthly.count() > 12
    shares = spark.sql("""
        SELECT clv_segment, SUM(estimated_clv) / SUM(SUM(estimated_clv)) OVER () AS share
        FROM clv_estimates GROUP BY clv_segment""").collect()
    assert sum(r["share"] for r in shares) == pytest.approx(1)
    joined = spark.sql("""
        SELECT COUNT(*) FROM customers c JOIN risk_scored USING (customer_id)
        JOIN customer_segments USING (customer_id) JOIN transactions USING (customer_id)""")
    assert joined.first()[0] > 0
