import pytest
from pyspark.sql import functions as F

from loanloom.functions import bands, columns


def column_of(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


@pytest.mark.parametrize("spec, value, expected", [
    (bands.UTILISATION_SQL, 0.30, "Medium (30–60%)"),
    (bands.UTILISATION_SQL, 0.2999, "Low (< 30%)"),
    (bands.UTILISATION_SQL, None, "Very High (> 90%)"),
    (bands.TENURE_SQL, 12.0, "1–3 years"),
    (bands.INCOME_SQL, 200000.0, "Lower Middle (₹2L–5L)"),
    (bands.INCOME_SQL, 2000000.0, "High Income (> ₹20L)"),
])
def test_sql_bands_are_left_closed(spark, spec, value, expected):
    assert column_of(spark, [value], "double", lambda c: bands.left_closed(c, spec)) == [expected]


@pytest.mark.parametrize("spec, value, expected", [
    (bands.UTILISATION_DASH, 0.30, "Low (<30%)"),
    (bands.UTILISATION_DASH, 0.0, None),
    (bands.UTILISATION_DASH, None, None),
    (bands.TENURE_DASH, 12.0, "0-12m"),
    (bands.INCOME_DASH, 200000.0, "<2L"),
])
def test_dashboard_bands_are_right_closed(spark, spec, value, expected):
    assert column_of(spark, [value], "double", lambda c: bands.right_closed(c, spec)) == [expected]


def test_risk_tiers_at_the_edges(spark):
    p = [0.0, 0.30, 0.60, 0.61, 1.0, None]
    assert column_of(spark, p, "double", bands.risk_tier) == [
        None, "Low Risk", "Medium Risk", "High Risk", "High Risk", None]
    assert column_of(spark, [0.29, 0.30, 0.60], "double", bands.what_if_tier) == [
        "Low Risk", "Medium Risk", "High Risk"]
    assert column_of(spark, [0.29, 0.30, 0.60], "double", bands.recommendation) == [
        "APPROVE", "CONDITIONAL APPROVAL", "DECLINE"]


def test_quartile_tiers(spark):
    got = column_of(spark, [1.0, 2.0, 3.0, 4.0, 5.0, None], "double",
                    lambda c: bands.quartile_tier(c, [2.0, 3.0, 4.0]))
    assert got == ["Bronze", "Bronze", "Silver", "Gold", "Platinum", None]
    with pytest.raises(ValueError):
        bands.quartile_tier(F.col("v"), [1.0, 1.0, 2.0])


def test_rounding_modes(spark):
    ties = [0.5, 1.5, 2.5, -0.5, -2.5]
    assert column_of(spark, ties, "double", lambda c: columns.half_up(c, 0)) == [1, 2, 3, -1, -3]
    assert column_of(spark, ties, "double", lambda c: columns.half_even(c, 0)) == [0, 2, 2, 0, -2]


def test_clip_keeps_null(spark):
    got = column_of(spark, [-1.0, 0.5, 9.0, None], "double", lambda c: columns.clip(c, 0, 1))
    assert got == [0.0, 0.5, 1.0, None]


def test_display_text(spark):
    assert column_of(spark, [0.7425, 0.2405, 0.5], "double", columns.as_percent) == ["74.2%", "24.1%", "50.0%"]
    assert column_of(spark, [1234567.4], "double", columns.as_rupees) == ["₹1,234,567"]
    assert column_of(spark, [7, 12345678], "long", lambda c: columns.padded_id("CUST", c, 7)) == [
        "CUST0000007", "CUST12345678"]
