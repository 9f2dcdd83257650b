import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler

from loanloom import schemas, session
from loanloom.sources import tables


@pytest.fixture
def repayments(spark):
    return spark.createDataFrame([("c1", datetime.date(2024, 1, 1), 10.0, 5.0, "Late"),
                                  ("c2", None, 10.0, None, "Missed")], schemas.REPAYMENTS)


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json", "orc"])
def test_round_trip(spark, tmp_path, repayments, fmt):
    path = str(tmp_path / "t")
    tables.write_table(repayments, path, fmt)
    back = tables.read_table(spark, path, "repayment_history", fmt)
    assert back.schema == schemas.REPAYMENTS
    assert back.exceptAll(repayments).count() == 0 and back.count() == 2


def test_missing_table_is_empty(spark, tmp_path, repayments):
    got = tables.read_optional(spark, str(tmp_path / "nowhere"), "risk_scored")
    assert got.count() == 0 and got.schema == schemas.RISK_SCORED
    tables.write_table(repayments, str(tmp_path / "t"), "csv")
    assert tables.read_optional(spark, str(tmp_path / "t"), "repayment_history").count() == 2
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "nowhere"), "risk_scored")


def test_uploaded_csv_becomes_a_view(spark, tmp_path):
    path = tmp_path / "mine.csv"
    path.write_text("customer_id,score,day\na,1.5,2024-01-02\nb,,2024-01-03\n")
    df = tables.read_uploaded_csv(spark, str(path), "mine")
    assert dict(df.dtypes) == {"customer_id": "string", "score": "double", "day": "date"}
    assert spark.sql("select count(score) from mine").first()[0] == 1


def test_metrics(spark, tmp_path):
    df = spark.createDataFrame([("m", 0.9)], "model string, auc_roc double")
    tables.write_metrics(df, str(tmp_path / "m"))
    assert tables.read_metrics(spark, str(tmp_path / "m"), df.schema).collect() == df.collect()
    assert tables.read_metrics(spark, str(tmp_path / "m")).count() == 1


def test_models(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "x double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="v")]).fit(df)
    tables.save_model(model, str(tmp_path / "model"))
    assert tables.load_model(str(tmp_path / "model")).transform(df).first()["v"][0] == 1.0


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "x double, s string")
    assert [r["x"] for r in tables.normalise_missing(df).orderBy("s").collect()] == [None, 1.0]


def test_stage_copies(spark):
    df = spark.range(100).selectExpr("cast(id as string) customer_id", "id * 2 as `a b`")
    plain = session.materialise(df)
    keyed = session.materialise(df, "stage", "customer_id", 100)
    assert plain.exceptAll(df).count() == keyed.exceptAll(df).count() == 0
    assert [session.bucket_count(n) for n in (0, 999_999, 1_000_000, 5_000_000)] == [1, 1, 2, 8]


def test_bucketed_stages_join_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_BUCKET", 10)
    df = spark.range(100).selectExpr("cast(id as string) customer_id", "id as v")
    a, b = (session.materialise(df, n, "customer_id", 100) for n in ("left_stage", "right_stage"))
    joined = a.hint("merge").join(b.withColumnRenamed("v", "w"), "customer_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("v = w").count() == 100


def test_stages_can_be_released(spark):
    session.materialise(spark.range(3).selectExpr("cast(id as string) customer_id"), "gone", "customer_id", 3)
    assert any(t.name.startswith("gone_") for t in spark.catalog.listTables())
    kept = list(session._stage_tables)
    session._stage_tables[:] = kept[-1:]
    session.release_stages(spark)
    session._stage_tables[:] = kept[:-1]
    assert not any(t.name.startswith("gone_") for t in spark.catalog.listTables())


def test_checkpoint_folder_is_found_once(spark):
    folder = session.ensure_checkpoint_dir(spark)
    assert session.ensure_checkpoint_dir(spark) == folder
