"""Table scans and sinks with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom import schemas


def _reader(spark: SparkSession, schema: T.StructType | None, fmt: str):
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("dateFormat", "yyyy-MM-dd")
    return reader


def read_table(spark: SparkSession, path: str, table: str | None = None, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """Scan a table.  ``table`` names one of the declared schemas.

    A declared schema saves the extra pass over the files that inference needs.
    """
    if schema is None and table is not None:
        schema = schemas.BY_NAME[table]
    return _reader(spark, schema, fmt).load(path)


def read_optional(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    """Scan a table that may not exist yet: a missing path gives an empty table."""
    try:
        return read_table(spark, path, table, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.BY_NAME[table])


def read_uploaded_csv(spark: SparkSession, path: str, view: str = "uploaded") -> DataFrame:
    """Scan a user's own CSV, inferring its types, and publish it as a view."""
    df = _reader(spark, None, "csv").option("inferSchema", True).load(path)
    df.createOrReplaceTempView(view)
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``; tasks write their own files in parallel."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("dateFormat", "yyyy-MM-dd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Write a small metrics table as JSON lines."""
    df.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def normalise_missing(df: DataFrame) -> DataFrame:
    """Turn NaN in floating columns into NULL, so aggregates skip it."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats})


def write_levels(spark: SparkSession, levels: dict[str, list[str]], path: str) -> None:
    """Store the fitted levels of the categorical columns beside the model that was trained on them."""
    rows = [(column, place, value) for column, values in levels.items() for place, value in enumerate(values)]
    write_metrics(spark.createDataFrame(rows, "column string, place int, value string"), path)


def read_levels(spark: SparkSession, path: str) -> dict[str, list[str]]:
    levels: dict[str, list[str]] = {}
    for row in read_metrics(spark, path, "column string, place int, value string").orderBy("column", "place").collect():
        levels.setdefault(row["column"], []).append(row["value"])
    return levels
