"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes the reduce side at run time and splits skewed join
# partitions; UTC keeps month boundaries the same on every executor.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# The JVM never compiles a method of more bytes than this, so Spark is told not to put a stage over wide rows in one.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_BYTES = "8000"


def build_session(app_name: str = "loanloom", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``extra`` holds further settings with dots written as double underscores,
    e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def limit_methods(spark: SparkSession) -> None:
    """Set the size of generated methods that the JVM compiles, where the session does not name one."""
    if spark.sparkContext.getConf().get(METHOD_LIMIT) is None:
        spark.conf.set(METHOD_LIMIT, METHOD_BYTES)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, naming one only where the session has none.

    A cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local
    master may fall back to a temporary folder: on a cluster that folder would
    be lost together with the executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="loanloom-checkpoint-")
    sc.setCheckpointDir(named)
    return named


ROWS_PER_BUCKET = 1_000_000
_stage_tables: list[str] = []


def bucket_count(rows: int, least: int = 1) -> int:
    """Power of two that keeps a bucket near ``ROWS_PER_BUCKET`` rows, raised to a multiple of ``least``, so that all cores have as many."""
    return least * -(-(1 << (rows // ROWS_PER_BUCKET).bit_length()) // least)


def materialise(df: DataFrame, name: str = "stage", key: str | None = None, rows: int = 0) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and continue from the copy.

    Used for stage outputs that many jobs read and before multi-pass training.
    A lost executor then costs a re-read instead of the joins behind the table,
    and later readers still prune columns and push filters down.  With a ``key``
    (unique per row, ``rows`` of them) the copy is bucketed by it, so that
    stage outputs join each other without a shuffle.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/{table}"
    if key is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = bucket_count(rows, spark.sparkContext.defaultParallelism)
    # One task per bucket, so that a bucket is one file.
    (df.repartition(buckets, key).write.format("parquet").option("path", path)
       .bucketBy(buckets, key).saveAsTable(table))
    _stage_tables.append(table)
    return spark.table(table)


def release_stages(spark: SparkSession) -> None:
    """Forget the bucketed stage copies of this process in the catalog.

    Only needed with a catalog that outlives the application; the files stay
    in the checkpoint folder.
    """
    while _stage_tables:
        spark.sql(f"DROP TABLE IF EXISTS {_stage_tables.pop()}")
