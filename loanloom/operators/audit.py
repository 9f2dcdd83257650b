"""Integrity audit of a finished batch run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUC_TARGET = 0.88


def integrity_audit(tables: dict[str, DataFrame], customers: str = "customers",
                    key: str = "customer_id") -> DataFrame:
    """Row count, rows of unknown customers and verdict per table.

    Each table is folded to a count per customer, then all of them meet the customer keys in one
    join, where a customer with a third of the rows of a table is one row.
    """
    folded = []
    for name, df in tables.items():
        owner = F.col(key) if key in df.columns else F.lit(None)
        folded.append(df.select(F.lit(name).alias("table"), owner.cast("string").alias("__key"), F.lit(key in df.columns).alias("__keyed"))
                      .groupBy("table", "__key", "__keyed").agg(F.count(F.lit(1)).alias("__n")))
    # One join for all tables: a key is known where the customer table has it.
    every = reduce(DataFrame.unionByName, folded)
    known = tables[customers].where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("__key")).distinct().withColumn("__known", F.lit(True))
    counted = every.join(known, "__key", "left").groupBy("table").agg(
        F.sum("__n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("__keyed") & F.col("__known").isNull() & (F.col("table") != customers), F.col("__n"))), F.lit(0)).alias("orphans"))
    # An empty table still has its line.
    names = tables[customers].sparkSession.createDataFrame([(n,) for n in tables], "table string")
    lines = names.join(counted, "table", "left").select("table", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("orphans", F.lit(0)).alias("orphans"))
    verdict = F.when((F.col("rows") > 0) & (F.col("orphans") == 0), "OK").otherwise("CHECK")
    return lines.withColumn("status", verdict)


def auc_target(metrics: DataFrame, target: float = AUC_TARGET) -> DataFrame:
    """Best model and whether its AUC meets the target.

    A comparison marks its best model and knows the target before rounding; of a plain table the highest AUC is the
    best, the first by name of equal ones.
    """
    met = F.col("target_met") if "target_met" in metrics.columns else F.col("auc_roc") > target
    best = metrics.where("best") if "best" in metrics.columns else metrics.orderBy(F.desc("auc_roc"), "model").limit(1)
    return best.select(F.col("model").alias("best_model"), F.col("auc_roc").alias("best_auc"), met.alias("target_met"))
