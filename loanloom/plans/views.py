"""Temporary views under the names the portfolio SQL expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanloom.plans.bank import Bank


def publish(tables: dict[str, DataFrame]) -> None:
    """Register each table as a temporary view, ready for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def publish_bank(spark: SparkSession, sf_dir: str) -> None:
    """All banking relations of a driver-table folder as views."""
    bank = Bank.of(spark, sf_dir)
    publish({
        "customers": bank.customers().drop("risk_score"),
        "repayment_history": bank.repayments(),
        "transactions": bank.transactions(),
        "risk_scored": bank.risk(),
        "clv_estimates": bank.clv(),
        "customer_segments": bank.segments(),
    })
