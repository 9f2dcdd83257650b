"""Banking tables derived from the driver's order tables.

``transactions`` takes the columns it should produce and leaves out joins nobody
needs: every line has an order and a part, so the rows stay the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.columns import flag, padded_id

# Market segment to employment type, key remainder to account type.
EMPLOYMENT = {
    "AUTOMOBILE": "Salaried",
    "BUILDING": "Self-Employed",
    "FURNITURE": "Business Owner",
    "HOUSEHOLD": "Retired",
    "MACHINERY": "Unemployed",
}
ACCOUNTS = ["Savings", "Current", "Salary"]
EMPLOYMENT_LEVELS = sorted(EMPLOYMENT.values())
ACCOUNT_LEVELS = sorted(ACCOUNTS)


class DriverTables:
    """Scans of one table folder, opened once each."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._scans: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._scans[name]


def customer_key(key: str):
    return padded_id("CUST", F.col(key) + 1, 7)


def _urgent_open_orders(table: DriverTables) -> DataFrame:
    orders = table("orders")
    return orders.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))


def customers(table: DriverTables) -> DataFrame:
    """All customer columns except the label, plus ``c_custkey``."""
    people = table("customer")
    nations = table("nation").select("n_nationkey", F.col("n_name").alias("city"))
    loans = _urgent_open_orders(table).groupBy("o_custkey").agg(F.max("o_totalprice").alias("loan"))
    employment = F.create_map(*[F.lit(x) for pair in EMPLOYMENT.items() for x in pair])
    account = F.create_map(*[F.lit(x) for pair in enumerate(ACCOUNTS) for x in pair])
    key = F.col("c_custkey")
    base = (people.join(nations, people.c_nationkey == nations.n_nationkey)
                  .join(loans, people.c_custkey == loans.o_custkey, "left"))
    staged = base.select(
        "c_custkey",
        customer_key("c_custkey").alias("customer_id"),
        (key % 48 + 22).alias("age"),
        ((F.col("c_acctbal") + 1000) * 200).alias("income"),
        employment[F.col("c_mktsegment")].alias("employment_type"),
        "city",
        account[(key % 3).cast("int")].alias("account_type"),
        (key * 7 % 179 + 1).alias("tenure_months"),
        (key * 37 % 601 + 300).alias("credit_score"),
        flag(F.col("loan").isNotNull()).alias("has_loan"),
        F.coalesce("loan", F.lit(0.0)).alias("loan_amount"),
        F.when(F.col("loan").isNotNull(), key % 72 + 12).otherwise(F.lit(0)).cast("long").alias("loan_tenure_months"),
        F.when(F.col("loan").isNotNull(), (key % 101 + 85).cast("double") / 10).otherwise(F.lit(0.0))
         .alias("interest_rate_pct"),
        flag(key % 20 < 11).alias("has_credit_card"),
    )
    limited = staged.withColumn(
        "credit_limit",
        F.when(F.col("has_credit_card") == 1, F.col("income") * (key % 121 + 30).cast("double") / 100)
         .otherwise(F.lit(0.0)))
    return limited.withColumn("cc_balance", F.col("credit_limit") * (key * 13 % 96).cast("double") / 100)


def repayments(table: DriverTables) -> DataFrame:
    """One row per order of a loan customer; ``o_orderkey`` breaks date ties."""
    orders = table("orders")
    borrowers = _urgent_open_orders(table).select(F.col("o_custkey").alias("loan_custkey"))
    pending = F.col("o_orderstatus") == "P"
    status = (F.when(pending & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Late")
               .when(pending & F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), "Missed")
               .otherwise("On-Time"))
    paid = (F.when(F.col("payment_status") == "On-Time", F.col("emi_amount"))
             .when(F.col("payment_status") == "Late",
                   F.col("emi_amount") * (F.col("o_orderkey") % 90).cast("double") / 100)
             .otherwise(F.lit(0.0)))
    return (orders.join(borrowers, orders.o_custkey == borrowers.loan_custkey, "left_semi")
                  .select(customer_key("o_custkey").alias("customer_id"),
                          F.to_date("o_orderdate").alias("due_date"),
                          F.col("o_totalprice").alias("emi_amount"),
                          status.alias("payment_status"), "o_orderkey")
                  .withColumn("paid_amount", paid))


TRANSACTION_COLUMNS = ("customer_id", "transaction_date", "amount", "transaction_type", "category")


def transactions(table: DriverTables, columns: Sequence[str] = TRANSACTION_COLUMNS) -> DataFrame:
    """Line items as card movements; joins only what ``columns`` needs."""
    lines = table("lineitem")
    if "customer_id" in columns:
        owners = table("orders").select("o_orderkey", "o_custkey")
        lines = lines.join(owners, lines.l_orderkey == owners.o_orderkey)
    if "category" in columns:
        kinds = table("part").select("p_partkey", F.col("p_type").alias("category"))
        lines = lines.join(kinds, lines.l_partkey == kinds.p_partkey)
    built = {
        "transaction_id": lambda: F.concat(F.lit("TXN"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")),
        "customer_id": lambda: customer_key("o_custkey"),
        "transaction_date": lambda: F.to_date("l_shipdate"),
        "amount": lambda: F.col("l_extendedprice"),
        "transaction_type": lambda: F.when(F.col("l_returnflag") == "R", "Credit").otherwise("Debit"),
        "category": lambda: F.col("category"),
    }
    return lines.select(*[built[c]().alias(c) for c in columns])
