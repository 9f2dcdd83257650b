"""Behavioural features per customer."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.columns import clip, flag, half_even, month_of, ratio_or, sum_where
from loanloom.operators.ordered import range_bounds, small_copy, with_range

# Column names of the feature matrix.
REPAYMENT_FEATURES = ["repayment_consistency_score", "total_missed_payments", "avg_payment_coverage",
                      "late_payment_rate", "payment_delay_frequency", "max_consecutive_missed"]
TRANSACTION_FEATURES = ["spending_volatility", "avg_monthly_spend", "total_debit_6m", "total_credit_6m",
                        "transaction_count_6m", "high_spend_month_flag", "net_cash_flow_6m",
                        "transaction_frequency", "debit_to_credit_ratio"]
RATIO_FEATURES = ["credit_utilisation_ratio", "income_to_loan_ratio", "emi_to_income_ratio",
                  "interest_burden_score", "loan_to_value_ratio", "credit_age_score"]
CATEGORICALS = ["employment_type", "account_type", "city"]
#: A categorical column of more values becomes an id column, not one-hot columns.
MOST_LEVELS = 10_000
#: Repayments of a customer that one task sorts at most; longer time lines are cut into pieces.
LONG_HISTORY = 100_000

# -- repayment behaviour ------------------------------------------------------

def coverage(paid: Column, due: Column) -> Column:
    """Share of the instalment that was paid, clipped to 0 .. 1.

    A payment without an instalment counts as the clipped infinity of its sign; neither is NULL.
    """
    return (F.when(due != 0, clip(paid / due, 0, 1))
             .when((due == 0) & (paid > 0), F.lit(1.0)).when((due == 0) & (paid < 0), F.lit(0.0)))


# Sums a customer's rates are made of; they add up over any cut of the rows.
_PARTS = ["__n", "__on_time", "__missed", "__late", "__delayed", "__covered", "__coverable"]
_LAST = "__row_hash"


def repayment_features(repayments: DataFrame, tie_break: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Rates, counts and the longest run of missed payments per customer.

    A run is a stretch of missed rows between two others in due-date order, NULL dates first. Within a date the
    ``tie_break`` columns decide, NULL first, and then a hash of the whole row, so that the
    order never hangs on how tasks read the rows.

    A customer of up to ``LONG_HISTORY`` rows is one sorted stretch of a task. The time lines of the others, or of all if
    ``ranges`` are given, are cut at the same bounds, which hold about equal parts of their
    rows (``ranges`` of them), and the pieces are joined up again through their ends.  A customer
    with a third of all rows, even on one date, is thus spread over a third of the pieces.
    """
    rows, order = _flagged(repayments, tie_break), [*tie_break, _LAST]
    if ranges is not None:
        customers = _runs_of_chunks(_cut(rows, tie_break, ranges), order)
    else:
        sizes = rows.groupBy("customer_id").agg(F.count(F.lit(1)).alias("__n"))
        long = small_copy(sizes.where(F.col("__n") > LONG_HISTORY).select(F.col("customer_id").alias("__long")))
        if long.isEmpty():
            customers = _runs_of_lines(rows, order)
        else:
            same = F.col("customer_id").eqNullSafe(F.col("__long"))
            cut = _cut(rows.join(long, same, "left_semi"), tie_break, ranges)
            customers = _runs_of_lines(rows.join(long, same, "left_anti"), order).unionByName(_runs_of_chunks(cut, order))
    return customers.select(
        "customer_id",
        (F.col("__on_time") / F.col("__n")).alias("repayment_consistency_score"),
        F.col("__missed").alias("total_missed_payments"),
        (F.col("__covered") / F.nullif("__coverable", F.lit(0))).alias("avg_payment_coverage"),
        (F.col("__late") / F.col("__n")).alias("late_payment_rate"),
        (F.col("__delayed") / F.col("__n")).alias("payment_delay_frequency"),
        "max_consecutive_missed",
    )


def _flagged(repayments: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    status = F.col("payment_status")
    return repayments.select(
        "customer_id", "due_date", *tie_break, F.xxhash64(*repayments.columns).alias(_LAST),
        flag(status == "On-Time").alias("__on_time"), flag(status == "Missed").alias("__missed"),
        flag(status == "Late").alias("__late"), flag(~status.eqNullSafe("On-Time")).alias("__delayed"),
        coverage(F.col("paid_amount"), F.col("emi_amount")).alias("__covered"))


def missed_streak(repayments: DataFrame, tie_break: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Only the longest run; the unused sums are pruned from the plan."""
    return repayment_features(repayments, tie_break, ranges).select("customer_id", "max_consecutive_missed")


def _runs_of_lines(rows: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    """Longest run and sums per customer from whole time lines: one sort, one aggregation."""
    ordered = (Window.partitionBy("customer_id").orderBy("due_date", *tie_break)
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    missed = F.col("__missed") == 1
    placed = rows.withColumn("__place", F.row_number().over(ordered).cast("long"))
    broken = placed.withColumn("__broken", F.max(F.when(~missed, F.col("__place"))).over(ordered))
    # A missed row ends a run of as many rows as follow the last one that was not missed.
    run = F.when(missed, F.col("__place") - F.coalesce("__broken", F.lit(0))).otherwise(F.lit(0))
    return broken.groupBy("customer_id").agg(
        F.max(run).alias("max_consecutive_missed"), F.count(F.lit(1)).alias("__n"), F.count("__covered").alias("__coverable"),
        F.coalesce(F.sum("__covered"), F.lit(0.0)).alias("__covered"),
        *[F.sum(c).alias(c) for c in ("__on_time", "__missed", "__late", "__delayed")])


def _runs(rows: DataFrame, by: list[str], tie_break: Sequence[str]) -> DataFrame:
    """Rows summed up per stretch between two payments that were not missed."""
    ordered = (Window.partitionBy(*by).orderBy("due_date", *tie_break)
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("__breaks", F.sum(1 - F.col("__missed")).over(ordered))
                .groupBy(*by, "__breaks").agg(
                    F.sum("__missed").alias("__run"), F.count(F.lit(1)).alias("__n"),
                    F.count("__covered").alias("__coverable"),
                    F.coalesce(F.sum("__covered"), F.lit(0.0)).alias("__covered"),
                    *[F.sum(c).alias(c) for c in ("__on_time", "__missed", "__late", "__delayed")]))


def _cut(rows: DataFrame, tie_break: Sequence[str], ranges: int | None) -> DataFrame:
    """Add ``__chunk``: the piece of the time line a row falls into.

    The place of a row is its date plus a fraction from the first tie-break, or from the row hash where there
    is none.  It never falls as (date, tie-break, hash) rises, so pieces follow each other
    in order; NULL comes first in both.
    """
    kinds = dict(rows.dtypes)
    date = F.unix_date("due_date") if kinds["due_date"] == "date" else F.col("due_date").cast("timestamp").cast("double") / 86400
    by = tie_break[0] if tie_break else _LAST
    fraction = F.lit(0.0)
    if isinstance(rows.schema[by].dataType, T.NumericType):
        edges = rows.agg(F.min(by).cast("double").alias("low"), F.max(by).cast("double").alias("high")).first()
        if edges["low"] is not None and edges["high"] > edges["low"]:
            # At most a half, so that rounding cannot reach the next date.
            part = (F.col(by).cast("double") - F.lit(edges["low"])) / F.lit(edges["high"] - edges["low"])
            fraction = F.coalesce(F.lit(0.01) + part * 0.49, F.lit(0.0))
        else:
            # A tie-break of one value decides nothing; the hash does.
            fraction = F.when(F.col(by).isNull(), 0.0).otherwise(0.3) + (F.col(_LAST).cast("double") / 2.0**63 + 1) * 0.1
    if kinds["due_date"] != "date":
        fraction = F.lit(0.0)    # moments of a day differ by less than any fraction
    placed = rows.withColumn("__place", F.coalesce(date.cast("double"), F.lit(-1e7)) + fraction)
    bounds = range_bounds(placed, "__place", ranges)
    return with_range(placed, "__place", bounds, "__chunk").drop("__place")


def _runs_of_chunks(rows: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    """Longest run and sums per customer from chunks of its time line.

    A chunk keeps its best run and the runs touching its two ends.  A customer has one row a chunk, no more than there
    are ranges; they are joined up in order, each to the run that ends the one before.
    """
    chunks = _runs(rows, ["customer_id", "__chunk"], tie_break).groupBy("customer_id", "__chunk").agg(
        F.max("__breaks").alias("__last"), F.max("__run").alias("__best"),
        F.coalesce(F.max(F.when(F.col("__breaks") == 0, F.col("__run"))), F.lit(0)).alias("__head"),
        F.max_by("__run", "__breaks").alias("__tail"), *[F.sum(c).alias(c) for c in _PARTS])
    piece = F.struct("__chunk", "__last", "__best", "__head", "__tail")
    lines = chunks.groupBy("customer_id").agg(F.array_sort(F.collect_list(piece)).alias("__line"), *[F.sum(c).alias(c) for c in _PARTS])
    zero = F.lit(0).cast("long")

    def joined(state: Column, p: Column) -> Column:
        met = state["run"] + p["__head"]
        # Without a break the whole chunk goes on with the run before it.
        return F.struct(F.when(p["__last"] == 0, met).otherwise(p["__tail"]).alias("run"),
                        F.greatest(state["best"], met, p["__best"]).alias("best"))

    longest = F.aggregate("__line", F.struct(zero.alias("run"), zero.alias("best")), joined, lambda state: state["best"])
    return lines.select("customer_id", longest.alias("max_consecutive_missed"), *_PARTS)


# -- spending behaviour -------------------------------------------------------

def latest_date(transactions: DataFrame) -> datetime.date:
    return transactions.agg(F.max("transaction_date")).first()[0]


def recent(transactions: DataFrame, months: int = 6, latest: datetime.date | None = None) -> DataFrame:
    """Rows within ``months`` of the latest date in the whole table, edge included.

    The cutoff enters the plan as a literal, so the scan can skip files and row
    groups before it.
    """
    latest = latest or latest_date(transactions)
    # A moment keeps its time of day; a date stays a date.
    cutoff = F.add_months(F.lit(latest), -months) if not isinstance(latest, datetime.datetime) else (
        F.lit(latest) - F.make_interval(months=F.lit(months)))
    return transactions.where(F.col("transaction_date") >= cutoff)


def _month_before(day: datetime.date, months: int) -> datetime.date:
    """First day of the month so many months before that of ``day``."""
    number = day.year * 12 + day.month - 1 - months
    return datetime.date(number // 12, number % 12 + 1, 1)


def monthly_activity(transactions: DataFrame) -> DataFrame:
    """Debit, credit and row count per customer and month."""
    kind = F.col("transaction_type")
    return transactions.groupBy("customer_id", month_of(F.col("transaction_date")).alias("month")).agg(
        F.sum(F.when(kind == "Debit", F.col("amount"))).alias("debit"),
        sum_where(kind == "Credit", F.col("amount")).alias("credit"),
        F.count(F.lit(1)).alias("n"),
    )


def transaction_features(transactions: DataFrame, months: int = 6, keep_credit_only: bool = False,
                         latest: datetime.date | None = None) -> DataFrame:
    """Spending signals of the trailing window per customer.

    A customer with no debit in the window has no row, as the spend table is the
    root of the join; ``keep_credit_only`` keeps them.  Spend statistics
    cover months with spend only.
    """
    latest = latest or latest_date(transactions)
    kind, amount = F.col("transaction_type"), F.col("amount")
    month = month_of(F.col("transaction_date"))
    # The window touches known months, so that one sum for each serves in one shuffle, folded before it.
    touched = [] if latest is None else [_month_before(latest, i) for i in range(months + 1)]
    spent = [f"__spent{i}" for i in range(len(touched))]
    sums = recent(transactions, months, latest).groupBy("customer_id").agg(
        *[F.sum(F.when((kind == "Debit") & (month == F.lit(m)), amount)).alias(c) for c, m in zip(spent, touched)],
        sum_where(kind == "Credit", amount).alias("total_credit_6m"), F.count(F.lit(1)).alias("transaction_count_6m"))
    known = F.array_compact(F.array(*[F.col(c) for c in spent])) if spent else F.array().cast("array<double>")
    zero = F.lit(0).cast("double")
    total = F.aggregate("__months", zero, lambda s, x: s + x)
    apart = F.aggregate("__months", zero, lambda s, x: s + (x - F.col("avg_monthly_spend")) ** 2)
    count = F.size("__months").cast("long")
    per_customer = (sums.withColumn("__months", known)
                    .withColumns({"__spend_months": count, "total_debit_6m": total, "__top": F.array_max("__months")})
                    .withColumn("avg_monthly_spend", F.coalesce(F.col("total_debit_6m") / F.nullif("__spend_months", F.lit(0)), zero))
                    .withColumn("spending_volatility", F.when(F.col("__spend_months") > 1, F.sqrt(apart / (F.col("__spend_months") - 1))).otherwise(zero)))
    if not keep_credit_only:
        per_customer = per_customer.where(F.col("__spend_months") > 0)
    high = (F.col("__spend_months") >= 2) & (F.col("__top") > 2 * F.col("avg_monthly_spend"))
    ratio = half_even(clip(F.col("total_debit_6m") / F.col("total_credit_6m"), 0, 5), 4)
    return per_customer.select(
        "customer_id", "spending_volatility", "avg_monthly_spend", "total_debit_6m", "total_credit_6m",
        "transaction_count_6m",
        flag(high).alias("high_spend_month_flag"),
        (F.col("total_credit_6m") - F.col("total_debit_6m")).alias("net_cash_flow_6m"),
        (F.col("transaction_count_6m") / 6).alias("transaction_frequency"),
        F.when(F.col("total_credit_6m") > 0, ratio).otherwise(F.lit(0.0)).alias("debit_to_credit_ratio"),
    )


# -- ratios and the matrix ----------------------------------------------------

def ratio_columns() -> dict[str, Column]:
    """Customer-level ratios, each with a guarded denominator."""
    has_loan = F.col("has_loan") == 1
    instalment = F.col("loan_amount") / F.nullif("loan_tenure_months", F.lit(0))
    leverage = half_even(clip(F.col("loan_amount") / F.col("credit_limit"), 0, 10), 4)
    return {
        "credit_utilisation_ratio": half_even(ratio_or(F.col("cc_balance"), F.col("credit_limit")), 4),
        "income_to_loan_ratio": half_even(ratio_or(F.col("income"), F.col("loan_amount")), 4),
        "emi_to_income_ratio": half_even(ratio_or(instalment, F.col("income") / 12, when=has_loan), 4),
        "interest_burden_score": half_even(
            F.when(has_loan, F.col("interest_rate_pct") / 100 * F.col("loan_amount")).otherwise(F.lit(0.0)), 2),
        "loan_to_value_ratio": F.when(has_loan & (F.col("credit_limit") > 0), leverage).otherwise(F.lit(0.0)),
        "credit_age_score": half_even(F.log1p(F.col("tenure_months").cast("double")), 4),
    }


def with_ratios(customers: DataFrame) -> DataFrame:
    return customers.withColumns(ratio_columns())


def fit_levels(df: DataFrame, columns: Sequence[str] = tuple(CATEGORICALS), most: int = MOST_LEVELS) -> dict[str, list[str]]:
    """Sorted values of each categorical column, in one pass; to be stored with a model.

    The values become columns.  A column of more than ``most`` values has no levels: :func:`feature_matrix` makes it an id
    column, as :func:`level_table` does.  At most ``most + 1`` values of a column reach the driver.
    """
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    distinct = df.select(pair.alias("p")).select("p.*").where("value is not null").distinct()
    place = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in distinct.withColumn("place", place).where(F.col("place") <= most + 1).collect():
        levels[row["column"]].append(row["value"])
    return {c: sorted(values) for c, values in levels.items() if len(values) <= most}


def level_table(df: DataFrame, column: str) -> DataFrame:
    """(value, id) of a wide categorical column, which stays one id column and never reaches the driver.

    Ids are hashes of the values: a value keeps its id in every later table.
    """
    return df.select(F.col(column).alias("value")).where("value is not null").distinct().withColumn(f"{column}_id", F.xxhash64("value"))


def with_level_id(df: DataFrame, column: str, levels: DataFrame) -> DataFrame:
    """Replace a wide column by its id in ``levels``; a value that is not there has none."""
    return df.join(levels, df[column] == levels["value"], "left").drop(column, "value")


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Replace each categorical column by 0/1 columns named ``column_value``."""
    dummies = {f"{c}_{v}": flag(F.col(c) == v).cast("int") for c, values in levels.items() for v in values}
    kept = [c for c in df.columns if c not in levels]
    return df.select(*[F.col(f"`{c}`") for c in kept], *[x.alias(name) for name, x in dummies.items()])


def customer_features(customers: DataFrame, repayments: DataFrame, transactions: DataFrame,
                      tie_break: Sequence[str] = (), latest: datetime.date | None = None) -> DataFrame:
    """Customers with ratios and both behaviour blocks; categoricals kept as text.

    Both fact tables are reduced to a row per customer before they meet the
    customer table, so the joins are one to one.
    """
    joined = (with_ratios(customers)
              .join(repayment_features(repayments, tie_break), "customer_id", "left")
              .join(transaction_features(transactions, latest=latest), "customer_id", "left"))
    return joined.na.fill(0, REPAYMENT_FEATURES + TRANSACTION_FEATURES)


def feature_matrix(customers: DataFrame, repayments: DataFrame, transactions: DataFrame,
                   levels: dict[str, list[str]] | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """The modelling table: numeric features plus one-hot columns; a categorical column without levels becomes an id."""
    levels = fit_levels(customers) if levels is None else levels
    return wide_as_ids(one_hot(customer_features(customers, repayments, transactions, tie_break), levels), levels)


def wide_as_ids(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Categorical columns that have no levels as ids ``<column>_id``, the hash of the value; models leave ids out."""
    for c in CATEGORICALS:
        if c in df.columns and c not in levels:
            df = df.withColumn(f"{c}_id", F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c).cast("string")))).drop(c)
    return df


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("customer_id", "defaulted")) -> list[str]:
    """Names of numeric and boolean columns, in table order."""
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in exclude]


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project the listed columns that exist, keeping the list's order."""
    return df.select(*[c for c in columns if c in df.columns])


def portfolio_shape(features: DataFrame) -> DataFrame:
    """Row count, feature count and default rate of a feature table."""
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(numeric_columns(features))).cast("long").alias("features"),
        F.avg("defaulted").alias("default_rate"),
    )
