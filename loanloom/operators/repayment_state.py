"""Repayment features that grow with new payments instead of being read again.

A customer's history is one small state: its sums, the runs of missed payments that touch its two ends, and the longest run.  States of
neighbouring stretches of time merge by an associative rule (a run may cross the seam), so the state of a book and that of
a new month give the state of both, and no old payment is read again.  The same rule folds the pieces of a hot customer's
time line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators import features
from loanloom.session import materialise

STATE = ["n", "whole", "head", "best", "tail", "first_due", "last_due", "in_order", *[p.strip("_") + "_sum" for p in features._PARTS]]
_SUMS = [c for c in STATE if c.endswith("_sum")]


def merged(a: Column, b: Column) -> Column:
    """The state of a stretch of time and the one after it; a NULL state is an empty stretch."""
    both = {
        "n": a["n"] + b["n"],
        "whole": a["whole"] & b["whole"],
        "head": F.when(a["whole"], a["n"] + b["head"]).otherwise(a["head"]),
        "best": F.greatest(a["best"], b["best"], a["tail"] + b["head"]),
        "tail": F.when(b["whole"], b["n"] + a["tail"]).otherwise(b["tail"]),
        "first_due": a["first_due"],
        "last_due": F.greatest(a["last_due"], b["last_due"]),
        # A payment without a date comes before all others: a stretch with one has no first date and only follows a stretch of such.
        "in_order": a["in_order"] & b["in_order"] & F.coalesce(a["last_due"] <= b["first_due"], a["last_due"].isNull()),
        **{c: a[c] + b[c] for c in _SUMS},
    }
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.struct(*[x.alias(c) for c, x in both.items()]))


def state_of(repayments: DataFrame, tie_break: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """(customer_id, state) of the payments, each customer's time line cut at common bounds and folded in order."""
    rows = features._cut(features._flagged(repayments, tie_break), tie_break, ranges)
    order = [*tie_break, features._LAST]
    dates = rows.groupBy("customer_id", "__chunk").agg(
        F.when(F.count_if(F.col("due_date").isNull()) == 0, F.min("due_date")).alias("first_due"), F.max("due_date").alias("last_due"))
    pieces = features._runs(rows, ["customer_id", "__chunk"], order).groupBy("customer_id", "__chunk").agg(
        F.max("__breaks").alias("__last"), F.max("__run").alias("best"),
        F.coalesce(F.max(F.when(F.col("__breaks") == 0, F.col("__run"))), F.lit(0)).alias("head"), F.max_by("__run", "__breaks").alias("tail"),
        *[F.sum(p).alias(c) for p, c in zip(features._PARTS, _SUMS)])
    pieces = pieces.join(dates, ["customer_id", "__chunk"])
    own = {"n": F.col("n_sum"), "whole": F.col("__last") == 0, "in_order": F.lit(True)}
    piece = F.struct(*[own.get(c, F.col(c)).alias(c) for c in STATE])
    held = pieces.groupBy("customer_id").agg(F.array_sort(F.collect_list(F.struct(F.col("__chunk").alias("chunk"), piece.alias("state")))).alias("pieces"))
    states = F.transform("pieces", lambda p: p["state"])
    # Pieces follow each other by construction, whatever dates they lack.
    folded = F.aggregate(F.slice(states, F.lit(2), F.greatest(F.size("pieces") - 1, F.lit(0))), F.get(states, F.lit(0)), merged)
    return held.select("customer_id", folded.withField("in_order", F.lit(True)).alias("state"))


def grown(state: DataFrame, later: DataFrame) -> DataFrame:
    """The state after ``later`` (also a state), one join of one row a customer each.

    Later payments must not be due before the stored ones; ``state.in_order`` is false for customers where
    some are, whose state has to be built from their payments anew.
    """
    met = state.select("customer_id", F.col("state").alias("a")).join(later.select("customer_id", F.col("state").alias("b")), "customer_id", "full")
    return met.select("customer_id", merged(F.col("a"), F.col("b")).alias("state"))


def stored_state(state: DataFrame, rows: int) -> DataFrame:
    """The state written once, bucketed by customer, so that the next month joins it without a shuffle of the book."""
    return materialise(state, "repayment_state", "customer_id", rows)


def features_of(state: DataFrame) -> DataFrame:
    """The columns of :func:`features.repayment_features` from states."""
    s = F.col("state")
    share = lambda name: s[f"{name}_sum"] / s["n_sum"]
    return state.select(
        "customer_id", share("on_time").alias("repayment_consistency_score"), s["missed_sum"].alias("total_missed_payments"),
        (s["covered_sum"] / F.nullif(s["coverable_sum"], F.lit(0))).alias("avg_payment_coverage"), share("late").alias("late_payment_rate"),
        share("delayed").alias("payment_delay_frequency"), s["best"].alias("max_consecutive_missed"))
