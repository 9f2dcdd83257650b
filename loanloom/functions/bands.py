"""Band labels.  Two families on purpose: the SQL reports use left-closed bands,
the dashboards right-closed ones, and they disagree exactly on the edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band edges and labels.
UTILISATION_SQL = ([0.30, 0.60, 0.90],
                   ["Low (< 30%)", "Medium (30–60%)", "High (60–90%)", "Very High (> 90%)"])
TENURE_SQL = ([12, 36, 60], ["0–12 months", "1–3 years", "3–5 years", "5+ years"])
INCOME_SQL = ([200000, 500000, 1000000, 2000000],
              ["Low Income (< ₹2L)", "Lower Middle (₹2L–5L)", "Middle (₹5L–10L)",
               "Upper Middle (₹10L–20L)", "High Income (> ₹20L)"])
UTILISATION_DASH = ([0, 0.3, 0.6, 0.9, 999],
                    ["Low (<30%)", "Medium (30-60%)", "High (60-90%)", "Very High (>90%)"])
TENURE_DASH = ([0, 12, 36, 60, 999], ["0-12m", "1-3yr", "3-5yr", "5+yr"])
INCOME_DASH = ([0, 200000, 500000, 1000000, 2000000, 999999999],
               ["<2L", "2-5L", "5-10L", "10-20L", ">20L"])
RISK_TIERS = ([0, 0.30, 0.60, 1.01], ["Low Risk", "Medium Risk", "High Risk"])
CLV_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]


def left_closed(value: Column, spec: tuple[list, list[str]]) -> Column:
    """``[.., e1) [e1, e2) .. [en, ..)``; NULL falls into the last band."""
    edges, labels = spec
    out = F.when(value < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        out = out.when(value < edge, label)
    return out.otherwise(labels[-1])


def right_closed(value: Column, spec: tuple[list, list[str]]) -> Column:
    """``(e0, e1] (e1, e2] ..``; anything outside, and NULL, gets no band."""
    edges, labels = spec
    out = F.when((value > edges[0]) & (value <= edges[1]), labels[0])
    for low, high, label in zip(edges[1:], edges[2:], labels[1:]):
        out = out.when((value > low) & (value <= high), label)
    return out


def utilisation(balance: Column, limit: Column) -> Column:
    """Card balance over limit, NULL without a limit."""
    return balance / F.nullif(limit, F.lit(0.0))


def risk_tier(probability: Column) -> Column:
    """Tier of a batch-scored probability: right-closed, so 0 has no tier."""
    return right_closed(probability, RISK_TIERS)


def what_if_tier(probability: Column) -> Column:
    """Tier used by scenario scoring: left-closed at 0.3 and 0.6."""
    return (F.when(probability >= 0.6, "High Risk")
             .when(probability >= 0.3, "Medium Risk")
             .otherwise("Low Risk"))


def recommendation(probability: Column) -> Column:
    """Credit decision that goes with :func:`what_if_tier`."""
    return (F.when(probability >= 0.6, "DECLINE")
             .when(probability >= 0.3, "CONDITIONAL APPROVAL")
             .otherwise("APPROVE"))


def quartile_tier(value: Column, cuts: list[float]) -> Column:
    """Quartile label, right-closed with the minimum included."""
    if len(set(cuts)) != len(cuts):
        raise ValueError(f"quartile edges must be distinct, got {cuts}")
    out = F.when(value <= cuts[0], CLV_TIERS[0])
    for cut, label in zip(cuts[1:], CLV_TIERS[1:-1]):
        out = out.when(value <= cut, label)
    return F.when(value.isNotNull(), out.otherwise(CLV_TIERS[-1]))


def band_order(labels: list[str], column: Column) -> Column:
    """Ordinal position of a label, for sorting in band order."""
    order = F.create_map(*[F.lit(x) for i, label in enumerate(labels) for x in (label, i)])
    return order[column]
