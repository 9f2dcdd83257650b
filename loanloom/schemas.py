"""Declared schemas of the banking tables (money is double, as in the source data)."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec.items()])


_S, _L, _D, _DATE, _I = T.StringType(), T.LongType(), T.DoubleType(), T.DateType(), T.IntegerType()

CUSTOMERS = _struct({
    "customer_id": _S, "age": _L, "income": _D, "employment_type": _S, "city": _S,
    "account_type": _S, "tenure_months": _L, "credit_score": _L, "has_loan": _L,
    "loan_amount": _D, "loan_tenure_months": _L, "interest_rate_pct": _D,
    "has_credit_card": _L, "credit_limit": _D, "cc_balance": _D, "defaulted": _L,
})
REPAYMENTS = _struct({
    "customer_id": _S, "due_date": _DATE, "emi_amount": _D, "paid_amount": _D, "payment_status": _S,
})
TRANSACTIONS = _struct({
    "transaction_id": _S, "customer_id": _S, "transaction_date": _DATE, "amount": _D,
    "transaction_type": _S, "category": _S,
})
RISK_SCORED = _struct({
    "customer_id": _S, "credit_score": _L, "income": _D, "defaulted": _L,
    "default_probability": _D, "risk_tier": _S,
})
CLV_ESTIMATES = _struct({
    "customer_id": _S, "estimated_clv": _D, "clv_segment": _S, "annual_revenue_est": _D,
    "default_probability": _D,
})
CUSTOMER_SEGMENTS = _struct({"customer_id": _S, "segment": _I})
MONTHLY_REVENUE = _struct({"month": _DATE, "revenue": _D})
REVENUE_FORECAST = _struct({
    "month": _DATE, "revenue": _D, "lower_95": _D, "upper_95": _D, "type": _S,
})

BY_NAME = {
    "customers": CUSTOMERS,
    "repayment_history": REPAYMENTS,
    "transactions": TRANSACTIONS,
    "risk_scored": RISK_SCORED,
    "clv_estimates": CLV_ESTIMATES,
    "customer_segments": CUSTOMER_SEGMENTS,
    "monthly_revenue": MONTHLY_REVENUE,
    "revenue_forecast": REVENUE_FORECAST,
}
