"""Independent SQL for the registered queries, written for DuckDB.

The banking relations are common table expressions over the driver tables; each
query names the ones it needs and the text is put together from them.
"""

from __future__ import annotations

import math

from loanloom.operators.features import RATIO_FEATURES, REPAYMENT_FEATURES, TRANSACTION_FEATURES
from loanloom.operators.segments import CLUSTER_FEATURES, RADAR_DASH, RADAR_REPORT
from loanloom.operators.stationarity import HIGH_BRANCH, LOW_BRANCH, TAU_LEAST, TAU_MOST, TAU_SPLIT
from loanloom.operators.trend import CHANGE_RANGE, CHANGES, HARMONICS
from loanloom.plans.bank import CENTROIDS
from loanloom.plans.registry import RULE_INPUTS, RULE_TREES, SHAP_WEIGHTS
from loanloom.sources.bank_views import ACCOUNT_LEVELS, EMPLOYMENT_LEVELS

CITIES = sorted(f"NATION_{i}" for i in range(25))


def even(value: str, digits: int) -> str:
    """Rounding with ties to the even neighbour."""
    scale = f"cast(1e{digits} as double)"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


def clamp(value: str, low: float, high: float) -> str:
    return f"(case when ({value}) is not null then least(greatest({value}, {low}::double), {high}::double) end)"


# name -> (relations it reads, body)
RELATIONS: dict[str, tuple[list[str], str]] = {}


def relation(name: str, needs: list[str], body: str) -> None:
    RELATIONS[name] = (needs, body)


def compose(needs: list[str], body: str) -> str:
    """Prefix ``body`` with the relations it needs, each after its own needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in RELATIONS[name][0]:
                visit(other)
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} as (\n{RELATIONS[name][1].strip()}\n)" for name in ordered)
    return f"with {parts}\n{body.strip()}"


relation("loans", [], """
select o_custkey, max(o_totalprice) as loan from orders
where o_orderstatus = 'O' and o_orderpriority = '1-URGENT' group by o_custkey""")

relation("people", ["loans"], """
select *, credit_limit * ((c_custkey * 13) % 96)::double / 100 as cc_balance from (
  select *, case when has_credit_card = 1 then income * (30 + c_custkey % 121)::double / 100
                 else 0::double end as credit_limit
  from (
    select c_custkey,
      'CUST' || lpad(cast(c_custkey + 1 as varchar), 7, '0') as customer_id,
      22 + c_custkey % 48 as age,
      (c_acctbal + 1000) * 200 as income,
      case c_mktsegment when 'AUTOMOBILE' then 'Salaried' when 'BUILDING' then 'Self-Employed'
        when 'FURNITURE' then 'Business Owner' when 'HOUSEHOLD' then 'Retired'
        when 'MACHINERY' then 'Unemployed' end as employment_type,
      n_name as city,
      case c_custkey % 3 when 0 then 'Savings' when 1 then 'Current' else 'Salary' end as account_type,
      1 + (c_custkey * 7) % 179 as tenure_months,
      300 + (c_custkey * 37) % 601 as credit_score,
      cast(loan is not null as bigint) as has_loan,
      coalesce(loan, 0::double) as loan_amount,
      case when loan is not null then 12 + c_custkey % 72 else 0 end::bigint as loan_tenure_months,
      case when loan is not null then (85 + c_custkey % 101)::double / 10 else 0::double end as interest_rate_pct,
      cast(c_custkey % 20 < 11 as bigint) as has_credit_card
    from customer
    join nation on n_nationkey = c_nationkey
    left join loans on o_custkey = c_custkey))""")

RAW_SCORE = """0.40::double * (1 - (credit_score - 300)::double / 600)
  + 0.20::double * (employment_type is not distinct from 'Unemployed')::int
  + 0.15::double * least(greatest(least(greatest(
        case when loan_tenure_months > 0 then loan_amount / loan_tenure_months else 0::double end
        / greatest({income} / 12, 1::double), 0::double), 5::double), 0::double), 1::double)
  + 0.12::double * least(greatest(
        case when credit_limit > 0 then cc_balance / credit_limit else 0::double end, 0::double), 1::double)
  + 0.08::double * ({income} < 250000)::int
  + 0.05::double * has_loan""".replace("{income}", "income")

relation("raw_scored", ["people"], f"select *, {RAW_SCORE} as raw_score from people")
relation("score_range", ["raw_scored"], "select min(raw_score) as low, max(raw_score) as high from raw_scored")
relation("scored", ["raw_scored", "score_range"], """
select r.*, (raw_score - low) / (high - low + 1e-9::double) as risk_score from raw_scored r, score_range""")
relation("label_cuts", ["scored"], """
select quantile_cont(risk_score, 0.45) as good, quantile_cont(risk_score, 0.55) as bad from scored""")
relation("customers", ["scored", "label_cuts"], """
select s.*, cast(case when risk_score >= bad then 1 when risk_score <= good then 0
                      else c_custkey % 2 end as bigint) as defaulted
from scored s, label_cuts""")

relation("repayment_history", ["loans"], """
select customer_id, due_date, emi_amount, payment_status, o_orderkey,
  case payment_status when 'On-Time' then emi_amount
    when 'Late' then emi_amount * (o_orderkey % 90)::double / 100 else 0::double end as paid_amount
from (
  select 'CUST' || lpad(cast(o_custkey + 1 as varchar), 7, '0') as customer_id,
    cast(o_orderdate as date) as due_date, o_totalprice as emi_amount, o_orderkey,
    case when o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '2-HIGH') then 'Late'
         when o_orderstatus = 'P' and o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'Missed'
         else 'On-Time' end as payment_status
  from orders where o_custkey in (select o_custkey from loans))""")

relation("transactions", [], """
select 'CUST' || lpad(cast(o_custkey + 1 as varchar), 7, '0') as customer_id,
  cast(l_shipdate as date) as transaction_date, l_extendedprice as amount,
  case when l_returnflag = 'R' then 'Credit' else 'Debit' end as transaction_type, p_type as category
from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey""")

relation("risk_scored", ["customers"], f"""
select customer_id, credit_score, income, defaulted, {even('risk_score', 4)} as default_probability,
  case when risk_score > 0 and risk_score <= 0.30::double then 'Low Risk'
       when risk_score > 0.30::double and risk_score <= 0.60::double then 'Medium Risk'
       when risk_score > 0.60::double and risk_score <= 1.01::double then 'High Risk' end as risk_tier
from customers""")

relation("clv_values", ["customers", "risk_scored"], f"""
select customer_id, {even('annual_revenue_est * greatest(tenure_months / 12, 0.5::double) * (1 - coalesce(default_probability, 0.10::double))', 2)} as estimated_clv,
  annual_revenue_est, default_probability
from (
  select c.customer_id, tenure_months, default_probability,
    coalesce(loan_amount * (interest_rate_pct / 100) + credit_limit * 0.02::double + c.income * 0.003::double, 0)
      as annual_revenue_est
  from customers c left join risk_scored r on r.customer_id = c.customer_id)""")
relation("clv_cuts", ["clv_values"], """
select quantile_cont(estimated_clv, 0.25) as a, quantile_cont(estimated_clv, 0.5) as b,
  quantile_cont(estimated_clv, 0.75) as c from clv_values""")
relation("clv_estimates", ["clv_values", "clv_cuts"], """
select v.*, case when estimated_clv <= a then 'Bronze' when estimated_clv <= b then 'Silver'
  when estimated_clv <= c then 'Gold' else 'Platinum' end as clv_segment from clv_values v, clv_cuts""")

# -- features -----------------------------------------------------------------

relation("streaks", ["repayment_history"], """
select customer_id, max(run) as max_consecutive_missed from (
  select customer_id, island, cast(sum(m) as bigint) as run from (
    select customer_id, (payment_status = 'Missed')::int as m,
      sum((payment_status <> 'Missed')::int) over (
        partition by customer_id order by due_date, o_orderkey rows unbounded preceding) as island
    from repayment_history) group by customer_id, island)
group by customer_id""")
relation("repayment_rates", ["repayment_history"], """
select customer_id, avg((payment_status = 'On-Time')::int) as repayment_consistency_score,
  count(*) filter (where payment_status = 'Missed') as total_missed_payments,
  avg(case when emi_amount > 0 then least(greatest(paid_amount / emi_amount, 0::double), 1::double)
           when emi_amount = 0 and paid_amount > 0 then 1::double end) as avg_payment_coverage,
  avg((payment_status = 'Late')::int) as late_payment_rate,
  avg((payment_status <> 'On-Time')::int) as payment_delay_frequency
from repayment_history group by customer_id""")
relation("repayment_block", ["repayment_rates", "streaks"],
         "select * from repayment_rates left join streaks using (customer_id)")

relation("latest", [], "select max(cast(l_shipdate as date)) as latest from lineitem")
relation("window_rows", ["transactions", "latest"], """
select t.* from transactions t, latest where transaction_date >= latest - interval 6 month""")
relation("window_months", ["window_rows"], """
select customer_id, cast(date_trunc('month', transaction_date) as date) as month,
  sum(amount) filter (where transaction_type = 'Debit') as debit,
  coalesce(sum(amount) filter (where transaction_type = 'Credit'), 0) as credit, count(*) as n
from window_rows group by 1, 2""")
relation("spend_all", ["window_months"], f"""
select *, total_credit_6m - total_debit_6m as net_cash_flow_6m, transaction_count_6m / 6 as transaction_frequency,
  case when total_credit_6m > 0 then {even(clamp('total_debit_6m / total_credit_6m', 0, 5), 4)} else 0::double end
    as debit_to_credit_ratio
from (
  select customer_id, coalesce(stddev_samp(debit), 0::double) as spending_volatility,
    coalesce(avg(debit), 0::double) as avg_monthly_spend, coalesce(sum(debit), 0::double) as total_debit_6m,
    sum(credit) as total_credit_6m, cast(sum(n) as bigint) as transaction_count_6m,
    cast(count(debit) >= 2 and coalesce(max(debit) > 2 * avg(debit), false) as bigint) as high_spend_month_flag,
    count(debit) as spend_months
  from window_months group by customer_id)""")
relation("spend_block", ["spend_all"], "select * from spend_all where spend_months > 0")

RATIOS = f"""
  {even('case when credit_limit > 0 then cc_balance / credit_limit else 0::double end', 4)} as credit_utilisation_ratio,
  {even('case when loan_amount > 0 then income / loan_amount else 0::double end', 4)} as income_to_loan_ratio,
  {even('case when has_loan = 1 and income > 0 then (loan_amount / nullif(loan_tenure_months, 0)) / (income / 12) else 0::double end', 4)} as emi_to_income_ratio,
  {even('case when has_loan = 1 then interest_rate_pct / 100 * loan_amount else 0::double end', 2)} as interest_burden_score,
  case when has_loan = 1 and credit_limit > 0 then {even(clamp('loan_amount / credit_limit', 0, 10), 4)} else 0::double end as loan_to_value_ratio,
  {even('ln(1 + tenure_months::double)', 4)} as credit_age_score"""
relation("ratios", ["people"], f"select customer_id, {RATIOS} from people")

BEHAVIOUR = ", ".join(f"coalesce({c}, 0) as {c}" for c in REPAYMENT_FEATURES + TRANSACTION_FEATURES)
relation("features", ["customers", "ratios", "repayment_block", "spend_block"], f"""
select c.* exclude (c_custkey, raw_score, risk_score), {", ".join(RATIO_FEATURES)}, {BEHAVIOUR}
from customers c join ratios using (customer_id)
left join repayment_block using (customer_id) left join spend_block using (customer_id)""")

DUMMIES = [(c, v) for c, values in (("employment_type", EMPLOYMENT_LEVELS), ("account_type", ACCOUNT_LEVELS),
                                    ("city", CITIES)) for v in values]
DUMMY_SQL = ", ".join(f"""cast({c} = '{v}' as int) as "{c}_{v}" """ for c, v in DUMMIES)

# -- segmentation ---------------------------------------------------------------

relation("cluster_inputs", ["features", "clv_values", "risk_scored"], """
select f.*, v.estimated_clv, r.default_probability from features f
left join clv_values v using (customer_id)
left join (select customer_id, default_probability from risk_scored) r using (customer_id)""")
relation("feature_moments", ["cluster_inputs"], "select " + ", ".join(
    f"avg({c}::double) as m_{c}, stddev_pop({c}::double) as s_{c}" for c in CLUSTER_FEATURES)
    + " from cluster_inputs")
relation("zscores", ["cluster_inputs", "feature_moments"], "select customer_id, " + ", ".join(
    f"case when s_{c} > 0 then ({c}::double - m_{c}) / s_{c} else 0 end as z_{c}" for c in CLUSTER_FEATURES)
    + " from cluster_inputs, feature_moments")
relation("distances", ["zscores"], "\nunion all\n".join(
    f"select customer_id, {segment} as segment, " + " + ".join(
        f"(z_{c} - ({x}::double)) * (z_{c} - ({x}::double))" for c, x in zip(CLUSTER_FEATURES, center))
    + " as distance from zscores" for segment, center in CENTROIDS.items()))
relation("customer_segments", ["distances"], """
select customer_id, segment from distances
qualify row_number() over (partition by customer_id order by distance, segment) = 1""")
relation("segmented", ["cluster_inputs", "customer_segments"],
         "select * from cluster_inputs join customer_segments using (customer_id)")

BOOK_CUSTOMER = """c.customer_id, age, c.income, employment_type, city, account_type, tenure_months, c.credit_score,
  has_loan, loan_amount, loan_tenure_months, interest_rate_pct, has_credit_card, credit_limit, cc_balance, c.defaulted"""
relation("book", ["customers", "risk_scored", "clv_estimates"], f"""
select {BOOK_CUSTOMER}, r.default_probability, risk_tier, estimated_clv, clv_segment
from customers c left join risk_scored r on r.customer_id = c.customer_id
left join clv_estimates v on v.customer_id = c.customer_id""")
relation("book_seg", ["book", "customer_segments"],
         "select * from book left join customer_segments using (customer_id)")

# -- evaluation -------------------------------------------------------------------

relation("score_counts", ["customers"], """
select risk_score as threshold, count(*) filter (where defaulted = 1) as pos,
  count(*) filter (where defaulted = 0) as neg from customers group by 1""")
relation("sweep", ["score_counts"], """
select *, sum(pos) over (order by threshold desc rows unbounded preceding) as tp,
  sum(neg) over (order by threshold desc rows unbounded preceding) as fp,
  sum(pos) over () as all_pos, sum(neg) over () as all_neg from score_counts""")
relation("decided", ["customers"], """
select customer_id, defaulted, cast(risk_score >= 0.40::double as bigint) as predicted from customers""")

# -- forecasting --------------------------------------------------------------------

MARGIN = "amount * case when transaction_type = 'Credit' then 0.015::double else 0.005::double end"
relation("series", ["transactions"], f"""
select 'all' as category, cast(date_trunc('month', transaction_date) as date) as month, sum({MARGIN}) as revenue
from transactions group by 1, 2""")
relation("series_cat", ["transactions"], f"""
select category, cast(date_trunc('month', transaction_date) as date) as month, sum({MARGIN}) as revenue
from transactions group by 1, 2""")


def dickey_fuller_sql(source: str, key: str) -> tuple[list[str], str]:
    return [source], f"""
select {key} n as observations, round(slope, 6) as slope, round(t, 6) as t_stat,
  case when t < -2.9::double then 0 else 1 end as d
from (
  select *, slope / sqrt(greatest((syy - slope * slope * sxx) / (n - 2), 0) / sxx) as t from (
    select category, count(x) as n, regr_slope(dy, x) as slope, regr_sxx(dy, x) as sxx, regr_syy(dy, x) as syy
    from (select category, revenue - lag(revenue) over w as dy, lag(revenue) over w as x
          from {source} window w as (partition by category order by month))
    group by category))"""


def seasonal_parts(source: str) -> str:
    return f"""
timed as (select category, month, revenue as y,
  row_number() over (partition by category order by month)::double as t from {source}),
trend as (select category, regr_slope(y, t) as b, regr_intercept(y, t) as a, max(t) as size, max(month) as last
  from timed group by category),
season as (select category, month(month) as moy, avg(y / (a + b * t)) as f
  from timed join trend using (category) group by 1, 2),
spread as (select category, stddev_samp(y - (a + b * t) * f) as sd
  from timed join trend using (category) join season using (category)
  where month(month) = moy group by 1),
ahead as (select category, cast(last + to_months(cast(k as int)) as date) as month, (a + b * (size + k)) * coalesce(f, 1) as v, sd
  from (select trend.*, unnest(range(1, 13)) as k from trend) x join spread using (category)
  left join season using (category) where moy = month(last + to_months(cast(k as int))))"""


def seasonal_sql(source: str, key: str, select: str, tail: str = "") -> str:
    prefix = compose([source], "")
    body = f"select {key} month, {select} from ahead {tail}"
    return f"{prefix.rstrip()},\n{seasonal_parts(source).strip()}\n{body}"


def _elimination(name: str, gram: str, steps: str) -> str:
    """Relation ``name`` (category, k, i, j, v): the matrices of ``gram`` after k eliminated columns."""
    return f"""{name} as (
  select category, 0 as k, i, j, v from {gram}
  union all
  select a.category, a.k + 1, a.i, a.j,
    case when a.i > a.k and a.j > a.k and p.v > 1e-10::double * o.v then a.v - b.v * c.v / p.v else a.v end
  from {name} a join {name} b on b.category = a.category and b.i = a.i and b.j = a.k
  join {name} c on c.category = a.category and c.i = a.k and c.j = a.j
  join {name} p on p.category = a.category and p.i = a.k and p.j = a.k
  join {gram} o on o.category = a.category and o.i = a.k and o.j = a.k
  join sized s on s.category = a.category where a.k < s.{steps})"""


def augmented_dickey_fuller_sql(source: str, key: str) -> str:
    """All lag counts by relational elimination; the normal distribution by Simpson's rule."""
    low = " + ".join(f"{w}::double * power(t, {i})" for i, w in enumerate(LOW_BRANCH))
    high = " + ".join(f"{w}::double * power(t, {i})" for i, w in enumerate(HIGH_BRANCH))
    prefix = compose([source], "").rstrip().replace("with ", "with recursive ", 1).replace(f"{source} as (", f"{source} as materialized (")
    return f"""{prefix},
placed as materialized (
  select category, (revenue - avg(revenue) over (partition by category)) / stddev_pop(revenue) over (partition by category) as v,
    row_number() over (partition by category order by month) - 1 as t, count(*) over (partition by category) as n from {source}),
most as materialized (
  select category, n, least(ceil(12 * power(n / 100, 0.25)), n // 2 - 2)::int as m from placed group by category, n),
moved as materialized (
  select category, t, v, lead(v) over (partition by category order by t) - v as dv from placed qualify dv is not null),
design as materialized (
  select category, t, 0 as i, 1.0::double as v from moved union all select category, t, 1, v from moved
  union all select a.category, a.t, 1 + (a.t - b.t)::int, b.dv from moved a join moved b on a.category = b.category and b.t < a.t),
wide as materialized (
  select d.category, t, i, v from design d join most using (category) where t >= m and i <= m + 1
  union all select category, t, m + 2, dv from moved join most using (category) where t >= m),
gram as materialized (select a.category, a.i, b.i as j, sum(a.v * b.v) as v from wide a join wide b using (category, t) group by 1, 2, 3),
sized as materialized (select category, n, m, m + 2 as steps from most),
{_elimination("reduced", "gram", "steps")},
taken as materialized (
  select a.category, a.i as p, case when d.v > 1e-10::double * o.v then a.v * a.v / d.v else 0 end as v
  from reduced a join sized s on s.category = a.category and a.k = s.steps and a.j = s.steps and a.i < s.steps
  join reduced d on d.category = a.category and d.k = a.k and d.i = a.i and d.j = a.i
  join gram o on o.category = a.category and o.i = a.i and o.j = a.i),
judged as materialized (
  select s.category, l.lag, (n - 1 - m) * ln((y.v - sum(x.v)) / (n - 1 - m)) + 2 * (l.lag + 2) as aic
  from sized s join (select unnest(range(0, 200)) as lag) l on l.lag <= s.m
  join gram y on y.category = s.category and y.i = s.steps and y.j = s.steps
  join taken x on x.category = s.category and x.p < l.lag + 2 group by s.category, l.lag, n, m, y.v),
picked as materialized (select category, lag from judged qualify row_number() over (partition by category order by aic, lag) = 1),
narrow as materialized (
  select d.category, t, case when i = 1 then lag + 1 when i > 1 then i - 1 else 0 end as i, v
  from design d join picked using (category) where t >= lag and i <= lag + 1
  union all select category, t, lag + 2, dv from moved join picked using (category) where t >= lag),
gram2 as materialized (select a.category, a.i, b.i as j, sum(a.v * b.v) as v from narrow a join narrow b using (category, t) group by 1, 2, 3),
{_elimination("reduced2", "gram2", "steps").replace("join sized s on", "join (select category, lag + 1 as steps from picked) s on")},
ends as materialized (
  select p.category, lag, max(v) filter (where i = lag + 1 and j = lag + 1) as sxx, max(v) filter (where i = lag + 1 and j = lag + 2) as sxy,
    max(v) filter (where i = lag + 2 and j = lag + 2) as syy
  from reduced2 r join picked p on p.category = r.category and r.k = lag + 1 group by p.category, lag),
tested as materialized (
  select category, n, lag, sxy / sxx / sqrt((syy - sxy * sxy / sxx) / (n - 1 - lag - (lag + 2)) / sxx) as t from ends join most using (category)),
placed_p as (select *, case when t <= {TAU_SPLIT} then {low} else {high} end as x from tested),
valued as (
  select category, n, lag, t, case when t > {TAU_MOST} then 1.0 when t < {TAU_LEAST} then 0.0 else 0.5 + area end as p from placed_p,
    lateral (select sum(case when u in (0, 4000) then 1 when u % 2 = 1 then 4 else 2 end
                        * exp(-power(greatest(least(x, 12), -12) * u / 4000, 2) / 2)) * greatest(least(x, 12), -12) / 12000 / sqrt(2 * pi()) as area
             from (select unnest(range(0, 4001)) as u)))
select {key} cast(n as int) as observations, lag::int as lags, round(t, 6) as t_stat, round(p, 6) as p_value, case when p < 0.05::double then 0 else 1 end as d
from valued"""


BOUNDS = ("round(v, 2) as revenue, round(v - 1.96::double * sd, 2) as lower_95, "
          "round(v + 1.96::double * sd, 2) as upper_95")

# -- the queries ----------------------------------------------------------------------

SQL: dict[str, tuple[list[str], str]] = {}


def sql(name: str, needs: list[str], body: str) -> None:
    SQL[name] = (needs, body)


RATE = "round(avg(defaulted) * 100, 2) as default_rate_pct"
NPA = "coalesce(sum(loan_amount) filter (where defaulted = 1), 0)"

sql("q1_default_by_employment", ["customers"], f"""
select employment_type, count(*) as total_customers, cast(sum(defaulted) as bigint) as total_defaults, {RATE},
  round(avg(credit_score), 0) as avg_credit_score, round(avg(income), 2) as avg_income,
  round(avg(loan_amount), 2) as avg_loan_amount
from customers group by employment_type""")
sql("q1_default_by_employment_dash", ["customers"], f"""
select employment_type, count(*) as total_customers, cast(sum(defaulted) as bigint) as total_defaults,
  {RATE}, round(avg(credit_score), 4) as avg_credit_score, round(avg(income), 4) as avg_income
from customers group by employment_type""")
sql("q2_high_risk_customers", ["customers", "risk_scored", "customer_segments"], """
select c.customer_id, city, employment_type, c.credit_score, round(c.income, 4) as income,
  round(loan_amount, 4) as loan_amount, round(default_probability, 4) as default_probability, risk_tier, segment
from customers c join risk_scored r on r.customer_id = c.customer_id
join customer_segments s on s.customer_id = c.customer_id
where risk_tier = 'High Risk' and has_loan = 1
order by r.default_probability desc, c.customer_id limit 100""")
sql("q2_high_risk_customers_dash", ["book"], """
select customer_id, city, employment_type, credit_score, round(income, 4) as income,
  round(loan_amount, 4) as loan_amount, round(default_probability, 4) as default_probability, risk_tier
from book where risk_tier = 'High Risk' order by book.default_probability desc, customer_id limit 20""")
COLLECTION = """round(sum(emi_amount), 2) as total_emi_billed, round(sum(paid_amount), 2) as total_collected,
  round(sum(paid_amount) / nullif(sum(emi_amount), 0) * 100, 2) as collection_rate_pct,
  count(*) filter (where payment_status = 'Missed') as missed_payments,
  count(*) filter (where payment_status = 'Late') as late_payments
from repayment_history group by 1"""
sql("q3_emi_collection", ["repayment_history"], f"""
select cast(date_trunc('month', due_date) as date) as repayment_month, count(*) as total_emi_dues, {COLLECTION}""")
sql("q3_emi_collection_dash", ["repayment_history"], f"""
select cast(date_trunc('month', due_date) as date) as repayment_month, {COLLECTION}""")
sql("q4_utilisation_bands", ["customers"], f"""
select case when u < 0.30::double then 'Low (< 30%)' when u < 0.60::double then 'Medium (30–60%)'
    when u < 0.90::double then 'High (60–90%)' else 'Very High (> 90%)' end as utilisation_band,
  count(*) as customer_count, {RATE}, round(avg(credit_score), 0) as avg_credit_score
from (select *, cc_balance / nullif(credit_limit, 0) as u from customers where has_credit_card = 1) group by 1""")
sql("q4_utilisation_bands_dash", ["customers"], f"""
select band as utilisation_band, count(customer_id) as customer_count, {RATE},
  round(avg(credit_score), 4) as avg_credit_score
from (values ('Low (<30%)', 0, 0.3::double), ('Medium (30-60%)', 0.3::double, 0.6::double),
  ('High (60-90%)', 0.6::double, 0.9::double), ('Very High (>90%)', 0.9::double, 999)) d(band, lo, hi)
left join (select *, cc_balance / nullif(credit_limit, 0) as u from customers) on u > lo and u <= hi group by 1""")
CITY = f"""select city, count(*) as total_customers, round(sum(loan_amount), 2) as total_loan_exposure,
  round({NPA}, 2) as npa_exposure, round({NPA} / %s * 100, 2) as npa_rate_pct,
  round(avg(credit_score), 0) as avg_credit_score from customers where has_loan = 1 group by city"""
sql("q5_city_npa", ["customers"], CITY % "nullif(sum(loan_amount), 0)")
sql("q5_city_npa_dash", ["customers"], CITY % "greatest(sum(loan_amount), 1)")
sql("q6_category_spend", ["transactions"], """
select category, transaction_type, count(*) as txn_count, round(sum(amount), 2) as total_volume,
  round(avg(amount), 2) as avg_txn_amount, round(stddev_samp(amount), 2) as txn_amount_stddev
from transactions group by 1, 2""")
sql("q6_category_spend_dash", ["transactions"], """
select category, transaction_type, count(amount) as txn_count, round(sum(amount), 2) as total_volume,
  round(avg(amount), 2) as avg_txn_amount
from transactions group by 1, 2 order by sum(amount) desc, 1, 2 limit 20""")
sql("q7_clv_distribution", ["clv_estimates"], """
select clv_segment, count(*) as customer_count, round(avg(estimated_clv), 2) as avg_clv,
  round(sum(estimated_clv), 2) as total_clv,
  round(sum(estimated_clv) / sum(sum(estimated_clv)) over () * 100, 2) as pct_of_total_clv,
  round(avg(default_probability) * 100, 2) as avg_default_prob_pct
from clv_estimates group by 1""")
sql("q7_clv_distribution_dash", ["book"], """
select clv_segment, count(estimated_clv) as customer_count, round(avg(estimated_clv), 2) as avg_clv,
  round(sum(estimated_clv), 2) as total_clv,
  round(sum(estimated_clv) / sum(sum(estimated_clv)) over () * 100, 2) as pct_of_total
from book where clv_segment is not null group by 1""")
sql("q8_rolling_defaults", ["repayment_history"], """
select month, n as defaulting_customers,
  round(avg(n) over (order by month rows between 2 preceding and current row), 1) as rolling_3m_avg
from (select cast(date_trunc('month', due_date) as date) as month, count(distinct customer_id) as n
  from repayment_history where payment_status = 'Missed' group by 1)""")
sql("q9_tenure_cohorts", ["customers", "repayment_history"], """
select case when tenure_months < 12 then '0–12 months' when tenure_months < 36 then '1–3 years'
    when tenure_months < 60 then '3–5 years' else '5+ years' end as tenure_band,
  count(distinct customer_id) as customers,
  round(avg((payment_status = 'On-Time')::int) * 100, 2) as on_time_rate_pct,
  round(avg(credit_score), 0) as avg_credit_score
from customers join repayment_history using (customer_id) group by 1""")
sql("q9_tenure_cohorts_dash", ["customers", "repayment_history"], """
select band as tenure_band, count(distinct customer_id) as customers,
  round(avg((payment_status = 'On-Time')::int) * 100, 2) as on_time_rate_pct,
  round(avg(credit_score), 4) as avg_credit_score
from (values ('0-12m', 0, 12), ('1-3yr', 12, 36), ('3-5yr', 36, 60), ('5+yr', 60, 999)) d(band, lo, hi)
left join (select * from customers join repayment_history using (customer_id))
  on tenure_months > lo and tenure_months <= hi group by 1""")
sql("q10_cross_sell_targets", ["customers", "clv_estimates", "risk_scored"], """
select c.customer_id, city, employment_type, c.credit_score, estimated_clv, clv_segment,
  r.default_probability, risk_tier
from customers c join clv_estimates v on v.customer_id = c.customer_id
join risk_scored r on r.customer_id = c.customer_id
where risk_tier = 'Low Risk' and clv_segment in ('Gold', 'Platinum')
order by estimated_clv desc, c.customer_id limit 20""")
sql("q10_cross_sell_targets_dash", ["book"], """
select customer_id, city, employment_type, credit_score, estimated_clv, clv_segment, default_probability
from book where risk_tier = 'Low Risk' and clv_segment in ('Gold', 'Platinum')
order by estimated_clv desc, customer_id limit 20""")
sql("q11_income_bands", ["customers"], f"""
select case when income < 200000 then 'Low Income (< ₹2L)' when income < 500000 then 'Lower Middle (₹2L–5L)'
    when income < 1000000 then 'Middle (₹5L–10L)' when income < 2000000 then 'Upper Middle (₹10L–20L)'
    else 'High Income (> ₹20L)' end as income_band,
  count(*) as total_customers, cast(sum(defaulted) as bigint) as total_defaults, {RATE},
  round(avg(credit_score), 0) as avg_credit_score, round(avg(loan_amount), 2) as avg_loan_amount,
  round({NPA}, 2) as npa_exposure, round({NPA} / nullif(sum(loan_amount), 0) * 100, 2) as npa_rate_pct
from customers where has_loan = 1 group by 1""")
sql("q11_income_bands_dash", ["customers"], f"""
select band as income_band, count(customer_id) as total_customers,
  cast(coalesce(sum(defaulted), 0) as bigint) as total_defaults, {RATE},
  round(avg(credit_score), 4) as avg_credit_score, round({NPA}, 2) as npa_exposure
from (values ('<2L', 0, 200000), ('2-5L', 200000, 500000), ('5-10L', 500000, 1000000),
  ('10-20L', 1000000, 2000000), ('>20L', 2000000, 999999999)) d(band, lo, hi)
left join (select * from customers where has_loan = 1) on income > lo and income <= hi group by 1""")
sql("q12_churner_clv_by_city", ["customers", "risk_scored", "clv_estimates", "customer_segments"], """
select city, count(*) as churner_count, round(avg(r.default_probability) * 100, 2) as avg_default_prob_pct,
  round(avg(estimated_clv), 2) as avg_clv, round(sum(estimated_clv), 2) as total_clv_at_risk,
  round(avg(c.credit_score), 0) as avg_credit_score, round(avg(c.income), 2) as avg_income,
  round(avg(tenure_months), 1) as avg_tenure_months
from customers c join risk_scored r on r.customer_id = c.customer_id
join clv_estimates v on v.customer_id = c.customer_id
join customer_segments s on s.customer_id = c.customer_id where segment = 3 group by city""")
sql("q12_churner_clv_by_city_dash", ["book_seg"], """
select city, count(customer_id) as churner_count,
  round(avg(default_probability) * 100, 2) as avg_default_prob_pct, round(avg(estimated_clv), 2) as avg_clv,
  round(sum(estimated_clv), 2) as total_clv_at_risk, round(avg(credit_score), 2) as avg_credit_score
from book_seg where segment = 3 group by city""")

sql("repayment_features", ["repayment_block"], """
select customer_id, round(repayment_consistency_score, 8) as repayment_consistency_score, total_missed_payments,
  round(avg_payment_coverage, 8) as avg_payment_coverage, round(late_payment_rate, 8) as late_payment_rate,
  round(payment_delay_frequency, 8) as payment_delay_frequency, max_consecutive_missed from repayment_block""")
sql("missed_streak", ["streaks"], "select * from streaks")
SPEND = """select customer_id, round(spending_volatility, 4) as spending_volatility,
  round(avg_monthly_spend, 6) as avg_monthly_spend, round(total_debit_6m, 2) as total_debit_6m,
  round(total_credit_6m, 2) as total_credit_6m, transaction_count_6m, high_spend_month_flag,
  round(net_cash_flow_6m, 2) as net_cash_flow_6m, round(transaction_frequency, 6) as transaction_frequency,
  debit_to_credit_ratio from """
sql("transaction_features", ["spend_block"], SPEND + "spend_block")
sql("transaction_features_all_customers", ["spend_all"], SPEND + "spend_all")
sql("monthly_activity", ["window_months"], """
select customer_id, month, round(debit, 2) as debit, round(credit, 2) as credit, n from window_months""")
sql("ratio_features", ["ratios"], "select * from ratios")
DIGITS = {"spending_volatility": 4, "avg_monthly_spend": 6, "total_debit_6m": 2, "total_credit_6m": 2,
          "net_cash_flow_6m": 2}
WHOLE = ["total_missed_payments", "max_consecutive_missed", "transaction_count_6m", "high_spend_month_flag"]
NUMBERS = ", ".join(c if c in WHOLE else f"round({c}, {DIGITS.get(c, 6)}) as {c}"
                    for c in RATIO_FEATURES + REPAYMENT_FEATURES + TRANSACTION_FEATURES)
sql("feature_matrix", ["features"], f"""
select customer_id, age, round(income, 6) as income, tenure_months, credit_score, has_loan,
  round(loan_amount, 6) as loan_amount, loan_tenure_months, round(interest_rate_pct, 6) as interest_rate_pct,
  has_credit_card, round(credit_limit, 6) as credit_limit, round(cc_balance, 6) as cc_balance, defaulted,
  {NUMBERS}, {DUMMY_SQL} from features""")
sql("onehot", ["people"], f"select customer_id, {DUMMY_SQL} from people")
sql("portfolio_shape", ["customers"], f"""
select count(*) as rows, {11 + len(RATIO_FEATURES + REPAYMENT_FEATURES + TRANSACTION_FEATURES) + len(DUMMIES)}::bigint
  as features, round(avg(defaulted), 6) as default_rate from customers""")
sql("loan_customer_repayments", ["repayment_history"], """
select customer_id, due_date, round(emi_amount, 4) as emi_amount, payment_status, o_orderkey,
  round(paid_amount, 4) as paid_amount from repayment_history""")

sql("risk_score", ["scored"], """
select customer_id, round(raw_score, 9) as raw_score, round(risk_score, 9) as risk_score from scored""")
sql("risk_label", ["customers"], "select customer_id, defaulted from customers")
sql("risk_tiers", ["risk_scored"], "select * from risk_scored")
sql("class_weights", ["customers"], """
select defaulted, count(*) as support,
  round(sum(count(*)) over () / (count(*) over () * count(*)), 8) as class_weight from customers group by 1""")

SCENARIO_SQL = {
    "unchanged": {}, "income_down_20": {"income": "income * 0.8::double"},
    "loan_up_50": {"loan_amount": "loan_amount * 1.5::double"},
    "score_down_100": {"credit_score": "greatest(credit_score - 100, 300)"},
    "card_maxed": {"util": "1::double"},
}
CASES = " union all ".join(
    f"""select c.customer_id, '{name}' as scenario, {change.get('income', 'income')} as income,
    {change.get('loan_amount', 'loan_amount')} as loan_amount, {change.get('credit_score', 'credit_score')} as credit_score,
    {change.get('util', 'credit_utilisation_ratio')} as util, credit_limit, employment_type, loan_tenure_months,
    interest_rate_pct, tenure_months from customers c join ratios q using (customer_id)"""
    for name, change in SCENARIO_SQL.items())
sql("what_if", ["customers", "ratios", "clv_values", "score_range"], f"""
select customer_id, scenario, round(p, 6) as simulated_probability,
  round(p - default_probability, 6) as probability_change,
  case when p >= 0.6::double then 'High Risk' when p >= 0.3::double then 'Medium Risk' else 'Low Risk' end as risk_tier,
  round(revenue, 2) as annual_revenue_est, round(value, 2) as simulated_clv,
  round(value - estimated_clv, 2) as clv_change,
  case when p >= 0.6::double then 'DECLINE' when p >= 0.3::double then 'CONDITIONAL APPROVAL' else 'APPROVE' end
    as recommendation
from (
  select *, revenue * greatest(tenure_months / 12, 0.5::double) * (1 - p) as value from (
    select x.*, least(greatest((raw - low) / (high - low + 1e-9::double), 0), 1) as p,
      loan_amount * (interest_rate_pct / 100) + credit_limit * 0.02::double + income * 0.003::double as revenue
    from (
      select *, {RAW_SCORE} as raw from (
        select *, util * credit_limit as cc_balance, (loan_amount > 0)::int as has_loan from ({CASES}))) x, score_range))
join (select customer_id, estimated_clv, default_probability from clv_values) using (customer_id)""")


def hashed(key: str, seed: int) -> str:
    return f"cast('0x' || substr(md5({key} || ':{seed}'), 1, 15) as bigint)"


sql("stratified_split", ["customers"], f"""
select customer_id, defaulted, case when row_number() over (partition by defaulted order by h)
    <= floor(0.20::double * count(*) over (partition by defaulted) + 0.5::double) then 'test' else 'train' end as split
from (select *, {hashed('customer_id', 42)} as h from customers)""")
sql("stratified_folds", ["customers"], f"""
select customer_id, defaulted, {" + ".join(
    f"(rn > floor({i}::double / 5 * n + 0.5::double))::int" for i in range(1, 5))} as fold
from (select *, row_number() over (partition by defaulted order by h) as rn,
    count(*) over (partition by defaulted) as n
  from (select *, {hashed('customer_id', 43)} as h from customers))""")

SPLIT = SQL["stratified_split"][1]
sql("shapley_gap", ["customers"], f"""
select count(*) as rows, 0.0::double as largest from ({SPLIT}) where split = 'test'""")
sql("tree_shap_gap", ["customers"], f"""
select model, count(*) as rows, 0.0::double as largest from ({SPLIT})
cross join (values ('Random Forest'), ('Gradient Boosting')) as m(model) where split = 'test' group by model""")


def rule_tree_sql() -> str:
    """Shapley values of the rule trees by all subsets of known inputs."""
    size = len(RULE_INPUTS)

    def cover(nodes: dict, wanted: int) -> str:
        def condition(at: int, here: list[str]) -> list[str] | None:
            if at == wanted:
                return here
            left, right, feature, threshold, _ = nodes[at]
            if left < 0:
                return None
            name = RULE_INPUTS[feature]
            return condition(left, [*here, f"{name} <= {threshold}"]) or condition(right, [*here, f"{name} > {threshold}"])
        return f"(select count(*)::double from customers where {' and '.join(condition(0, []))})"

    covers = {(t, at): f"n{t}_{at}" for t, nodes in enumerate(RULE_TREES) for at in nodes if at}
    counts = ", ".join(f"{cover(RULE_TREES[t], at)} as {name}" for (t, at), name in covers.items())

    def value(t: int, at: int, known: frozenset) -> str:
        left, right, feature, threshold, leaf = RULE_TREES[t][at]
        if left < 0:
            return f"{leaf}::double"
        one, two = value(t, left, known), value(t, right, known)
        if feature in known:
            return f"(case when {RULE_INPUTS[feature]} <= {threshold} then {one} else {two} end)"
        a, b = covers[t, left], covers[t, right]
        return f"coalesce(({a} * {one} + {b} * {two}) / nullif({a} + {b}, 0), 0)"

    subsets = [frozenset(i for i in range(size) if mask >> i & 1) for mask in range(2 ** size)]
    values = ", ".join(" + ".join(value(t, 0, s) for t in range(len(RULE_TREES))) + f" as v{mask}" for mask, s in enumerate(subsets))
    parts = []
    for i, name in enumerate(RULE_INPUTS):
        terms = [f"(v{mask | 1 << i} - v{mask}) * {math.factorial(len(s)) * math.factorial(size - len(s) - 1)}::double / {math.factorial(size)}"
                 for mask, s in enumerate(subsets) if i not in s]
        parts.append(f"round({' + '.join(terms)}, 9) as phi_{name}")
    return f"""
select customer_id, {', '.join(parts)}, round(v{2 ** size - 1}, 9) as explained
from (select customer_id, {values} from customers, (select {counts}))"""


sql("rule_tree_shap", ["customers"], rule_tree_sql())
sql("trend_optimality_by_category", ["series_cat"], f"""
select category, 2 + least({CHANGES}, floor(count(*) * {CHANGE_RANGE}::double)::bigint - 1) + {2 * HARMONICS} as coefficients, 0::bigint as violations
from series_cat group by category""")
FOLD = " + ".join(f"(rn > floor({i}::double / 5 * n + 0.5::double))::int" for i in range(1, 5))
sql("trained_rows", ["customers"], f"""
select model, split, fold, count(*) as rows, cast(sum(defaulted) as bigint) as defaults, 0::bigint as faults
from (
  select customer_id, defaulted, 'train' as split, {FOLD} as fold
  from (select *, row_number() over (partition by defaulted order by h) as rn, count(*) over (partition by defaulted) as n
        from (select *, {hashed('customer_id', 43)} as h from ({SPLIT}) where split = 'train'))
  union all select customer_id, defaulted, split, -1 from ({SPLIT}) where split = 'test')
cross join (values ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting')) as m(model) group by all""")
sql("saved_model_gap", ["customers"], "select count(*) as rows, 0::bigint as changed from customers")
sql("model_tier_rows", ["customers"], """
select count(*) as rows, count(distinct customer_id) as customers, 0::bigint as wrong from customers""")
sql("kmeans_fixed_point", ["customers"], "select count(*) as rows, 0::bigint as astray from customers")
sql("pca_axes", ["customers"], "select count(*) as rows, 0.0::double as correlation, 0.0::double as off from customers")

sql("decisions", ["decided"], "select customer_id, predicted from decided")
sql("roc_auc", ["sweep"], """
select round(sum(pos * (all_neg - fp + 0.5::double * neg)) / (max(all_pos)::double * max(all_neg)), 9) as roc_auc
from sweep""")
sql("average_precision", ["sweep"], """
select round(sum(pos * (tp::double / (tp + fp))) / max(all_pos), 9) as average_precision from sweep""")
sql("roc_curve", ["sweep"], """
select round(threshold, 9) as threshold, round(fp::double / all_neg, 9) as fpr, round(tp::double / all_pos, 9) as tpr
from sweep union all select null, 0::double, 0::double""")
sql("pr_curve", ["sweep"], """
select round(threshold, 9) as threshold, round(tp::double / (tp + fp), 9) as precision,
  round(tp::double / all_pos, 9) as recall from sweep union all select null, 1::double, 0::double""")
sql("confusion", ["decided"], """
select actual, predicted, count(d.customer_id) as n from (select a.k as actual, p.k as pk
  from (values (0), (1)) a(k), (values (0), (1)) p(k)) g(actual, predicted)
left join (select customer_id, defaulted as y, predicted as yhat from decided) d on y = actual and yhat = predicted
group by 1, 2""")
sql("class_report", ["decided"], """
select class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1_score, support
from (
  with cells as (select count(*) filter (where defaulted = 1 and predicted = 1)::double as tp,
      count(*) filter (where defaulted = 0 and predicted = 1)::double as fp,
      count(*) filter (where defaulted = 1 and predicted = 0)::double as fn,
      count(*) filter (where defaulted = 0 and predicted = 0)::double as tn from decided),
  sides as (
    select 'No Default' as class, tn as hit, fn as other_in, fp as missed from cells
    union all select 'Default', tp, fp, fn from cells),
  rates as (select class, coalesce(hit / nullif(hit + other_in, 0), 0) as precision,
      coalesce(hit / nullif(hit + missed, 0), 0) as recall, (hit + missed)::bigint as support from sides),
  full_rates as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall)
      else 0 end as f1 from rates)
  select class, precision, recall, f1, support from full_rates
  union all select 'accuracy', (tp + tn) / (tp + fp + fn + tn), (tp + tn) / (tp + fp + fn + tn),
    (tp + tn) / (tp + fp + fn + tn), (tp + fp + fn + tn)::bigint from cells
  union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint from full_rates
  union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::bigint from full_rates)""")
sql("linear_shap", ["zscores"], "select * from (" + " union all ".join(
    f"select '{c}' as feature, round(avg(abs({w}::double * (z_{c} - 0::double))), 6) as mean_abs_shap from zscores"
    for c, w in SHAP_WEIGHTS.items()) + ") order by 2 desc, 1 limit 20")

sql("clv_estimates", ["clv_values"], """
select customer_id, round(estimated_clv, 2) as estimated_clv, round(annual_revenue_est, 2) as annual_revenue_est,
  round(default_probability, 4) as default_probability from clv_values""")
sql("clv_tiers", ["clv_estimates"], "select customer_id, clv_segment from clv_estimates")
BOOK_OUT = """customer_id, age, round(income, 4) as income, employment_type, city, account_type, tenure_months,
  credit_score, has_loan, round(loan_amount, 4) as loan_amount, loan_tenure_months,
  round(interest_rate_pct, 4) as interest_rate_pct, has_credit_card, round(credit_limit, 4) as credit_limit,
  round(cc_balance, 4) as cc_balance, defaulted, round(default_probability, 4) as default_probability, risk_tier,
  round(estimated_clv, 4) as estimated_clv, clv_segment"""
sql("customer_360", ["book_seg"], f"select {BOOK_OUT}, segment from book_seg")
KPIS = """count(*) as total_customers, count(*) filter (where risk_tier = 'High Risk') as high_risk_customers,
  avg(defaulted) as default_rate, avg(estimated_clv) as avg_clv, sum(loan_amount) as total_loan_exposure,
  cast(round_even(avg(credit_score), 0) as bigint) as avg_credit_score_rounded,
  cast(floor(avg(credit_score)) as bigint) as avg_credit_score_truncated,
  count(*) filter (where clv_segment = 'Platinum') as platinum_customers"""
sql("kpis", ["book"], f"""
select * replace (round(default_rate, 6) as default_rate, round(avg_clv, 2) as avg_clv,
  round(total_loan_exposure, 2) as total_loan_exposure) from (select {KPIS} from book)""")
sql("kpi_cards", ["book"], f"""
select format('{{:,d}}', total_customers) as total_customers, format('{{:,d}}', high_risk_customers) as high_risk_customers,
  format('{{:.1f}}%', default_rate * 100) as default_rate, '₹' || format('{{:,.0f}}', avg_clv) as avg_clv,
  '₹' || format('{{:,.0f}}', total_loan_exposure) as total_loan_exposure,
  cast(avg_credit_score_rounded as varchar) as avg_credit_score,
  format('{{:,d}}', platinum_customers) as platinum_customers from (select {KPIS} from book)""")


def histogram_sql(source: str, value: str, bins: int, digits: int) -> str:
    return f"""
select b::int as bin, round(lo + (hi - lo) / {bins} * (b + 0.5::double), {digits}) as midpoint, count(x) as n
from (select unnest(range({bins})) as b), (select min({value}) as lo, max({value}) as hi from {source}) e
left join (select {value} as x, least(floor(({value} - l2) / (h2 - l2) * {bins}), {bins - 1}) as place
  from {source}, (select min({value}) as l2, max({value}) as h2 from {source})) v on place = b group by b, lo, hi"""


sql("pd_histogram", ["risk_scored"], histogram_sql("risk_scored", "default_probability", 20, 6))
sql("pd_histogram_25", ["risk_scored"], histogram_sql("risk_scored", "default_probability", 25, 6))
relation("clv_capped", ["clv_values"], """
select least(estimated_clv, (select quantile_cont(estimated_clv, 0.99) from clv_values)) as estimated_clv from clv_values""")
sql("clv_histogram_p99", ["clv_capped"], histogram_sql("clv_capped", "estimated_clv", 40, 4))
sql("tier_counts", ["risk_scored"], """
select risk_tier, count(*) as n from risk_scored where risk_tier is not null group by 1""")
SEGMENT_CASE = "case segment when 0 then 'Premium' when 1 then 'Vulnerable' when 2 then 'Growth' when 3 then 'Churner' end"
sql("segment_counts", ["customer_segments"], f"select {SEGMENT_CASE} as segment, count(*) as n from customer_segments group by 1")
sql("clv_tier_counts", ["clv_estimates"], "select clv_segment, count(*) as n from clv_estimates group by 1")
sql("clv_by_tier", ["clv_estimates"], "select clv_segment, round(avg(estimated_clv), 2) as avg_clv from clv_estimates group by 1")
sql("clv_tier_summary", ["clv_estimates"], f"""
select clv_segment, count(*) as customers, round(avg(estimated_clv), 2) as avg_clv,
  round(sum(estimated_clv), 2) as total_clv,
  {even('sum(estimated_clv) / (select sum(estimated_clv) from clv_estimates) * 100', 1)} as pct_revenue
from clv_estimates group by 1""")
NPA_RATE = f"{NPA} / greatest(sum(loan_amount), 1) * 100"
sql("city_npa_rate", ["customers"], f"""
select city, {even('r', 2)} as npa_rate from (
  select city, {NPA_RATE} as r from customers where has_loan = 1 group by city)
order by 2 desc, 1 limit 7""")
sql("city_npa_exposure", ["customers"], f"""
select city, round(x, 2) as npa_exposure, {even('r', 1)} as npa_rate from (
  select city, {NPA} as x, {NPA_RATE} as r from customers where has_loan = 1 group by city)""")
sql("score_box_stats", ["people"], """
select employment_type, count(*) as n, min(credit_score) as min, quantile_cont(credit_score::double, 0.25) as q1,
  quantile_cont(credit_score::double, 0.5) as median, quantile_cont(credit_score::double, 0.75) as q3,
  max(credit_score) as max from people group by 1""")
sql("employment_types", ["people"], "select distinct employment_type from people")
sql("risk_clv_quadrants", ["clv_values"], """
select case when default_probability < 0.40::double then case when estimated_clv >= m then 'Stars' else 'Safe' end
    else case when estimated_clv >= m then 'Watch' else 'Default' end end as quadrant,
  count(*) as n, round(sum(estimated_clv), 2) as total_clv, round(avg(default_probability), 6) as avg_pd
from clv_values, (select quantile_cont(estimated_clv, 0.5) as m from clv_values) group by 1""")
sql("filtered_customers", ["book_seg"], """
select customer_id, city, risk_tier, segment, round(estimated_clv, 2) as estimated_clv from book_seg
where city = 'NATION_7' and risk_tier = 'Medium Risk' and segment = 2""")
sql("high_risk_table", ["book"], """
select customer_id, city, credit_score, round(income, 4) as income, round(loan_amount, 4) as loan_amount,
  default_probability, risk_tier from book where risk_tier = 'High Risk'
order by default_probability desc, customer_id limit 20""")
sql("high_risk_top15", ["book"], """
select customer_id, city, employment_type, credit_score, round(loan_amount, 4) as loan_amount,
  default_probability, risk_tier from book where risk_tier = 'High Risk'
order by default_probability desc, customer_id limit 15""")
sql("drill_down", ["book_seg"], f"""
select customer_id, city, employment_type, credit_score, round(income, 2) as income,
  round(loan_amount, 2) as loan_amount, format('{{:.1f}}%', default_probability * 100) as default_probability, risk_tier,
  '₹' || format('{{:,.0f}}', estimated_clv) as estimated_clv, clv_segment, {SEGMENT_CASE} as segment
from book_seg order by customer_id limit 200""")
sql("customer_preview", ["people"], """
select customer_id, city, credit_score from people order by customer_id limit 100""")
sql("customer_sample", ["people"], f"""
select customer_id, credit_score from people order by {hashed('customer_id', 42)}, customer_id limit 1200""")
sql("sample_per_segment", ["customer_segments"], f"""
select customer_id, segment from customer_segments
qualify row_number() over (partition by segment order by {hashed('customer_id', 42)}, customer_id) <= 500""")

sql("zscore", ["zscores"], "select customer_id, " + ", ".join(
    f"round(z_{c}, 6) as z_{c}" for c in CLUSTER_FEATURES) + " from zscores")
sql("assign_centroid", ["customer_segments"], "select * from customer_segments")
sql("segment_profile", ["segmented"], "select segment, " + ", ".join(
    f"round(avg({c}), 3) as {c}_mean, round(quantile_cont({c}::double, 0.5), 3) as {c}_median, count({c}) as {c}_count"
    for c in [*CLUSTER_FEATURES, "defaulted"]) + " from segmented group by segment")
sql("segment_headline", ["segmented"], """
select segment, count(*) as n, round(avg(credit_score), 4) as avg_credit_score, round(avg(income), 4) as avg_income,
  round(avg(defaulted), 4) as default_rate, round(avg(estimated_clv), 4) as avg_clv,
  round(avg(default_probability), 4) as avg_default_prob from segmented group by segment""")


def radar_sql(columns: list[str]) -> str:
    scaled = ", ".join(f"round(({c} - min({c}) over ()) / (max({c}) over () - min({c}) over () + 1e-9::double), 6) as {c}"
                       for c in columns)
    means = ", ".join(f"avg({c}) as {c}" for c in columns)
    return f"select segment, {scaled} from (select segment, {means} from segmented group by segment)"


sql("segment_radar", ["segmented"], radar_sql(RADAR_REPORT))
sql("segment_radar_dash", ["segmented"], radar_sql(RADAR_DASH))

sql("monthly_revenue", ["series"], "select month, round(revenue, 2) as revenue from series")
sql("monthly_revenue_by_category", ["series_cat"], "select category, month, round(revenue, 2) as revenue from series_cat")
sql("dickey_fuller", *dickey_fuller_sql("series", ""))
sql("dickey_fuller_by_category", *dickey_fuller_sql("series_cat", "category,"))
sql("forecast_calendar", ["series_cat"], """
select category, step::int as step, cast(last + to_months(cast(step as int)) as date) as month
from (select category, last, unnest(range(1, 13)) as step
  from (select category, max(month) as last from series_cat group by 1))""")
sql("csv_scan", ["customers"], """
select customer_id, age, round(income, 4) as income, employment_type, city, account_type, tenure_months, credit_score,
  has_loan, round(loan_amount, 4) as loan_amount, loan_tenure_months, round(interest_rate_pct, 4) as interest_rate_pct,
  has_credit_card, round(credit_limit, 4) as credit_limit, round(cc_balance, 4) as cc_balance, defaulted
from customers""")
sql("csv_scan_with_dates", ["series"], "select month, round(revenue, 2) as revenue from series")
sql("json_scan", ["clv_estimates"], """
select customer_id, round(estimated_clv, 2) as estimated_clv, clv_segment,
  round(annual_revenue_est, 2) as annual_revenue_est, round(default_probability, 2) as default_probability
from clv_estimates""")
sql("uploaded_csv", ["risk_scored"], """
select risk_tier, count(*) as n, round(avg(credit_score), 4) as avg_credit_score from risk_scored group by 1""")

ORPHANS = """(select count(*) from {t} x where not exists (select 1 from people p where p.customer_id = x.customer_id))"""
AUDITED = {"customers": "people", "repayment_history": "repayment_history", "transactions": "transactions",
           "risk_scored": "risk_scored", "clv_estimates": "clv_values", "customer_segments": "customer_segments"}
sql("integrity_audit", list(AUDITED.values()), """
select "table", rows, orphans, case when rows > 0 and orphans = 0 then 'OK' else 'CHECK' end as status from (""" +
    " union all ".join(f"""select '{name}' as "table", (select count(*) from {t}) as rows, {ORPHANS.format(t=t)} as orphans"""
                       for name, t in AUDITED.items()) + ")")


SQL["repayment_features_grown"] = SQL["repayment_features"]


def oracle_sql() -> dict[str, str]:
    texts = {name: compose(needs, body) for name, (needs, body) in SQL.items()}
    texts["seasonal_forecast"] = seasonal_sql("series", "", BOUNDS)
    texts["seasonal_forecast_by_category"] = seasonal_sql("series_cat", "category,", BOUNDS)
    texts["augmented_dickey_fuller"] = augmented_dickey_fuller_sql("series", "")
    texts["augmented_dickey_fuller_by_category"] = augmented_dickey_fuller_sql("series_cat", "category,")
    texts["forecast_rows_ahead"] = seasonal_sql("series_cat", "category,", BOUNDS + ", 'forecast' as type")
    texts["forecast_union"] = seasonal_sql(
        "series", "", BOUNDS + ", 'forecast' as type",
        "union all select month, round(revenue, 2), null, null, 'historical' from series")
    return texts
