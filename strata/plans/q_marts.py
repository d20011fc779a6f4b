"""Queries: star schema and marts."""

from __future__ import annotations

from strata.plans import marts
from strata.plans.registry import query
from strata.plans.sql import (BASE, COVERAGE_ROLLUP, CUSTOMERS, DIM_CUSTOMER, DIM_POLICY, FACT_PREMIUM, NATIONS,
                              PAYMENTS, POLICIES, STAR, date_key, ratio, with_, xsum)
from strata.plans.star import Star

LOSS_RATIO_SQL = with_(*STAR, f"""
losses AS (
  SELECT month_key, product_line, state, count(*) AS claim_count, {xsum('loss_amount')} AS incurred_losses
  FROM fc GROUP BY month_key, product_line, state),
earned AS (
  SELECT month_key, product_line, state, {xsum('annual_premium')} / 12.0 AS earned_premium
  FROM fp GROUP BY month_key, product_line, state)""") + f"""
SELECT month_key, product_line, state,
       coalesce(claim_count, 0) AS claim_count,
       coalesce(incurred_losses, 0.0) AS incurred_losses,
       coalesce(earned_premium, 0.0) AS earned_premium,
       {ratio('coalesce(incurred_losses, 0.0)', 'earned_premium')} AS loss_ratio
FROM earned FULL OUTER JOIN losses USING (month_key, product_line, state)
"""


@query("loss_ratio_monthly", LOSS_RATIO_SQL)
def loss_ratio_monthly(t):
    """Flagship (L8): month x product line x state loss ratio."""
    s = Star(t)
    return marts.agg_loss_ratio(s.fact_claims_core, s.fact_premium)


LOSS_RATIO_EARNED_SQL = LOSS_RATIO_SQL.replace("FULL OUTER JOIN", "LEFT JOIN")


@query("loss_ratio_earned_only", LOSS_RATIO_EARNED_SQL)
def loss_ratio_earned_only(t):
    """L8 with the documented left join from earned premium."""
    s = Star(t)
    return marts.agg_loss_ratio(s.fact_claims_core, s.fact_premium, include_unearned=False)


DIM_DATE_SQL = f"""
WITH b AS (
  SELECT CAST(date_trunc('year', min(CAST(o_orderdate AS DATE))) AS DATE) AS s,
         CAST(date_trunc('year', max(CAST(o_orderdate AS DATE))) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS e
  FROM orders),
cal AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT {date_key('date')} AS date_key, date,
       CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(year(date) AS VARCHAR) || '-Q' || CAST(quarter(date) AS VARCHAR) AS year_quarter,
       CAST(month(date) AS INTEGER) AS month, strftime(date, '%B') AS month_name,
       strftime(date, '%Y-%m') AS year_month, CAST(day(date) AS INTEGER) AS day_of_month,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, strftime(date, '%A') AS day_name,
       CAST(weekofyear(date) AS INTEGER) AS week_of_year, dayofweek(date) IN (0, 6) AS is_weekend,
       CAST(date_trunc('month', date) AS DATE) AS first_of_month, last_day(date) AS last_of_month
FROM cal
"""


@query("dim_date", DIM_DATE_SQL)
def dim_date(t):
    """Calendar over whole years spanning the order dates."""
    return marts.dim_date_for(t.orders, "o_orderdate")


FACT_PREMIUM_SQL = with_(*BASE, FACT_PREMIUM.lstrip().rstrip()) + "SELECT * FROM fp"


@query("fact_premium", FACT_PREMIUM_SQL)
def fact_premium(t):
    """Policy x in-force month."""
    return Star(t).fact_premium


FACT_CLAIMS_SQL = with_(*STAR) + "SELECT * FROM fc"


@query("fact_claims", FACT_CLAIMS_SQL)
def fact_claims(t):
    """One row per claim, star-joined."""
    return Star(t).fact_claims


FACT_PAYMENTS_SQL = with_(PAYMENTS) + "SELECT * FROM fpay"


@query("fact_payments", FACT_PAYMENTS_SQL)
def fact_payments(t):
    """One row per installment."""
    return Star(t).fact_payments


DIM_POLICY_SQL = with_(POLICIES, NATIONS, CUSTOMERS, COVERAGE_ROLLUP, DIM_POLICY) + "SELECT * FROM dim_pol"


@query("dim_policy", DIM_POLICY_SQL)
def dim_policy(t):
    """Policy + state + coverage rollup."""
    return Star(t).dim_policy


DIM_CUSTOMER_SQL = with_(*BASE, DIM_CUSTOMER) + "SELECT * FROM dc"


@query("dim_customer", DIM_CUSTOMER_SQL)
def dim_customer(t):
    """Customer, first policy, tenure and band."""
    return Star(t).dim_customer


CLAIMS_MONTHLY_SQL = with_(*STAR, f"""
c AS (
  SELECT month_key, peril_code, count(*) AS claim_count,
         {ratio(xsum('loss_amount'), 'count(*)')} AS severity,
         count(DISTINCT policy_id) AS distinct_policies,
         {ratio("count(*) FILTER (WHERE fraud_flag)", 'count(*)')} AS fraud_rate
  FROM fc GROUP BY month_key, peril_code),
a AS (SELECT month_key, count(DISTINCT policy_id) AS active_policies FROM fp GROUP BY month_key)""") + f"""
SELECT c.*, a.active_policies, {ratio('c.claim_count', 'a.active_policies')} AS frequency
FROM c LEFT JOIN a USING (month_key)
"""


@query("claims_monthly", CLAIMS_MONTHLY_SQL)
def claims_monthly(t):
    """Month x peril frequency, severity, fraud rate."""
    s = Star(t)
    return marts.agg_claims_monthly(s.fact_claims, s.fact_premium)


FRAUD_MONTHLY_SQL = with_(*STAR) + f"""
SELECT month_key, count(*) AS claims, count(*) FILTER (WHERE fraud_flag) AS fraud_claims,
       {ratio("count(*) FILTER (WHERE fraud_flag)", 'count(*)')} AS fraud_rate,
       {xsum('CASE WHEN fraud_flag THEN loss_amount ELSE 0.0 END')} AS flagged_amount
FROM fc GROUP BY month_key
"""


@query("fraud_monthly", FRAUD_MONTHLY_SQL)
def fraud_monthly(t):
    """Monthly fraud rate and flagged amount."""
    return marts.fraud_monthly(Star(t).fact_claims_core)


BILLING_SQL = with_(PAYMENTS) + f"""
SELECT month_key, {xsum('amount_due')} AS written,
       {xsum('coalesce(amount_paid, 0.0)')} AS collected,
       {xsum('CASE WHEN is_overdue THEN amount_due ELSE 0.0 END')} AS overdue_exposure,
       count(*) FILTER (WHERE is_overdue) AS overdue_installments, count(*) AS installments
FROM fpay GROUP BY month_key
"""


@query("billing_leakage", BILLING_SQL)
def billing_leakage(t):
    """Written vs collected vs overdue exposure per month."""
    return marts.billing_leakage(Star(t).fact_payments)


CUSTOMER_VALUE_SQL = with_(*STAR, DIM_CUSTOMER, f"""
pa AS (
  SELECT customer_id, count(*) AS policy_count, count(*) FILTER (WHERE status = 'ACTIVE') AS active_policies,
         {xsum('annual_premium')} AS lifetime_premium
  FROM pol GROUP BY customer_id),
ca AS (SELECT customer_id, count(*) AS claim_count FROM fc GROUP BY customer_id)""") + """
SELECT customer_id, segment, tenure_years, tenure_band,
       coalesce(active_policies, 0) AS active_policies,
       coalesce(lifetime_premium, 0.0) AS lifetime_premium,
       coalesce(claim_count, 0) AS claim_count,
       coalesce(active_policies, 0) = 0 AS churn_flag,
       policy_count IS NULL AS never_had_policy
FROM dc LEFT JOIN pa USING (customer_id) LEFT JOIN ca USING (customer_id)
"""


@query("customer_value", CUSTOMER_VALUE_SQL)
def customer_value(t):
    """Customer 360 with churn and never-had-policy flags."""
    s = Star(t)
    return marts.agg_customer_value(s.dim_customer, s.policies, s.fact_claims_core)
