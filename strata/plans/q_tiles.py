"""Queries: agent performance (L10) and the dashboard datasets.

Each tile is a thin select / filter / aggregate over one mart; ratios are
re-computed from re-aggregated numerators and denominators, never averaged.
Money re-aggregated from a mart is rounded to cents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.numbers import safe_ratio
from strata.operators import aggregates as A
from strata.operators import quality as K
from strata.operators.ranking import quantile_bucket, top_n
from strata.plans import marts
from strata.plans.q_quality import SCORE_SQL, DIRTY_SQL, RULES_SQL, _scorecard, dirty_orders, rules
from strata.plans.registry import query
from strata.plans.sql import AGENTS, DIM_CUSTOMER, STAR, PAYMENTS, ratio, with_, xsum
from strata.plans.star import Star


def money(c, scale: int = 6):
    """Exact re-aggregation of a mart measure. The micro-unit fraction of
    earned premium (cents / 12) is 0, 1/3 or 2/3, never a rounding tie."""
    from strata.functions.numbers import exact_sum

    return exact_sum(c, scale)


def rsum(expr: str, scale: int = 6) -> str:
    return xsum(expr, scale)


LR = f"""
losses AS (
  SELECT month_key, product_line, state, count(*) AS claim_count, {xsum('loss_amount')} AS incurred_losses
  FROM fc GROUP BY month_key, product_line, state),
earned AS (
  SELECT month_key, product_line, state, {xsum('annual_premium')} / 12.0 AS earned_premium
  FROM fp GROUP BY month_key, product_line, state),
lr AS (
  SELECT month_key, product_line, state, coalesce(claim_count, 0) AS claim_count,
         coalesce(incurred_losses, 0.0) AS incurred_losses, coalesce(earned_premium, 0.0) AS earned_premium
  FROM earned FULL OUTER JOIN losses USING (month_key, product_line, state))"""

LR_SQL = with_(*STAR, LR)


def _lr(t):
    s = Star(t)
    return marts.agg_loss_ratio(s.fact_claims_core, s.fact_premium)


def _reagg(df, by):
    out = df.groupBy(*by).agg(money("incurred_losses").alias("losses"), money("earned_premium").alias("earned"))
    return out.withColumn("loss_ratio", safe_ratio("losses", "earned"))


def _reagg_sql(by: str, where: str = "true") -> str:
    return LR_SQL + f"""
SELECT {by}, {rsum('incurred_losses')} AS losses, {rsum('earned_premium')} AS earned,
       {ratio(rsum('incurred_losses'), rsum('earned_premium'))} AS loss_ratio
FROM lr WHERE {where} GROUP BY {by}"""


@query("tile_loss_ratio_by_product", _reagg_sql("month_key, product_line"))
def tile_loss_ratio_by_product(t):
    """Monthly loss ratio by product line."""
    return _reagg(_lr(t), ["month_key", "product_line"])


@query("tile_loss_ratio_by_state", _reagg_sql("state"))
def tile_loss_ratio_by_state(t):
    """Loss ratio by state (numerator and denominator re-aggregated)."""
    return _reagg(_lr(t), ["state"])


FILTER_SQL = "month_key BETWEEN 199701 AND 199812 AND product_line IN ('1-URGENT', '2-HIGH') AND state IN ('NATION_1', 'NATION_2', 'NATION_3')"


@query("tile_filtered", _reagg_sql("month_key", FILTER_SQL))
def tile_filtered(t):
    """Shared filters (date range, product line, state) applied before
    the aggregation."""
    lr = _lr(t).where(F.col("month_key").between(199701, 199812) & F.col("product_line").isin("1-URGENT", "2-HIGH")
                      & F.col("state").isin("NATION_1", "NATION_2", "NATION_3"))
    return _reagg(lr, ["month_key"])


BL = f"""
bl AS (SELECT month_key, {xsum('amount_due')} AS written, {xsum('coalesce(amount_paid, 0.0)')} AS collected,
              {xsum('CASE WHEN is_overdue THEN amount_due ELSE 0.0 END')} AS overdue_exposure,
              count(*) FILTER (WHERE is_overdue) AS overdue_installments, count(*) AS installments
       FROM fpay GROUP BY month_key)"""


@query("tile_written_vs_collected", with_(PAYMENTS, BL) + f"""
SELECT CAST(month_key / 100 AS INTEGER) AS year, {rsum('written')} AS written, {rsum('collected')} AS collected,
       {ratio(rsum('collected'), rsum('written'))} AS collection_rate
FROM bl GROUP BY CAST(month_key / 100 AS INTEGER)""")
def tile_written_vs_collected(t):
    """Premium written vs collected per year."""
    bl = marts.billing_leakage(Star(t).fact_payments)
    out = bl.groupBy((F.col("month_key") / 100).cast("int").alias("year")).agg(
        money("written").alias("written"), money("collected").alias("collected"))
    return out.withColumn("collection_rate", safe_ratio("collected", "written"))


@query("tile_overdue_trend", with_(PAYMENTS, BL) + f"""
SELECT month_key, overdue_exposure, {ratio('overdue_installments', 'installments')} AS overdue_share FROM bl""")
def tile_overdue_trend(t):
    """Overdue exposure and share per month."""
    bl = marts.billing_leakage(Star(t).fact_payments)
    return bl.select("month_key", "overdue_exposure", safe_ratio("overdue_installments", "installments").alias("overdue_share"))


@query("tile_claim_trend", with_(*STAR, f"""
c AS (SELECT month_key, count(*) AS claim_count, {ratio(xsum('loss_amount'), 'count(*)')} AS severity FROM fc GROUP BY month_key),
a AS (SELECT month_key, count(DISTINCT policy_id) AS active_policies FROM fp GROUP BY month_key)""") + f"""
SELECT month_key, claim_count, severity, {ratio('claim_count', 'active_policies')} AS frequency FROM c LEFT JOIN a USING (month_key)""")
def tile_claim_trend(t):
    """Claim frequency and severity per month."""
    s = Star(t)
    m = marts.agg_claims_monthly(s.fact_claims_core, s.fact_premium, by_peril=False)
    return m.select("month_key", "claim_count", "severity", "frequency")


@query("tile_severity_by_peril", with_(*STAR) + f"""
SELECT peril_code, count(*) AS claim_count, {ratio(xsum('loss_amount'), 'count(*)')} AS severity FROM fc GROUP BY peril_code""")
def tile_severity_by_peril(t):
    """Severity by peril (from the claims mart at peril grain)."""
    fc = Star(t).fact_claims
    from strata.functions.numbers import exact_sum

    return fc.groupBy("peril_code").agg(F.count(F.lit(1)).alias("claim_count"),
                                        safe_ratio(exact_sum("loss_amount"), F.count(F.lit(1))).alias("severity"))


FM = f"""
fm AS (SELECT month_key, count(*) AS claims, count(*) FILTER (WHERE fraud_flag) AS fraud_claims,
              {xsum('CASE WHEN fraud_flag THEN loss_amount ELSE 0.0 END')} AS flagged_amount FROM fc GROUP BY month_key)"""


@query("tile_fraud_rate", with_(*STAR, FM) + f"SELECT month_key, {ratio('fraud_claims', 'claims')} AS fraud_rate FROM fm")
def tile_fraud_rate(t):
    """Fraud rate over time."""
    return marts.fraud_monthly(Star(t).fact_claims_core).select("month_key", "fraud_rate")


@query("tile_fraud_exposure", with_(*STAR, FM) + f"""
SELECT CAST(month_key / 100 AS INTEGER) AS year, {rsum('flagged_amount')} AS flagged_amount, CAST(sum(fraud_claims) AS BIGINT) AS fraud_claims
FROM fm GROUP BY CAST(month_key / 100 AS INTEGER)""")
def tile_fraud_exposure(t):
    """Flagged fraud exposure per year."""
    fm = marts.fraud_monthly(Star(t).fact_claims_core)
    return fm.groupBy((F.col("month_key") / 100).cast("int").alias("year")).agg(
        money("flagged_amount").alias("flagged_amount"), F.sum("fraud_claims").alias("fraud_claims"))


AP = f"""
ren AS (
  SELECT p.policy_id, EXISTS (SELECT 1 FROM pol q WHERE q.customer_id = p.customer_id AND q.product_line = p.product_line
                               AND q.effective_date >= p.expiration_date - 30 AND q.effective_date <= p.expiration_date + 30) AS renewed
  FROM pol p),
sold AS (SELECT agent_id, count(*) AS policies_sold, count(*) FILTER (WHERE renewed) AS renewed
         FROM dim_pol LEFT JOIN ren USING (policy_id) GROUP BY agent_id),
al AS (SELECT agent_id, {xsum('loss_amount')} AS losses FROM fc GROUP BY agent_id),
ae AS (SELECT agent_id, {xsum('annual_premium')} / 12.0 AS earned FROM fp GROUP BY agent_id),
ap AS (
  SELECT agent_id, agent_name, state, region, coalesce(policies_sold, 0) AS policies_sold,
         {ratio('renewed', 'policies_sold')} AS retention, coalesce(losses, 0.0) AS losses,
         coalesce(earned, 0.0) AS earned_premium, {ratio('coalesce(losses, 0.0)', 'earned')} AS loss_ratio
  FROM agt LEFT JOIN sold USING (agent_id) LEFT JOIN al USING (agent_id) LEFT JOIN ae USING (agent_id))"""

AP_SQL = with_(*STAR, AGENTS, AP)


def _ap(t):
    s = Star(t)
    return marts.agg_agent_performance(s.policies, s.fact_claims_core, s.dim_agent)


@query("agent_performance", AP_SQL + "SELECT * FROM ap")
def agent_performance(t):
    """Per current agent: policies sold, retention, loss ratio."""
    return _ap(t)


@query("tile_top_agents", AP_SQL + "SELECT agent_id, agent_name, policies_sold FROM ap ORDER BY policies_sold DESC, agent_id LIMIT 10")
def tile_top_agents(t):
    """Top 10 agents by policies sold (top-k report)."""
    s = Star(t)
    sold = s.policies.groupBy("agent_id").agg(F.count(F.lit(1)).alias("policies_sold"))
    out = s.dim_agent.select("agent_id", "agent_name").join(sold, "agent_id", "left").select(
        "agent_id", "agent_name", F.coalesce("policies_sold", F.lit(0)).alias("policies_sold"))
    return top_n(out, "policies_sold", 10, "agent_id")


@query("tile_agent_loss_vs_retention", AP_SQL + "SELECT agent_id, retention, loss_ratio FROM ap")
def tile_agent_loss_vs_retention(t):
    """Agent loss ratio vs retention."""
    return _ap(t).select("agent_id", "retention", "loss_ratio")


@query("tile_performance_by_region", AP_SQL + f"""
SELECT region, CAST(sum(policies_sold) AS BIGINT) AS policies_sold, {rsum('losses')} AS losses, {rsum('earned_premium')} AS earned,
       {ratio(rsum('losses'), rsum('earned_premium'))} AS loss_ratio
FROM ap GROUP BY region""")
def tile_performance_by_region(t):
    """Agent performance by region."""
    ap = _ap(t)
    out = ap.groupBy("region").agg(F.sum("policies_sold").alias("policies_sold"), money("losses").alias("losses"),
                                   money("earned_premium").alias("earned"))
    return out.withColumn("loss_ratio", safe_ratio("losses", "earned"))


RISK = f"""
v AS (SELECT user_id AS policy_id, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS harsh_events,
             {xsum('value')} AS distance
      FROM events WHERE value BETWEEN 0.0 AND 300.0 GROUP BY user_id),
cl AS (SELECT DISTINCT l_orderkey AS policy_id FROM lineitem WHERE l_returnflag = 'R'),
risk AS (SELECT v.*, 100.0 * (1.0 * CAST(harsh_events AS DOUBLE) / NULLIF(distance, 0)) AS harsh_score,
                cl.policy_id IS NOT NULL AS had_claim
         FROM v LEFT JOIN cl USING (policy_id))"""


def _risk(t):
    s = Star(t)
    return marts.agg_telematics_risk(s.trips, s.fact_claims_core)


@query("tile_harsh_histogram", with_(RISK) + """
SELECT floor(harsh_score / 0.01) * 0.01 AS bucket, count(*) AS n FROM risk WHERE harsh_score IS NOT NULL
GROUP BY floor(harsh_score / 0.01) * 0.01""")
def tile_harsh_histogram(t):
    """Harsh-score distribution."""
    return A.histogram(_risk(t), "harsh_score", 0.01)


@query("tile_claim_rate_by_quintile", with_(RISK) + f"""
SELECT quintile, count(*) AS policies, {ratio('count(*) FILTER (WHERE had_claim)', 'count(*)')} AS claim_rate FROM (
  SELECT *, CAST(ntile(5) OVER (ORDER BY harsh_score NULLS FIRST, policy_id) AS INTEGER) AS quintile FROM risk)
GROUP BY quintile""")
def tile_claim_rate_by_quintile(t):
    """Claim rate by score quintile (exact distributed ntile)."""
    q = quantile_bucket(_risk(t), "harsh_score", 5, "policy_id", "quintile")
    return q.groupBy("quintile").agg(F.count(F.lit(1)).alias("policies"),
                                     safe_ratio(F.count_if("had_claim"), F.count(F.lit(1))).alias("claim_rate"))


@query("tile_score_vs_loss", with_(RISK) + f"""
SELECT risk.policy_id, harsh_score, coalesce(l.losses, 0.0) AS losses FROM risk LEFT JOIN (
  SELECT l_orderkey AS policy_id, {xsum('l_extendedprice')} AS losses FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) l
USING (policy_id)""")
def tile_score_vs_loss(t):
    """Score vs loss per policy (scatter data)."""
    from strata.functions.numbers import exact_sum

    losses = Star(t).fact_claims_core.groupBy("policy_id").agg(exact_sum("loss_amount").alias("losses"))
    r = _risk(t).select("policy_id", "harsh_score")
    return r.join(losses, "policy_id", "left").select("policy_id", "harsh_score", F.coalesce("losses", F.lit(0.0)).alias("losses"))


CV = f"""
pa AS (
  SELECT customer_id, count(*) AS policy_count, count(*) FILTER (WHERE status = 'ACTIVE') AS active_policies,
         {xsum('annual_premium')} AS lifetime_premium
  FROM pol GROUP BY customer_id),
ca AS (SELECT customer_id, count(*) AS claim_count FROM fc GROUP BY customer_id),
cv AS (
  SELECT customer_id, segment, tenure_years, tenure_band, coalesce(active_policies, 0) AS active_policies,
         coalesce(lifetime_premium, 0.0) AS lifetime_premium, coalesce(claim_count, 0) AS claim_count,
         coalesce(active_policies, 0) = 0 AS churn_flag, policy_count IS NULL AS never_had_policy
  FROM dc LEFT JOIN pa USING (customer_id) LEFT JOIN ca USING (customer_id))"""

CV_SQL = with_(*STAR, DIM_CUSTOMER, CV)


def _cv(t):
    s = Star(t)
    return marts.agg_customer_value(s.dim_customer, s.policies, s.fact_claims_core)


@query("tile_active_customers", CV_SQL + f"""
SELECT segment, count(*) FILTER (WHERE active_policies > 0) AS active_customers, {rsum('lifetime_premium')} AS lifetime_premium
FROM cv GROUP BY segment""")
def tile_active_customers(t):
    """Active customers and lifetime premium by segment."""
    return _cv(t).groupBy("segment").agg(F.count_if(F.col("active_policies") > 0).alias("active_customers"),
                                         money("lifetime_premium").alias("lifetime_premium"))


@query("tile_churn", CV_SQL + """
SELECT segment, churn_flag, never_had_policy, count(*) AS customers FROM cv GROUP BY segment, churn_flag, never_had_policy""")
def tile_churn(t):
    """Churn breakdown."""
    return _cv(t).groupBy("segment", "churn_flag", "never_had_policy").agg(F.count(F.lit(1)).alias("customers"))


@query("tile_tenure", CV_SQL + f"""
SELECT tenure_band, count(*) AS customers, {rsum('lifetime_premium')} AS lifetime_premium FROM cv GROUP BY tenure_band""")
def tile_tenure(t):
    """Tenure distribution and lifetime premium by tenure band."""
    return _cv(t).groupBy("tenure_band").agg(F.count(F.lit(1)).alias("customers"),
                                             money("lifetime_premium").alias("lifetime_premium"))


@query("tile_quarantine_rate", SCORE_SQL + """
SELECT table_name, CAST(quarantined AS DOUBLE) / NULLIF(CAST(passed + quarantined AS DOUBLE), 0) AS quarantine_rate
FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY run_ts DESC) rn FROM sc) WHERE rn = 1""")
def tile_quarantine_rate(t):
    """Quarantine rate per table (latest run)."""
    return K.scorecard_view(_scorecard(t)).select("table_name", "quarantine_rate")


@query("tile_quarantine_by_rule", f"""
WITH {DIRTY_SQL}, c AS (SELECT count(*) AS total, {', '.join(f"count(*) FILTER (WHERE NOT {c}) AS {n}" for n, c in RULES_SQL.items())} FROM d)
SELECT rule, failed, CAST(failed AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) AS failed_rate
FROM c UNPIVOT (failed FOR rule IN ({', '.join(RULES_SQL)}))""")
def tile_quarantine_by_rule(t):
    """Failure rate per rule."""
    d = dirty_orders(t)
    row = K.scorecard_row(d, "orders", rules(), "2024-01-01 00:00:00")
    long = K.scorecard_rules(row).select("rule", "failed")
    total = d.agg(F.count(F.lit(1))).scalar()
    return long.withColumn("failed_rate", safe_ratio("failed", total))


@query("tile_passed_vs_quarantined", SCORE_SQL + """
SELECT table_name, CAST(sum(passed) AS BIGINT) AS passed, CAST(sum(quarantined) AS BIGINT) AS quarantined FROM sc GROUP BY table_name""")
def tile_passed_vs_quarantined(t):
    """Passed vs quarantined per table over all runs."""
    return _scorecard(t).groupBy("table_name").agg(F.sum("passed").alias("passed"), F.sum("quarantined").alias("quarantined"))


@query("tile_freshness", """
SELECT 'events' AS source, CAST(max(ts) AS TIMESTAMP) AS newest,
       CAST(date_diff('day', max(ts), TIMESTAMP '2024-02-01') AS INTEGER) AS age_days FROM events""")
def tile_freshness(t):
    """Source freshness and age in days at the report time."""
    f = K.freshness(t.events.select(F.lit("events").alias("source"), "ts"), "ts", "source", "newest")
    return f.withColumn("age_days", F.date_diff(F.lit("2024-02-01").cast("date"), F.to_date("newest")).cast("int"))
