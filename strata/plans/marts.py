"""Star schema and marts (L1-L14) over silver-shaped DataFrames.

Grain is stated per function. Facts are joined to dimensions fact-first;
aggregates are computed per grain before any join between two facts, so no
join fans a fact out (trap: joining history instead of current rows).
Money totals use exact decimal sums, so results do not depend on
partitioning or task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import calendar_attributes, date_key, month_key, tenure_years, band
from strata.functions.flags import is_overdue
from strata.functions.numbers import exact_sum, safe_ratio, in_range
from strata.operators.nested import date_spine, expand_months

TENURE_EDGES = (0, 1, 3, 5, 10)
CONTACT = ("email", "phone", "city", "postal_code")
AGE_EDGES = (0, 18, 25, 35, 50, 65)
TENURE_LABELS = ("<1y", "1-2y", "3-4y", "5-9y", "10y+")


# ---------------------------------------------------------------- dimensions

def dim_date(spine: DataFrame, date_col: str = "date") -> DataFrame:
    """L1: one row per day of ``spine`` with 15 calendar attributes."""
    return spine.select(*calendar_attributes(date_col))


def date_bounds(df: DataFrame, col: str, whole_years: bool = True) -> DataFrame:
    """One-row frame (start, end) spanning the dates of ``col``, widened to
    whole years; feeds :func:`date_spine` so the calendar follows the data."""
    lo, hi = F.min(F.to_date(col)), F.max(F.to_date(col))
    if whole_years:
        lo, hi = F.trunc(lo, "year"), F.date_sub(F.add_months(F.trunc(hi, "year"), 12), 1)
    return df.agg(lo.alias("start"), hi.alias("end"))


def dim_date_for(df: DataFrame, col: str) -> DataFrame:
    return dim_date(date_spine(date_bounds(df, col)))


def customer_since(policies: DataFrame) -> DataFrame:
    return policies.groupBy("customer_id").agg(F.min("effective_date").alias("customer_since"))


def dim_customer(customers: DataFrame, policies: DataFrame, as_of: str) -> DataFrame:
    """L2: one row per customer: contact columns and age band where the
    source has them (email, phone, city, postal_code, date_of_birth), state,
    region, segment, first policy date, whole tenure years at ``as_of`` and
    its band."""
    since = customer_since(policies)
    out = customers.join(since, "customer_id", "left")
    years = tenure_years("customer_since", as_of)
    contact = [c for c in CONTACT if c in customers.columns]
    if "date_of_birth" in customers.columns:
        contact.append(band(tenure_years("date_of_birth", as_of), AGE_EDGES).alias("age_band"))
    return out.select(
        "customer_id", "name", *contact, "segment", "state", "region", "customer_since",
        years.alias("tenure_years"),
        band(years, TENURE_EDGES, TENURE_LABELS).alias("tenure_band"),
    )


def coverage_rollup(coverages: DataFrame) -> DataFrame:
    """E7 over coverages: count and exact total limit per policy."""
    return coverages.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("coverage_count"),
        exact_sum("limit_amount").alias("total_limit"),
    )


def dim_policy(policies: DataFrame, customers: DataFrame, coverages: DataFrame) -> DataFrame:
    """L3: one row per policy, ``state`` from its customer, coverage rollup
    (0 / 0.0 for a policy without coverages)."""
    cust = customers.select("customer_id", "state")
    out = policies.join(cust, "customer_id", "left").join(coverage_rollup(coverages), "policy_id", "left")
    return out.na.fill({"coverage_count": 0, "total_limit": 0.0})


def fact_premium(policies: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """One row per policy x in-force month (month starts within
    ``[effective_date, expiration_date]``), ``earned_premium`` =
    annual / 12. ``state`` is attached before the explode, so the join
    shuffles one row per policy, not one per month."""
    p = policies
    if customers is not None:
        p = p.join(customers.select("customer_id", "state"), "customer_id", "left")
    keep = ["policy_id", "customer_id", "agent_id", "product_line", "status", "annual_premium"]
    if customers is not None:
        keep.append("state")
    m = expand_months(p, "effective_date", "expiration_date", "month")
    return m.select(
        *keep,
        month_key("month").alias("month_key"),
        (F.col("annual_premium") / F.lit(12.0)).alias("earned_premium"),
    )


def fact_claims(claims: DataFrame, dim_pol: DataFrame, perils: DataFrame | None = None) -> DataFrame:
    """One row per claim with product line, state, customer and peril.
    ``date_key`` / ``month_key`` follow the loss date; where the claims have a
    ``claim_date``, ``claim_date_key`` follows that.

    ``perils`` (``part_key`` or ``peril_code`` to ``peril_code`` and, if given,
    ``peril_name``) resolves the peril; marts that do not use the peril leave
    it out, so their plans hold no peril join at all.
    """
    pol = dim_pol.select("policy_id", "customer_id", "agent_id", "product_line", "state")
    # policy attributes come from the policy dimension (one source of truth)
    claims = claims.drop(*[c for c in ("customer_id", "agent_id", "product_line", "state") if c in claims.columns])
    if perils is not None:
        claims = claims.join(perils, "part_key" if "part_key" in perils.columns else "peril_code", "left")
    if "peril_code" not in claims.columns:
        claims = claims.withColumn("peril_code", F.lit(None).cast("string"))
    out = claims.join(pol, "policy_id", "left")
    return out.select(
        "claim_id", "policy_id", "customer_id", "agent_id", "product_line", "state",
        date_key("loss_date").alias("date_key"),
        month_key("loss_date").alias("month_key"),
        *([date_key("claim_date").alias("claim_date_key")] if "claim_date" in out.columns else []),
        "peril_code", *(["peril_name"] if "peril_name" in out.columns else []),
        "claim_status", "loss_amount", "paid_amount", "fraud_flag",
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    """One row per installment, date key on the due date, overdue flag."""
    return payments.select(
        "payment_id", "policy_id", "installment_no", "due_date", "paid_date",
        date_key("due_date").alias("date_key"),
        month_key("due_date").alias("month_key"),
        "amount_due", "amount_paid", "status",
        is_overdue("status").alias("is_overdue"),
    )


# ---------------------------------------------------------------- marts

def agg_loss_ratio(fclaims: DataFrame, fpremium: DataFrame, grain=("month_key", "product_line", "state"),
                   include_unearned: bool = True) -> DataFrame:
    """Losses / earned premium per grain.

    Both facts are aggregated to the grain first (partial + final
    aggregates, small outputs), then joined. ``include_unearned`` keeps
    grains with losses but no earned premium (full outer join, ratio NULL);
    ``False`` gives the documented left join from premium.
    """
    grain = list(grain)
    losses = fclaims.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("claim_count"),
        exact_sum("loss_amount").alias("incurred_losses"),
    )
    earned = fpremium.groupBy(*grain).agg(
        (exact_sum("annual_premium") / F.lit(12.0)).alias("earned_premium"),
    )
    how = "full" if include_unearned else "left"
    out = earned.join(losses, grain, how)
    return out.select(
        *grain,
        F.coalesce("claim_count", F.lit(0)).alias("claim_count"),
        F.coalesce("incurred_losses", F.lit(0.0)).alias("incurred_losses"),
        F.coalesce("earned_premium", F.lit(0.0)).alias("earned_premium"),
        safe_ratio(F.coalesce("incurred_losses", F.lit(0.0)), "earned_premium").alias("loss_ratio"),
    )


def active_policies_by_month(fpremium: DataFrame) -> DataFrame:
    """Policies in force per month. ``fact_premium`` holds one row per
    (policy, month) by construction, so a plain count is the distinct count
    (no distinct aggregate, no second shuffle)."""
    return fpremium.groupBy("month_key").agg(F.count(F.lit(1)).alias("active_policies"))


def agg_claims_monthly(fclaims: DataFrame, fpremium: DataFrame, by_peril: bool = True) -> DataFrame:
    """Month (x peril): claim count, severity (mean loss), distinct
    policies, fraud rate; frequency = claims / policies in force that month."""
    grain = ["month_key", "peril_code"] if by_peril else ["month_key"]
    c = fclaims.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("claim_count"),
        safe_ratio(exact_sum("loss_amount"), F.count(F.lit(1))).alias("severity"),
        F.countDistinct("policy_id").alias("distinct_policies"),
        safe_ratio(F.count_if(F.col("fraud_flag")), F.count(F.lit(1))).alias("fraud_rate"),
    )
    out = c.join(active_policies_by_month(fpremium), "month_key", "left")
    return out.withColumn("frequency", safe_ratio("claim_count", "active_policies"))


def renewals(policies: DataFrame, grace_days: int = 30) -> DataFrame:
    """Trap 18 rule: a policy is renewed when the same customer has another
    policy of the same product line starting within ``grace_days`` of its
    expiration. Computed without pairing policies: each policy asks for the
    earliest start at or after ``expiration - grace``; starts and questions
    are stacked and scanned per (customer, product line, day of the
    question) with a carry-in of each day's first start."""
    from strata.operators.sequence import next_value_at_or_after

    carried = [c for c in policies.columns if c not in ("customer_id", "product_line")]
    starts = policies.select("customer_id", "product_line", F.col("effective_date").alias("_t"))
    asks = policies.select("customer_id", "product_line", *carried,
                           F.date_sub("expiration_date", grace_days).alias("_t"),
                           F.date_add("expiration_date", grace_days).alias("_until"))
    nxt = next_value_at_or_after(asks, starts, ["customer_id", "product_line"], "_t", "_next_start", unit="day")
    renewed = F.col("_next_start").isNotNull() & (F.col("_next_start") <= F.col("_until"))
    return nxt.select(*policies.columns, renewed.alias("renewed"))


def months_in_force(start: str, end: str) -> Column:
    """Month starts within ``[start, end]`` (what :func:`fact_premium`
    explodes to), as a number."""
    index = lambda d: F.year(d) * 12 + F.month(d)
    first = index(start) + F.when(F.dayofmonth(start) > 1, 1).otherwise(0)
    return F.greatest(index(end) - first + 1, F.lit(0))


def agg_agent_performance(policies: DataFrame, fclaims: DataFrame, dim_agent: DataFrame, grace_days: int = 30) -> DataFrame:
    """Per current agent: policies sold, retention (renewed / total),
    loss ratio (claims losses / earned premium of the agent's policies).

    One pass over the policies gives sold, renewed and earned: the months in
    force are a number, so nothing is exploded to be summed again."""
    months = months_in_force("effective_date", "expiration_date")
    base = policies.select("policy_id", "customer_id", "agent_id", "product_line", "effective_date", "expiration_date",
                           (F.col("annual_premium") * months).alias("months_premium"))
    sold = renewals(base, grace_days).groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("policies_sold"),
        F.count_if(F.col("renewed")).alias("renewed"),
        F.nullif(F.sum(months), F.lit(0)).alias("months"),
        (exact_sum("months_premium") / F.lit(12.0)).alias("earned_sum"),
    ).withColumn("earned", F.when(F.col("months").isNotNull(), F.col("earned_sum")))
    losses = fclaims.groupBy("agent_id").agg(exact_sum("loss_amount").alias("losses"))
    cur = dim_agent.select("agent_id", "agent_name", "state", "region")
    out = cur.join(sold, "agent_id", "left").join(losses, "agent_id", "left")
    return out.select(
        "agent_id", "agent_name", "state", "region",
        F.coalesce("policies_sold", F.lit(0)).alias("policies_sold"),
        safe_ratio("renewed", "policies_sold").alias("retention"),
        F.coalesce("losses", F.lit(0.0)).alias("losses"),
        F.coalesce("earned", F.lit(0.0)).alias("earned_premium"),
        safe_ratio(F.coalesce("losses", F.lit(0.0)), "earned").alias("loss_ratio"),
    )


def agg_customer_value(dim_cust: DataFrame, policies: DataFrame, fclaims: DataFrame) -> DataFrame:
    """Per customer: tenure, active policies, lifetime premium, claim
    count, churn (no ACTIVE policy, trap 19) and ``never_had_policy``."""
    p = policies.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("policy_count"),
        F.count_if(F.col("status") == "ACTIVE").alias("active_policies"),
        exact_sum("annual_premium").alias("lifetime_premium"),
    )
    c = fclaims.groupBy("customer_id").agg(F.count(F.lit(1)).alias("claim_count"))
    out = dim_cust.select("customer_id", "segment", "tenure_years", "tenure_band") \
        .join(p, "customer_id", "left").join(c, "customer_id", "left")
    return out.select(
        "customer_id", "segment", "tenure_years", "tenure_band",
        F.coalesce("active_policies", F.lit(0)).alias("active_policies"),
        F.coalesce("lifetime_premium", F.lit(0.0)).alias("lifetime_premium"),
        F.coalesce("claim_count", F.lit(0)).alias("claim_count"),
        (F.coalesce("active_policies", F.lit(0)) == 0).alias("churn_flag"),
        F.col("policy_count").isNull().alias("never_had_policy"),
    )


def agg_telematics_risk(trips: DataFrame, fclaims: DataFrame, flags: dict[str, float] | None = None, distance: str = "distance",
                        speed: str | None = None, speed_range=(0.0, 300.0), per: float = 100.0) -> DataFrame:
    """Per policy: weighted harsh events (``flags``: column -> weight)
    per ``per`` distance units over valid rows only, and whether the policy
    had a claim. A row is valid if ``speed`` (the distance, for sources
    without a speed) lies in ``speed_range``."""
    flags = flags or {"harsh": 1.0}
    hits = {f: F.count_if(F.col(f)) for f in flags}
    valid = trips.where(in_range(speed or distance, *speed_range))
    agg = valid.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("events"),
        *[n.alias(f"_{f}") for f, n in hits.items()],
        exact_sum(distance).alias("distance"),
    )
    total, weighted = F.lit(0).cast("long"), F.lit(0.0)
    for f, w in flags.items():
        total, weighted = total + F.col(f"_{f}"), weighted + F.lit(float(w)) * F.col(f"_{f}")
    agg = agg.withColumn("harsh_events", total).withColumn("harsh_score", F.lit(per) * safe_ratio(weighted, "distance"))
    had = fclaims.select("policy_id").distinct().withColumn("had_claim", F.lit(True))
    out = agg.select("policy_id", "events", "harsh_events", "distance", "harsh_score").join(had, "policy_id", "left")
    return out.withColumn("had_claim", F.coalesce("had_claim", F.lit(False)))


def billing_leakage(fpay: DataFrame, by=("month_key",)) -> DataFrame:
    """Written (sum due), collected (sum paid), overdue exposure."""
    return fpay.groupBy(*by).agg(
        exact_sum("amount_due").alias("written"),
        exact_sum(F.coalesce("amount_paid", F.lit(0.0))).alias("collected"),
        exact_sum(F.when(F.col("is_overdue"), F.col("amount_due")).otherwise(F.lit(0.0))).alias("overdue_exposure"),
        F.count_if("is_overdue").alias("overdue_installments"),
        F.count(F.lit(1)).alias("installments"),
    )


def fraud_monthly(fclaims: DataFrame) -> DataFrame:
    """Per month: claims, fraud claims, fraud rate, flagged amount."""
    return fclaims.groupBy("month_key").agg(
        F.count(F.lit(1)).alias("claims"),
        F.count_if("fraud_flag").alias("fraud_claims"),
        safe_ratio(F.count_if("fraud_flag"), F.count(F.lit(1))).alias("fraud_rate"),
        exact_sum(F.when(F.col("fraud_flag"), F.col("loss_amount")).otherwise(F.lit(0.0))).alias("flagged_amount"),
    )
