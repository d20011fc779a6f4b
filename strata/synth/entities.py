"""Entity generators (Y3-Y8, Y18) as Spark jobs over ``spark.range``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.synth import config as C
from strata.synth.columns import choice, gen_dates, gen_ids, gen_timestamps, normal, pick, uniform, uniform_int

FIRST = ["James", "Mary", "John", "Linda", "Ana", "Wei", "Omar", "Sofia", "Liam", "Noah", "Emma", "Ava"]
LAST = ["Smith", "Garcia", "Chen", "Patel", "Brown", "Lopez", "Kim", "Nguyen", "Silva", "Muller", "Rossi", "Khan"]
CITIES = ["Springfield", "Riverside", "Fairview", "Franklin", "Greenville", "Bristol", "Clinton", "Salem"]
DOMAINS = ["example.com", "mail.com", "test.org", "acme.net"]


def _region(seed: int, name: str):
    return pick(seed, name, list(C.REGION_ZIP1))


def gen_customers(spark: SparkSession, cfg: C.GenConfig, start_id: int = 1, n: int | None = None) -> DataFrame:
    """Customers; postal code's first digit matches the region; 18 %
    commercial; created_at = updated_at at first load."""
    n = n or cfg.customers
    s = cfg.seed
    df = gen_ids(spark, "CUST", start_id, n, 8, "customer_id")
    region = _region(s, "cust.region")
    df = df.withColumn("_region", region)
    zip1 = F.create_map(*[F.lit(x) for kv in C.REGION_ZIP1.items() for x in kv])[F.col("_region")]
    states = F.create_map(*[x for k, v in C.REGION_STATES.items() for x in (F.lit(k), F.array(*[F.lit(z) for z in v]))])
    first, last = pick(s, "cust.first", FIRST), pick(s, "cust.last", LAST)
    created = gen_timestamps(s, "cust.created", cfg.start, cfg.end)
    return df.select(
        "customer_id", "_n",
        first.alias("first_name"), last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.col("_n").cast("string"), F.lit("@"),
                 pick(s, "cust.domain", DOMAINS)).alias("email"),
        F.format_string("(%03d) 555-%04d", uniform_int(s, "cust.area", 200, 989), uniform_int(s, "cust.line", 0, 9999)).alias("phone"),
        F.concat(uniform_int(s, "cust.house", 1, 9999).cast("string"), F.lit(" Main St")).alias("address_line1"),
        pick(s, "cust.city", CITIES).alias("city"),
        F.element_at(states[F.col("_region")], uniform_int(s, "cust.state", 1, 4)).alias("state"),
        F.concat(zip1, F.lpad(uniform_int(s, "cust.zip", 0, 9999).cast("string"), 4, "0")).alias("postal_code"),
        F.date_format(gen_dates(s, "cust.dob", "1940-01-01", "2004-01-01"), "yyyy-MM-dd").alias("date_of_birth"),
        pick(s, "cust.gender", ["M", "F", "X"]).alias("gender"),
        F.date_format(gen_dates(s, "cust.since", cfg.start, cfg.end), "yyyy-MM-dd").alias("customer_since"),
        F.when(uniform(s, "cust.segment") < C.COMMERCIAL_SHARE, "COMMERCIAL").otherwise("PERSONAL").alias("segment"),
        F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"),
    )


def gen_agents(spark: SparkSession, cfg: C.GenConfig, start_id: int = 1, n: int | None = None) -> DataFrame:
    """Agents, 85 % active, commission 5-20 %."""
    n = n or cfg.agents
    s = cfg.seed
    df = gen_ids(spark, "AGT", start_id, n, 5, "agent_id")
    region = _region(s, "agt.region")
    first, last = pick(s, "agt.first", FIRST), pick(s, "agt.last", LAST)
    return df.select(
        "agent_id", "_n", first.alias("first_name"), last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@agency.example")).alias("email"),
        F.concat(pick(s, "agt.branch", CITIES), F.lit(" Branch")).alias("branch"),
        region.alias("region"), pick(s, "agt.state", [z for v in C.REGION_STATES.values() for z in v]).alias("state"),
        F.date_format(gen_dates(s, "agt.hire", "2005-01-01", cfg.end), "yyyy-MM-dd").alias("hire_date"),
        F.when(uniform(s, "agt.status") < C.AGENT_ACTIVE_SHARE, "ACTIVE").otherwise("INACTIVE").alias("status"),
        F.round(F.lit(0.05) + uniform(s, "agt.comm") * 0.15, 4).alias("commission_rate"),
        F.date_format(gen_timestamps(s, "agt.updated", cfg.start, cfg.end), "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"),
    )


def gen_policies(spark: SparkSession, cfg: C.GenConfig, start_id: int = 1, n: int | None = None) -> DataFrame:
    """Policies with nested coverages (1-4 unique codes), 60 % AUTO,
    premium normal(1200, 350) AUTO / (1600, 600) PROPERTY floored at 150,
    365-day term, vehicle or property struct by product line."""
    n = n or cfg.policies
    s = cfg.seed
    df = gen_ids(spark, "POL", start_id, n, 9, "policy_id")
    line = F.when(uniform(s, "pol.line") < C.AUTO_SHARE, "AUTO").otherwise("PROPERTY")
    df = df.withColumn("product_line", line)
    auto = F.col("product_line") == "AUTO"
    cust_n = uniform_int(s, "pol.cust", 1, cfg.customers)
    eff = gen_dates(s, "pol.eff", cfg.start, cfg.end)
    mu_a, sd_a = C.PREMIUM_NORMAL["AUTO"]
    mu_p, sd_p = C.PREMIUM_NORMAL["PROPERTY"]
    premium = F.greatest(F.lit(C.PREMIUM_FLOOR), F.when(auto, normal(s, "pol.prem_a", mu_a, sd_a)).otherwise(normal(s, "pol.prem_p", mu_p, sd_p)))
    k = uniform_int(s, "pol.ncov", 1, 4)
    codes_a = F.array(*[F.lit(c) for c in C.AUTO_COVERAGES])
    codes_p = F.array(*[F.lit(c) for c in C.PROPERTY_COVERAGES])
    perils_a = F.array(*[F.lit(c) for c in C.AUTO_PERILS])
    perils_p = F.array(*[F.lit(c) for c in C.PROPERTY_PERILS])
    # k distinct codes: a rotation of the code list from a hashed offset
    off = uniform_int(s, "pol.covoff", 0, 5)
    cov = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.struct(
        F.element_at(F.when(auto, codes_a).otherwise(codes_p), (F.pmod(off + i, F.lit(6)) + 1).cast("int")).alias("coverage_code"),
        (F.lit(10000) * (F.pmod(F.xxhash64(F.lit(s), F.col("_n"), i), F.lit(50)) + 1)).cast("bigint").alias("limit"),
        (F.lit(250) * (F.pmod(F.xxhash64(F.lit(s + 1), F.col("_n"), i), F.lit(8)) + 1)).cast("bigint").alias("deductible"),
        F.element_at(F.when(auto, perils_a).otherwise(perils_p),
                     (F.pmod(F.xxhash64(F.lit(s + 2), F.col("_n"), i), F.when(auto, F.lit(7)).otherwise(F.lit(9))) + 1).cast("int")).alias("peril_code"),
    ))
    vehicle = F.when(auto, F.struct(pick(s, "pol.make", ["Toyota", "Ford", "Honda", "Tesla"]).alias("make"),
                                    pick(s, "pol.model", ["A", "B", "C"]).alias("model"),
                                    uniform_int(s, "pol.year", 2000, 2025).alias("year"),
                                    F.substring(F.sha2(F.col("policy_id"), 256), 1, 17).alias("vin"),
                                    pick(s, "pol.vtype", ["Passenger", "SUV", "Truck"]).alias("vehicle_type")))
    prop = F.when(~auto, F.struct(pick(s, "pol.constr", ["Frame", "Masonry", "Brick", "Concrete"]).alias("construction"),
                                  uniform_int(s, "pol.built", 1900, 2024).alias("year_built"),
                                  uniform_int(s, "pol.sqft", 500, 6000).alias("sq_ft")))
    return df.select(
        "policy_id", "_n",
        F.concat(F.lit("CUST"), F.lpad(cust_n.cast("string"), 8, "0")).alias("customer_id"),
        F.concat(F.lit("AGT"), F.lpad(uniform_int(s, "pol.agent", 1, cfg.agents).cast("string"), 5, "0")).alias("agent_id"),
        "product_line",
        choice(s, "pol.status", C.POLICY_STATUS_WEIGHTS).alias("status"),
        F.date_format(eff, "yyyy-MM-dd").alias("effective_date"),
        F.date_format(F.date_add(eff, 365), "yyyy-MM-dd").alias("expiration_date"),
        F.round(premium, 2).alias("annual_premium"),
        (F.lit(1000.0) * uniform_int(s, "pol.sum", 20, 800)).alias("sum_insured"),
        choice(s, "pol.freq", C.PAYMENT_FREQUENCY_WEIGHTS).alias("payment_frequency"),
        cov.alias("coverages"), vehicle.alias("vehicle"), prop.alias("property"),
    )


def gen_claims(spark: SparkSession, cfg: C.GenConfig, policies: DataFrame, start_id: int = 1, n: int | None = None) -> DataFrame:
    """Claims on uniformly chosen policies (joined by generated index,
    an equi join on the policy number); loss 5-80 % of sum insured, paid
    only when CLOSED, 4 % fraud."""
    n = n or cfg.claims
    s = cfg.seed
    df = gen_ids(spark, "CLM", start_id, n, 9, "claim_id")
    n_pol = policies.agg(F.max("_n")).scalar()
    df = df.withColumn("_pol_n", (F.floor(uniform(s, "clm.pol") * n_pol) + 1).cast("long"))
    pol = policies.select(F.col("_n").alias("_pol_n"), "policy_id", "customer_id", "product_line", "sum_insured", "effective_date")
    j = df.join(pol, "_pol_n", "inner")
    loss_date = gen_dates(s, "clm.loss", cfg.start, cfg.end)
    status = choice(s, "clm.status", C.CLAIM_STATUS_WEIGHTS)
    loss = F.round(F.col("sum_insured") * (F.lit(0.05) + uniform(s, "clm.share") * 0.75), 2)
    fraud = uniform(s, "clm.fraud") < C.FRAUD_RATE
    return j.select(
        "claim_id", "_n", "policy_id", "customer_id",
        F.date_format(loss_date, "yyyy-MM-dd").alias("loss_date"),
        F.date_format(F.date_add(loss_date, uniform_int(s, "clm.lag", 0, 30)), "yyyy-MM-dd").alias("claim_date"),
        F.element_at(F.when(F.col("product_line") == "AUTO", F.array(*[F.lit(p) for p in C.AUTO_PERILS]))
                     .otherwise(F.array(*[F.lit(p) for p in C.PROPERTY_PERILS])),
                     (F.floor(uniform(s, "clm.peril") * F.when(F.col("product_line") == "AUTO", 7).otherwise(9)) + 1).cast("int")).alias("peril_code"),
        status.alias("claim_status"),
        loss.alias("reported_amount"), loss.alias("loss_amount"),
        F.when(status == "CLOSED", F.round(loss * 0.9, 2)).otherwise(F.lit(0.0)).alias("paid_amount"),
        F.when(fraud, pick(s, "clm.ftok", C.FRAUD_TRUE)).otherwise(pick(s, "clm.ftok", C.FRAUD_FALSE)).alias("fraud_flag"),
        F.lit("claim").alias("description"),
    )


def gen_payments(policies: DataFrame, cfg: C.GenConfig, as_of: str = "2026-04-01") -> DataFrame:
    """One row per installment (1 / 2 / 4 / 12 by frequency) via
    ``explode(sequence)``; 4 % missed, 12 % late, future -> PENDING."""
    s = cfg.seed
    n_inst = F.create_map(*[F.lit(x) for kv in C.INSTALLMENTS.items() for x in kv])[F.col("payment_frequency")]
    p = policies.select("policy_id", "_n", "payment_frequency", F.to_date("effective_date").alias("_eff"),
                        F.col("annual_premium").cast("double").alias("_prem"), n_inst.alias("_k"))
    p = p.withColumn("installment_no", F.explode(F.sequence(F.lit(1), F.col("_k"))))
    p = p.withColumn("_pid", F.col("_n") * 16 + F.col("installment_no"))
    due = F.add_months(F.col("_eff"), ((F.col("installment_no") - 1) * (F.lit(12) / F.col("_k"))).cast("int"))
    u = uniform(s, "pay.state", "_pid")
    status = (F.when(due > F.to_date(F.lit(as_of)), "PENDING")
              .when(u < C.MISSED_PAYMENT_RATE, "MISSED")
              .when(u < C.MISSED_PAYMENT_RATE + C.LATE_PAYMENT_RATE, "LATE").otherwise("PAID"))
    amount = F.round(F.col("_prem") / F.col("_k"), 2)
    paid = status.isin("PAID", "LATE")
    return p.select(
        F.concat(F.col("policy_id"), F.lit("-"), F.lpad(F.col("installment_no").cast("string"), 2, "0")).alias("payment_id"),
        "policy_id", F.col("installment_no").cast("int").alias("installment_no"),
        due.cast("timestamp").alias("due_date"),
        F.when(paid, F.date_add(due, F.when(status == "LATE", uniform_int(s, "pay.late", 5, 60, "_pid")).otherwise(0)).cast("timestamp")).alias("paid_date"),
        amount.alias("amount_due"), F.when(paid, amount).alias("amount_paid"),
        pick(s, "pay.method", ["CARD", "ACH", "CHECK"], "_pid").alias("payment_method"), status.alias("status"),
    )


def gen_events(spark: SparkSession, cfg: C.GenConfig, policies: DataFrame, start_id: int = 1, n: int | None = None,
               drift: bool = False) -> DataFrame:
    """Trip events; 3 % arrive late (shifted back 1 h - 7 d); harsh
    flags 5 / 5 / 3 %; ``device_fw`` only when ``drift``."""
    n = n or cfg.events
    s = cfg.seed
    df = gen_ids(spark, "EVT", start_id, n, 10, "event_id")
    n_pol = policies.agg(F.max("_n")).scalar()
    df = df.withColumn("_pol_n", (F.floor(uniform(s, "evt.pol") * n_pol) + 1).cast("long"))
    j = df.join(policies.select(F.col("_n").alias("_pol_n"), "policy_id", "customer_id"), "_pol_n", "inner")
    ts = gen_timestamps(s, "evt.ts", "2024-01-01", "2026-05-04")
    late = uniform(s, "evt.late") < cfg.rates["late"]
    shift = F.make_interval(secs=(F.lit(3600) + F.floor(uniform(s, "evt.shift") * (7 * 86400 - 3600))).cast("decimal(18,6)"))
    cols = [
        "event_id", "_n", F.concat(F.lit("TRP"), F.lpad(uniform_int(s, "evt.trip", 1, max(1, n // 20)).cast("string"), 8, "0")).alias("trip_id"),
        "policy_id", "customer_id",
        F.date_format(F.when(late, ts - shift).otherwise(ts), "yyyy-MM-dd'T'HH:mm:ss").alias("event_ts"),
        F.round(F.lit(25.0) + uniform(s, "evt.lat") * 23, 6).alias("latitude"),
        F.round(F.lit(-124.0) + uniform(s, "evt.lon") * 57, 6).alias("longitude"),
        F.round(uniform(s, "evt.speed") * 130, 1).alias("speed_kmh"),
        uniform_int(s, "evt.heading", 0, 359).alias("heading"),
        (uniform(s, "evt.brake") < 0.05).alias("harsh_brake"),
        (uniform(s, "evt.accel") < 0.05).alias("harsh_accel"),
        (uniform(s, "evt.corner") < 0.03).alias("harsh_corner"),
        F.round(uniform(s, "evt.miles") * 2, 3).alias("mileage"),
        F.concat(F.lit("DEV"), F.lpad(uniform_int(s, "evt.dev", 1, 99999).cast("string"), 5, "0")).alias("device_id"),
    ]
    if drift:
        cols.append(F.concat(F.lit("fw-"), uniform_int(s, "evt.fw", 1, 9).cast("string")).alias("device_fw"))
    return j.select(*cols)


def gen_delta(spark: SparkSession, cfg: C.GenConfig, batch: int, customers: DataFrame, agents: DataFrame,
              policies: DataFrame, n_customer_updates: int, n_agent_updates: int, n_new_policies: int,
              n_new_claims: int, n_events: int, drift_batch: int = 2) -> dict:
    """A delta batch: updates to existing customers / agents (newer
    ``updated_at``, changed city / branch), new policies, claims and events
    (``device_fw`` appears in the drift batch)."""
    s = cfg.seed + 1000 * batch
    when = F.lit(f"2026-04-{batch:02d}T00:00:00")
    cust_upd = customers.where(uniform(s, "d.cust") < F.lit(n_customer_updates / max(1, cfg.customers))) \
        .withColumn("city", pick(s, "d.city", ["Lakewood", "Madison", "Georgetown"])).withColumn("updated_at", when)
    agt_upd = agents.where(uniform(s, "d.agt") < F.lit(n_agent_updates / max(1, cfg.agents))) \
        .withColumn("branch", F.lit("Moved Branch")).withColumn("updated_at", when)
    dcfg = C.GenConfig(**{**cfg.__dict__, "seed": s})
    start = cfg.policies + 1 + (batch - 1) * n_new_policies
    new_pol = gen_policies(spark, dcfg, start_id=start, n=n_new_policies)
    new_clm = gen_claims(spark, dcfg, policies, start_id=cfg.claims + 1 + (batch - 1) * n_new_claims, n=n_new_claims)
    events = gen_events(spark, dcfg, policies, start_id=cfg.events + 1 + (batch - 1) * n_events, n=n_events,
                        drift=batch >= drift_batch)
    return {"customers": cust_upd, "agents": agt_upd, "policies": new_pol, "claims": new_clm,
            "payments": gen_payments(new_pol, dcfg), "telematics": events}
