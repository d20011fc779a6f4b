"""One run landing -> bronze -> silver -> gold over a landing folder of
the insurance sources (as produced by ``strata.synth``).

Bronze loads are ledgered (``copy_into``: a re-run adds nothing), lookups are
read from their files. Silver cleans with the B operators, incrementally
(:mod:`strata.plans.hops`): a run reads the bronze rows that are new, judges
again what they touch, and passed rows, quarantine and scorecard are views of
the result (:func:`silver` is the same in one pass over everything). Gold is
computed from silver, and published only when the quality gate passes. Other
tables are snapshots behind pointers under ``<root>/<layer>/<name>``; paths may
be any Hadoop URI.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.categories import CLAIM_STATUS_FIXES, POLICY_STATUS_FIXES, map_category
from strata.functions.dates import parse_date, parse_timestamp
from strata.functions.flags import parse_bool
from strata.functions.numbers import parse_money
from strata.functions.text import normalize_text
from strata.operators import quality as K
from strata.operators.dedup import drop_exact_duplicates
from strata.operators.joins import split_fk
from strata.operators.nested import date_spine, explode_lines
from strata.operators.projection import validate_category
from strata.operators.ranking import latest_per_key
from strata.operators.scd import scd2_apply, scd2_seed
from strata.plans import marts
from strata.plans.hops import Hop, Parent
from strata.plans.hops import Silver as HopStore
from strata.sources import files, ingest, sinks
from strata.sources.pointer import exists, read_text, replace_text
from strata.synth.land import FORMATS

CUSTOMER_SCHEMA = ("customer_id string, first_name string, last_name string, email string, phone string, "
                   "address_line1 string, city string, state string, postal_code string, date_of_birth string, "
                   "gender string, customer_since string, segment string, created_at string, updated_at string")
AGENT_SCHEMA = ("agent_id string, first_name string, last_name string, email string, branch string, region string, "
                "state string, hire_date string, status string, commission_rate string, updated_at string")
POLICY_STATES = ("ACTIVE", "CANCELLED", "LAPSED", "PENDING")
LOOKUPS = ("ref_us_states", "ref_peril_codes", "ref_claim_status")
AS_OF = "2026-04-01"


class GateFailed(Exception):
    """The quality gate stopped the publication of gold."""


@dataclass
class RunResult:
    tables: dict = field(default_factory=dict)
    scorecard: DataFrame | None = None
    reconciliation: DataFrame | None = None
    loaded_files: dict = field(default_factory=dict)


def _path(root, layer, name):
    return f"{root.rstrip('/')}/{layer}/{name}"


def bronze(spark: SparkSession, landing: str, root: str) -> dict:
    """Ledgered, idempotent loads of every landing folder; lookups replaced."""
    loaded = {}
    schemas = {"customers": CUSTOMER_SCHEMA, "agents": AGENT_SCHEMA}
    for name, fmt in FORMATS.items():
        src = f"{landing.rstrip('/')}/{name}"
        if exists(spark, src):
            loaded[name] = ingest.copy_into(spark, src, _path(root, "bronze", name), fmt, _path(root, "_ledger", name),
                                            schema=schemas.get(name), glob=f"*.{fmt}")
    for name in LOOKUPS:
        sinks.write_snapshot(spark, files.read_csv_batch(spark, f"{landing.rstrip('/')}/reference/{name}"), _path(root, "bronze", name))
    return loaded


class Silver:
    """Writes each cleaned, flagged table once and derives the rest."""

    def __init__(self, spark: SparkSession, root: str, run_ts: str):
        self.spark, self.root, self.run_ts = spark, root, run_ts
        self.tables: dict[str, DataFrame] = {}
        self.cards: list[DataFrame] = []
        self.counts: list[DataFrame] = []

    def source(self, name: str) -> DataFrame | None:
        path = _path(self.root, "bronze", name)
        if not exists(self.spark, path):
            return None
        return self.spark.read.option("mergeSchema", True).parquet(path).drop("_load")

    def lookup(self, name: str) -> DataFrame:
        return sinks.read_snapshot(self.spark, _path(self.root, "bronze", name))

    def split(self, name: str, ingested: DataFrame, rows: DataFrame, rules) -> DataFrame:
        """Flag and store ``rows``; register passed rows, quarantine and
        scorecard row; returns the passed rows."""
        path = _path(self.root, "work", f"{name}-{uuid.uuid4().hex}")
        K.flag_rules(rows, rules).write.parquet(path)
        flagged = self.spark.read.parquet(path)
        bad = F.size("_dq_failed_rules") > 0
        self.tables[name] = flagged.where(~bad).drop("_dq_failed_rules", "_dq_reason")
        self.tables[f"{name}_quarantine"] = flagged.where(bad)
        card = K.scorecard_of_flagged(flagged, name, rules, self.run_ts)
        self.cards.append(card)
        self.counts.append(ingested.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("ingested")))
        return self.tables[name]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def silver(spark: SparkSession, root: str, run_ts: str) -> tuple[dict, DataFrame, DataFrame]:
    """(tables, scorecard, reconciliation) of one run."""
    w = Silver(spark, root, run_ts)

    # customers: exact copies, text, dates, state lookup, newest per key
    raw = w.source("customers")
    c = drop_exact_duplicates(raw).select(
        "customer_id", normalize_text("first_name", "title").alias("first_name"),
        normalize_text("last_name", "title").alias("last_name"), F.lower(F.trim("email")).alias("email"), "phone",
        normalize_text("city", "title").alias("city"), F.upper(F.trim("state")).alias("state"), "postal_code",
        parse_date("date_of_birth").alias("date_of_birth"), parse_date("customer_since").alias("customer_since"),
        "segment", parse_timestamp("updated_at").alias("updated_at"), "_source_file", "_ingest_ts")
    c = validate_category(latest_per_key(c, "customer_id", ["updated_at"]), "state", w.lookup("ref_us_states"), "state_code", "_bad_state")
    customers = w.split("customers", raw, c.drop("_bad_state"), [
        ("email_present", F.col("email").isNotNull()), ("state_valid", F.col("state").isNotNull()),
        ("dob_parsed", F.col("date_of_birth").isNotNull())])

    # policies: status typos, money, dates, orphans against customers
    raw = w.source("policies")
    p = raw.select(
        "policy_id", "customer_id", "agent_id", "product_line",
        map_category("status", POLICY_STATUS_FIXES, POLICY_STATES).alias("status"),
        parse_date("effective_date").alias("effective_date"), parse_date("expiration_date").alias("expiration_date"),
        parse_money("annual_premium").alias("annual_premium"), F.col("sum_insured").cast("double").alias("sum_insured"),
        "payment_frequency", "coverages", "vehicle", "property")
    p = split_fk(p, customers.select("customer_id"), "customer_id")
    policies = w.split("policies", raw, p, [
        ("customer_exists", F.col("_fk_ok")), ("status_valid", F.col("status").isNotNull()),
        ("premium_non_negative", F.col("annual_premium") >= 0), ("effective_parsed", F.col("effective_date").isNotNull())])
    w.tables["policy_coverages"] = explode_lines(policies, "policy_id", "coverages")
    w.tables["policies"] = policies.drop("_fk_ok", "coverages")

    # claims: tokens, status lookup, dates, orphans, loss within the sum insured
    raw = w.source("claims")
    states = [r.status_code for r in w.lookup("ref_claim_status").select("status_code").collect()]  # a handful of codes
    cl = drop_exact_duplicates(raw).select(
        "claim_id", "policy_id", "customer_id", parse_date("loss_date").alias("loss_date"),
        parse_date("claim_date").alias("claim_date"), "peril_code",
        map_category("claim_status", CLAIM_STATUS_FIXES, states).alias("claim_status"),
        F.col("reported_amount").cast("double").alias("reported_amount"), F.col("loss_amount").cast("double").alias("loss_amount"),
        F.col("paid_amount").cast("double").alias("paid_amount"), parse_bool("fraud_flag").alias("fraud_flag"))
    cl = cl.join(w.tables["policies"].select("policy_id", "sum_insured"), "policy_id", "left")
    claims = w.split("claims", raw, cl, [
        ("policy_exists", F.col("sum_insured").isNotNull()), ("status_valid", F.col("claim_status").isNotNull()),
        ("loss_within_limit", F.col("loss_amount") <= F.col("sum_insured")),
        ("fraud_flag_parsed", F.col("fraud_flag").isNotNull())])
    w.tables["claims"] = claims.drop("sum_insured")

    # payments: negative amounts quarantined
    raw = w.source("payments")
    pay = raw.select("payment_id", "policy_id", "installment_no", F.to_date("due_date").alias("due_date"),
                     F.to_date("paid_date").alias("paid_date"), "amount_due", "amount_paid", "status")
    w.split("payments", raw, pay, [("amount_non_negative", F.col("amount_due") >= 0)])

    # telematics: event time, valid speed, one row per event id
    raw = w.source("telematics")
    if raw is not None:
        tm = latest_per_key(raw.withColumn("event_ts", parse_timestamp("event_ts")), "event_id", ["_ingest_ts"])
        w.split("telematics", raw, tm, [("speed_valid", F.col("speed_kmh").between(0, 300)), ("time_parsed", F.col("event_ts").isNotNull())])

    # agents: SCD2 over the bronze history
    a = w.source("agents").select(
        "agent_id", normalize_text("first_name", "title").alias("first_name"),
        normalize_text("last_name", "title").alias("last_name"), "email",
        normalize_text("branch", "title").alias("branch"), F.initcap(F.trim("region")).alias("region"),
        "state", F.upper(F.trim("status")).alias("status"),
        F.col("commission_rate").try_cast("double").alias("commission_rate"),
        parse_timestamp("updated_at").alias("updated_at"))
    tracked = AGENT_TRACKED
    prev = sinks.read_snapshot(spark, _path(root, "silver", "dim_agent"))
    w.tables["dim_agent"] = scd2_seed(a, "agent_id", tracked, "updated_at") if prev is None else \
        scd2_apply(prev, a, "agent_id", tracked, "updated_at")

    return w.tables, *_reconciled(w.cards, w.counts, run_ts)


def silver_hops(spark: SparkSession, root: str) -> dict[str, Hop]:
    """The incremental form of :func:`silver`: its cleaning and rules, one
    hop a table, parents first."""
    states = sinks.read_snapshot(spark, _path(root, "bronze", "ref_us_states"))
    status = [r.status_code for r in sinks.read_snapshot(spark, _path(root, "bronze", "ref_claim_status")).select("status_code").collect()]
    loads = "/_load=*"

    def customers(df: DataFrame, *carry: str) -> DataFrame:
        c = df.select(
            "customer_id", normalize_text("first_name", "title").alias("first_name"),
            normalize_text("last_name", "title").alias("last_name"), F.lower(F.trim("email")).alias("email"), "phone",
            normalize_text("city", "title").alias("city"), F.upper(F.trim("state")).alias("state"), "postal_code",
            parse_date("date_of_birth").alias("date_of_birth"), parse_date("customer_since").alias("customer_since"),
            "segment", parse_timestamp("updated_at").alias("updated_at"), "_source_file", "_ingest_ts", *carry)
        return validate_category(c, "state", states, "state_code", "_bad_state").drop("_bad_state")

    def policies(df: DataFrame, *carry: str) -> DataFrame:
        return df.select(
            "policy_id", "customer_id", "agent_id", "product_line", map_category("status", POLICY_STATUS_FIXES, POLICY_STATES).alias("status"),
            parse_date("effective_date").alias("effective_date"), parse_date("expiration_date").alias("expiration_date"),
            parse_money("annual_premium").alias("annual_premium"), F.col("sum_insured").cast("double").alias("sum_insured"),
            "payment_frequency", "coverages", "vehicle", "property", *carry)

    def claims(df: DataFrame, *carry: str) -> DataFrame:
        amounts = [F.col(c).cast("double").alias(c) for c in ("reported_amount", "loss_amount", "paid_amount")]
        return df.select(
            "claim_id", "policy_id", "customer_id", parse_date("loss_date").alias("loss_date"), parse_date("claim_date").alias("claim_date"),
            "peril_code", map_category("claim_status", CLAIM_STATUS_FIXES, status).alias("claim_status"), *amounts,
            parse_bool("fraud_flag").alias("fraud_flag"), *carry)

    def payments(df: DataFrame, *carry: str) -> DataFrame:
        return df.select("payment_id", "policy_id", "installment_no", F.to_date("due_date").alias("due_date"),
                         F.to_date("paid_date").alias("paid_date"), "amount_due", "amount_paid", "status", *carry)

    def telematics(df: DataFrame, *carry: str) -> DataFrame:
        return df.withColumn("event_ts", parse_timestamp("event_ts"))

    def agents(df: DataFrame, *carry: str) -> DataFrame:
        return df.select(
            "agent_id", normalize_text("first_name", "title").alias("first_name"), normalize_text("last_name", "title").alias("last_name"),
            "email", normalize_text("branch", "title").alias("branch"), F.initcap(F.trim("region")).alias("region"), "state",
            F.upper(F.trim("status")).alias("status"), F.col("commission_rate").try_cast("double").alias("commission_rate"),
            parse_timestamp("updated_at").alias("updated_at"), *carry)

    out = {}
    out["customers"] = Hop("customers", customers, [
        ("email_present", F.col("email").isNotNull()), ("state_valid", F.col("state").isNotNull()),
        ("dob_parsed", F.col("date_of_birth").isNotNull())], folders=loads, newest=("customer_id", "updated_at"))
    out["policies"] = Hop("policies", policies, [
        ("customer_exists", F.col("_fk_ok")), ("status_valid", F.col("status").isNotNull()),
        ("premium_non_negative", F.col("annual_premium") >= 0), ("effective_parsed", F.col("effective_date").isNotNull())],
        folders=loads, parents=[Parent(out["customers"], "customer_id", "_fk_ok")])
    out["claims"] = Hop("claims", claims, [
        ("policy_exists", F.col("sum_insured").isNotNull()), ("status_valid", F.col("claim_status").isNotNull()),
        ("loss_within_limit", F.col("loss_amount") <= F.col("sum_insured")), ("fraud_flag_parsed", F.col("fraud_flag").isNotNull())],
        folders=loads, parents=[Parent(out["policies"], "policy_id", "_policy_ok", ("sum_insured",))], distinct=True)
    out["payments"] = Hop("payments", payments, [("amount_non_negative", F.col("amount_due") >= 0)], folders=loads)
    out["telematics"] = Hop("telematics", telematics, [
        ("speed_valid", F.col("speed_kmh").between(0, 300)), ("time_parsed", F.col("event_ts").isNotNull())],
        folders=loads, newest=("event_id", "_ingest_ts"))
    out["agents"] = Hop("agents", agents, [], folders=loads)
    return {n: h for n, h in out.items() if exists(spark, _path(root, "bronze", n))}


AGENT_TRACKED = ["first_name", "last_name", "email", "branch", "region", "state", "status", "commission_rate"]


def silver_incremental(spark: SparkSession, root: str, run_ts: str) -> tuple[dict, DataFrame, DataFrame]:
    """(tables, scorecard, reconciliation) after taking in what is new in
    bronze. ``dim_agent`` is the next snapshot (published here), the other
    tables are views."""
    store = HopStore(spark, f"{root.rstrip('/')}/bronze", f"{root.rstrip('/')}/hops")
    hops = silver_hops(spark, root)
    tables, cards, counts = {}, [], []
    for name, hop in hops.items():
        store.run(hop)
        if name == "agents":
            continue
        tables[name], tables[f"{name}_quarantine"] = store.passed(hop), store.quarantined(hop)
        cards.append(K.scorecard_of_flagged(store.view(hop), name, hop.rules, run_ts))
        counts.append(spark.createDataFrame([(name, store.ingested(hop))], "table_name string, ingested long"))
    tables["policy_coverages"] = explode_lines(tables["policies"], "policy_id", "coverages")
    tables["policies"] = tables["policies"].drop("coverages")

    # agents: only the new rows meet the current dimension; doing it twice changes nothing
    mark = _path(root, "silver", "_agents_taken")
    taken = int(read_text(spark, mark) or -1)
    new, dim = store.log(hops["agents"], taken), sinks.read_snapshot(spark, _path(root, "silver", "dim_agent"))
    if new is not None:
        dim = scd2_seed(new, "agent_id", AGENT_TRACKED, "updated_at") if dim is None else scd2_apply(dim, new, "agent_id", AGENT_TRACKED, "updated_at")
        sinks.write_snapshot(spark, dim, _path(root, "silver", "dim_agent"))
        replace_text(spark, mark, str(store.batches(hops["agents"])[-1]))
    tables["dim_agent"] = sinks.read_snapshot(spark, _path(root, "silver", "dim_agent"))
    return tables, *_reconciled(cards, counts, run_ts)


def _reconciled(cards: list[DataFrame], counts: list[DataFrame], run_ts: str) -> tuple[DataFrame, DataFrame]:
    """Scorecard, and counts: what de-duplication removed is the difference,
    shown and not negative."""
    scorecard = _union(cards)
    rows = _union(counts).join(scorecard.select("table_name", "passed", "quarantined"), "table_name").withColumn(
        "deduplicated", F.col("ingested") - F.col("passed") - F.col("quarantined"))
    return scorecard, rows.withColumn("reconciled", F.col("deduplicated") >= 0).withColumn("run_ts", F.lit(run_ts).cast("timestamp"))


def gate(scorecard: DataFrame, reconciliation: DataFrame, max_quarantine_rate: float = 0.5) -> DataFrame:
    """K10 before publication: quarantine shares and reconciliation."""
    rows = K.scorecard_view(scorecard).join(reconciliation.select("table_name", "reconciled"), "table_name")
    return K.dq_gate(rows, [K.Check("quarantine_rate", F.col("quarantine_rate") > max_quarantine_rate),
                            K.Check("rows_reconciled", ~F.col("reconciled"))])


def gold(spark: SparkSession, s: dict, states: DataFrame, perils: DataFrame, scorecard: DataFrame) -> dict:
    """The 15 gold objects from silver."""
    cust = s["customers"].withColumn("name", F.concat_ws(" ", "first_name", "last_name")).drop("customer_since").join(
        states.select(F.col("state_code").alias("state"), "region"), "state", "left")
    pol = s["policies"]
    dim_pol = marts.dim_policy(pol, cust, s["policy_coverages"].select("policy_id", F.col("limit").cast("double").alias("limit_amount")))
    dim_cust = marts.dim_customer(cust, pol, AS_OF)
    dim_agent = s["dim_agent"].where("is_current").withColumn("agent_name", F.concat_ws(" ", "first_name", "last_name"))
    fp = marts.fact_premium(pol, cust)
    fc = marts.fact_claims(s["claims"], dim_pol, perils.select("peril_code", "peril_name"))
    fpay = marts.fact_payments(s["payments"])
    out = {
        "dim_date": marts.dim_date(date_spine(spark, "2018-01-01", "2027-12-31")),
        "dim_customer": dim_cust, "dim_policy": dim_pol, "dim_agent": dim_agent,
        "fact_premium": fp, "fact_claims": fc, "fact_payments": fpay,
        "agg_loss_ratio": marts.agg_loss_ratio(fc, fp),
        "agg_claims_monthly": marts.agg_claims_monthly(fc, fp),
        "agg_agent_performance": marts.agg_agent_performance(pol, fc, dim_agent),
        "agg_customer_value": marts.agg_customer_value(dim_cust, pol, fc),
        "fraud_monthly": marts.fraud_monthly(fc),
        "billing_leakage": marts.billing_leakage(fpay),
        "dq_scorecard": K.scorecard_view(scorecard),
    }
    if "telematics" in s:
        trips = s["telematics"].withColumns({c: F.col(c).cast("boolean") for c in ("harsh_brake", "harsh_accel", "harsh_corner")})
        out["agg_telematics_risk"] = marts.agg_telematics_risk(
            trips, fc, {"harsh_brake": 1.0, "harsh_accel": 1.0, "harsh_corner": 1.0}, distance="mileage", speed="speed_kmh")
    return out


def _publish(spark: SparkSession, root: str, layer: str, tables: dict) -> dict:
    for name, df in tables.items():
        sinks.write_snapshot(spark, df, _path(root, layer, name))
    return {n: sinks.read_snapshot(spark, _path(root, layer, n)) for n in tables}


def run(spark: SparkSession, landing: str, root: str, run_ts: str, max_quarantine_rate: float = 0.5) -> RunResult:
    """Land -> bronze -> silver -> gate -> gold. Scorecard and
    reconciliation rows are appended in every run; a failed gate raises
    :class:`GateFailed` and leaves the published gold as it was."""
    res = RunResult(loaded_files=bronze(spark, landing, root))
    s, scorecard, counts = silver_incremental(spark, root, run_ts)
    scorecard.write.mode("append").parquet(_path(root, "ops", "dq_scorecard"))
    counts.write.mode("append").parquet(_path(root, "ops", "reconciliation"))
    res.scorecard = spark.read.parquet(_path(root, "ops", "dq_scorecard"))
    res.reconciliation = spark.read.parquet(_path(root, "ops", "reconciliation"))
    this = F.col("run_ts") == F.lit(run_ts).cast("timestamp")
    failed = gate(res.scorecard.where(this), res.reconciliation.where(this), max_quarantine_rate).where("status = 'FAIL' AND check <> 'ALL'")
    names = [r["check"] for r in failed.select("check").collect()]  # at most one row a check
    if names:
        raise GateFailed(", ".join(names))
    look = {n: sinks.read_snapshot(spark, _path(root, "bronze", n)) for n in LOOKUPS}
    g = _publish(spark, root, "gold", gold(spark, s, look["ref_us_states"], look["ref_peril_codes"], res.scorecard))
    res.tables = {**{f"silver.{k}": v for k, v in s.items()}, **{f"gold.{k}": v for k, v in g.items()}}
    return res
