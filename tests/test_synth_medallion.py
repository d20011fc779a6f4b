"""Generator (determinism, defects, drift) and the landing -> gold run."""

import os

import pytest
from pyspark.sql import functions as F

from strata.synth import config as C
from strata.synth import defects as D
from strata.synth import entities as E
from strata.synth.land import generate_delta, generate_initial

CFG = C.GenConfig(seed=42, customers=3000, agents=60, policies=2500, claims=1200, events=3000)


def rows(df):
    return sorted(tuple(r) for r in df.drop("_n").collect())


def test_determinism_across_partitions_and_seeds(spark):
    a = E.gen_customers(spark, CFG, n=800)
    b = E.gen_customers(spark, CFG, n=800).repartition(8)
    assert rows(a) == rows(b)
    other = E.gen_customers(spark, C.GenConfig(seed=1), n=800)
    assert rows(a) != rows(other)


def test_defect_rates_within_4_sigma(spark):
    cust = E.gen_customers(spark, CFG)
    dirty = D.dirty_customers(cust, CFG).cache()
    n = CFG.customers
    import math

    def within(count, rate, base):
        mu, sd = rate * base, math.sqrt(base * rate * (1 - rate))
        return abs(count - mu) <= 4 * sd + 1

    assert within(dirty.where("email IS NULL").count(), 0.02, n * 1.018)
    assert within(dirty.count() - n, 0.018, n)  # exact + fuzzy copies
    assert within(dirty.where(~F.col("state").isin(*[s for v in C.REGION_STATES.values() for s in v])).count(), 0.03, n * 1.018)
    assert dirty.where("date_of_birth = 'not_a_date'").count() > 0


def test_policies_nested_and_payments(spark):
    pol = E.gen_policies(spark, CFG)
    sizes = [r[0] for r in pol.select(F.size("coverages")).collect()]
    assert min(sizes) >= 1 and max(sizes) <= 4
    uniq = pol.select(F.size(F.array_distinct(F.transform("coverages", lambda c: c["coverage_code"]))).alias("u"),
                      F.size("coverages").alias("n")).where("u <> n").count()
    assert uniq == 0
    assert pol.where("annual_premium < 150").count() == 0
    pay = E.gen_payments(pol, CFG)
    k = {"ANNUAL": 1, "SEMI_ANNUAL": 2, "QUARTERLY": 4, "MONTHLY": 12}
    want = sum(k[r.payment_frequency] for r in pol.select("payment_frequency").collect())
    assert pay.count() == want


def test_drift_column_only_in_drift_batch(spark, tmp):
    pol = E.gen_policies(spark, CFG)
    assert "device_fw" not in E.gen_events(spark, CFG, pol, n=100).columns
    assert "device_fw" in E.gen_events(spark, CFG, pol, n=100, drift=True).columns


def test_medallion_run(spark, tmp):
    from strata.plans.medallion import GateFailed, run

    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "lake")
    m = generate_initial(spark, landing, CFG)
    assert m["customers"]["rows"] == CFG.customers
    for src in ("customers", "agents", "policies", "claims", "payments", "telematics"):
        assert os.listdir(os.path.join(landing, src))
    r1 = run(spark, landing, root, "2026-04-01 00:00:00")
    sc = r1.scorecard.collect()
    assert {x.table_name for x in sc} >= {"customers", "policies", "claims", "payments", "telematics"}
    assert all(x.passed + x.quarantined > 0 for x in sc)
    assert r1.tables["gold.agg_loss_ratio"].count() > 0
    assert r1.tables["gold.dim_date"].count() == 3652
    fp = r1.tables["gold.fact_premium"]
    assert fp.count() == fp.select("policy_id", "month_key").distinct().count()
    assert len([t for t in r1.tables if t.startswith("gold.")]) == 15
    assert r1.tables["gold.dim_customer"].where("age_band IS NOT NULL AND region IS NOT NULL").count() > 0
    assert r1.tables["gold.fact_claims"].where("peril_name IS NOT NULL AND claim_date_key IS NOT NULL").count() > 0
    assert r1.tables["gold.agg_telematics_risk"].where("harsh_score > 0").count() > 0
    rec = {x.table_name: x for x in r1.reconciliation.collect()}
    assert all(x.reconciled for x in rec.values()) and rec["customers"].deduplicated > 0
    # a failed gate raises and leaves the published gold as it was
    with pytest.raises(GateFailed):
        run(spark, landing, root, "2026-04-01 12:00:00", max_quarantine_rate=0.0)
    # a second run over the same landing (as a URI) loads nothing new
    r2 = run(spark, "file://" + landing, "file://" + root, "2026-04-02 00:00:00")
    assert all(v == 0 for v in r2.loaded_files.values())
    # a delta with agent changes opens new SCD2 versions
    generate_delta(spark, landing, 2, CFG, agents=20)
    run(spark, landing, root, "2026-04-03 00:00:00")
    from strata.sources.sinks import read_snapshot

    dim = read_snapshot(spark, os.path.join(root, "silver", "dim_agent"))
    assert dim.where("is_current").groupBy("agent_id").count().where("count > 1").count() == 0
    assert dim.where("NOT is_current").count() > 0
    bt = spark.read.option("mergeSchema", True).parquet(os.path.join(root, "bronze", "telematics"))
    assert "device_fw" in bt.columns


def test_land_rows_per_file_and_manifest(spark, tmp):
    """At most ``rows_per_file`` rows per landed file; the
    manifest holds counts and id ranges."""
    import glob
    import json

    from strata.synth.land import land, manifest

    cust = E.gen_customers(spark, CFG, n=350)
    land(cust, os.path.join(tmp, "c"), "csv", 100)
    files = glob.glob(os.path.join(tmp, "c", "*.csv"))
    assert len(files) >= 4
    assert all(sum(1 for _ in open(f)) - 1 <= 100 for f in files)  # header + rows
    m = manifest(spark, tmp, {"customers": cust})
    assert m["customers"] == {"rows": 350, "lo": 1, "hi": 350}
    text = spark.read.text(os.path.join(tmp, "_manifest")).first()[0]
    assert json.loads(text)["customers"]["rows"] == 350


def test_incremental_silver_equals_one_pass(spark, tmp):
    """Three arrivals (a delta brings changed customers, policies of new and
    old customers, claims) give what one pass over all of bronze gives; a run
    without new files reads nothing."""
    from strata.plans import medallion as M

    landing, root = os.path.join(tmp, "landing"), os.path.join(tmp, "lake")
    generate_initial(spark, landing, CFG)
    for batch in (None, 2, 3):
        if batch:
            generate_delta(spark, landing, batch, CFG, agents=10)
        M.bronze(spark, landing, root)
        tables, card, counts = M.silver_incremental(spark, root, "2026-04-01 00:00:00")
    whole, whole_card, whole_counts = M.silver(spark, root, "2026-04-01 00:00:00")
    for name in ("policies", "claims", "payments", "policies_quarantine", "claims_quarantine", "payments_quarantine"):
        cols = [c for c, k in whole[name].dtypes if c in tables[name].columns and not k.startswith(("array<struct", "struct"))]
        a, b = whole[name].select(cols), tables[name].select(cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    key = lambda df: sorted((r.table_name, r.passed, r.quarantined, r.per_rule) for r in df.collect())
    assert [r for r in key(card) if r[0] != "customers"] == [r for r in key(whole_card) if r[0] != "customers"]
    rows = lambda df: {r.table_name: r.ingested for r in df.collect()}
    assert rows(counts) == rows(whole_counts)
    assert tables["customers"].count() == whole["customers"].count()
    store, hops = M.HopStore(spark, f"{root}/bronze", f"{root}/hops"), M.silver_hops(spark, root)
    assert all(store.run(h) == 0 for h in hops.values())
