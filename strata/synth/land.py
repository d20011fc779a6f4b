"""Landing files and the manifest (Y19, Y20) and the initial generation."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.synth import config as C
from strata.synth import defects as D
from strata.synth import entities as E

# Rows per landed file and format per source.
ROWS_PER_FILE = {"customers": 25_000, "agents": 1_500, "policies": 20_000, "claims": 20_000,
                 "payments": 250_000, "telematics": 150_000}
FORMATS = {"customers": "csv", "agents": "csv", "policies": "json", "claims": "json",
           "payments": "parquet", "telematics": "json"}


def land(df: DataFrame, path: str, fmt: str, rows_per_file: int) -> None:
    """Write ``df`` as many files of at most ``rows_per_file`` rows.
    Policies keep their nested coverages (JSON lines); CSV gets a header."""
    w = df.drop("_n").write.mode("append").option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def manifest(spark: SparkSession, path: str, frames: dict[str, DataFrame], extra: dict | None = None) -> dict:
    """Counts and id ranges per source, one small JSON document
    (one aggregate per source; only the counts reach the driver)."""
    out = dict(extra or {})
    for name, df in frames.items():
        r = df.agg(F.count(F.lit(1)).alias("rows"), F.min("_n").alias("lo"), F.max("_n").alias("hi")).first() \
            if "_n" in df.columns else df.agg(F.count(F.lit(1)).alias("rows")).first()
        out[name] = r.asDict()
    spark.createDataFrame([(json.dumps(out, default=str),)], "manifest string").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "_manifest"))
    return out


def land_reference(spark: SparkSession, root: str) -> None:
    """The lookup files ``<root>/reference/<name>/`` (CSV): states with their
    region, perils, claim states, regions by first postal digit."""
    tables = {
        "ref_us_states": ("state_code string, region string", [(s, r) for r, states in C.REGION_STATES.items() for s in states]),
        "ref_peril_codes": ("peril_code string, peril_name string, product_line string",
                            [(p, p.title(), line) for line, codes in (("AUTO", C.AUTO_PERILS), ("PROPERTY", C.PROPERTY_PERILS)) for p in codes]),
        "ref_claim_status": ("status_code string", [(s,) for s in C.CLAIM_STATES]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").option("header", True).csv(os.path.join(root, "reference", name))


def generate_initial(spark: SparkSession, root: str, cfg: C.GenConfig | None = None) -> dict:
    """Generate every source with its defects and land it under
    ``<root>/<source>/``; returns the manifest."""
    cfg = cfg or C.GenConfig()
    cust = E.gen_customers(spark, cfg)
    agt = E.gen_agents(spark, cfg)
    pol = E.gen_policies(spark, cfg)
    clm = E.gen_claims(spark, cfg, pol)
    pay = E.gen_payments(pol, cfg)
    evt = E.gen_events(spark, cfg, pol)
    frames = {
        "customers": D.dirty_customers(cust, cfg),
        "agents": D.dirty_agents(agt, cfg),
        "policies": D.dirty_policies(pol, cfg),
        "claims": D.dirty_claims(clm, cfg),
        "payments": D.dirty_payments(pay, cfg),
        "telematics": D.dirty_events(evt, cfg),
    }
    for name, df in frames.items():
        land(df, os.path.join(root, name), FORMATS[name], ROWS_PER_FILE[name])
    land_reference(spark, root)
    return manifest(spark, root, {"customers": cust, "agents": agt, "policies": pol, "claims": clm, "telematics": evt},
                    {"seed": cfg.seed})


def generate_delta(spark: SparkSession, root: str, batch: int, cfg: C.GenConfig | None = None, **sizes) -> None:
    """Land delta batch ``batch`` (updates, new rows, drift in batch 2)."""
    cfg = cfg or C.GenConfig()
    cust = E.gen_customers(spark, cfg)
    agt = E.gen_agents(spark, cfg)
    pol = E.gen_policies(spark, cfg)
    parts = E.gen_delta(spark, cfg, batch, cust, agt, pol,
                        sizes.get("customers", 300), sizes.get("agents", 20), sizes.get("policies", 200),
                        sizes.get("claims", 150), sizes.get("events", 2000))
    for name, df in parts.items():
        land(df, os.path.join(root, name), FORMATS[name], ROWS_PER_FILE[name])
