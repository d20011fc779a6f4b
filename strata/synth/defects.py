"""Seeded defects on generated entities (Y9-Y17) and duplicates (Y14,
Y15). Every decision is a hash of (seed, defect, column, row id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import dirt
from strata.synth import config as C


def _pick(seed: int, what: str):
    return dirt.hash_pick(seed, what, "_n")


def inject_nulls(df: DataFrame, cols, rate: float, seed: int) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, dirt.inject_nulls(c, _pick(seed, f"null.{c}"), rate))
    return df


def inject_casing(df: DataFrame, col: str, rate: float, seed: int) -> DataFrame:
    return df.withColumn(col, dirt.inject_casing(col, _pick(seed, f"case.{col}"), rate))


def inject_invalid_category(df: DataFrame, col: str, pool, rate: float, seed: int) -> DataFrame:
    return df.withColumn(col, dirt.inject_invalid_category(col, _pick(seed, f"cat.{col}"), pool, rate))


def inject_numeric_as_string(df: DataFrame, col: str, rate: float, seed: int) -> DataFrame:
    return df.withColumn(col, dirt.inject_numeric_as_string(col, _pick(seed, f"num.{col}"), rate))


def corrupt_dates(df: DataFrame, col: str, rate: float, seed: int) -> DataFrame:
    return df.withColumn(col, dirt.corrupt_dates(col, _pick(seed, f"date.{col}"), rate))


def inject_orphans(df: DataFrame, col: str, prefix: str, width: int, base: int, rate: float, seed: int) -> DataFrame:
    p = _pick(seed, f"orphan.{col}")
    orphan = F.concat(F.lit(prefix), F.lpad((F.lit(base) + p).cast("string"), width, "0"))
    return df.withColumn(col, F.when(dirt.hit(p, rate), orphan).otherwise(F.col(col)))


def inject_out_of_range(df: DataFrame, col: str, rate: float, seed: int, mode: str = "negate") -> DataFrame:
    return df.withColumn(col, dirt.inject_out_of_range(col, _pick(seed, f"range.{col}"), rate, mode))


def append_exact_duplicates(df: DataFrame, rate: float, seed: int) -> DataFrame:
    """A ``rate`` share of rows appears twice."""
    return df.unionByName(df.where(dirt.hit(_pick(seed, "dup.exact"), rate)))


def append_fuzzy_duplicates(df: DataFrame, rate: float, seed: int, cols) -> DataFrame:
    """A ``rate`` share of rows appears again with the same key and
    re-cased / re-spaced text in ``cols``."""
    extra = df.where(dirt.hit(_pick(seed, "dup.fuzzy"), rate))
    for c in cols:
        extra = extra.withColumn(c, dirt.casing_variant(c, F.pmod(_pick(seed, f"fuzzy.{c}"), F.lit(4))))
    return df.unionByName(extra)


def dirty_customers(df: DataFrame, cfg: C.GenConfig) -> DataFrame:
    r, s = cfg.rates, cfg.seed
    df = inject_nulls(df, ["email", "phone"], r["null"], s)
    df = inject_casing(df, "city", r["casing"], s)
    df = inject_invalid_category(df, "state", C.INVALID_STATES, r["category"], s)
    df = corrupt_dates(df, "date_of_birth", r["date"], s)
    df = append_exact_duplicates(df, r["exact_dup"], s)
    return append_fuzzy_duplicates(df, r["fuzzy_dup"], s, ["first_name", "last_name"])


def dirty_policies(df: DataFrame, cfg: C.GenConfig) -> DataFrame:
    r, s = cfg.rates, cfg.seed
    df = inject_orphans(df, "customer_id", "CUST", 8, 90_000_000, r["orphan"], s)
    df = inject_invalid_category(df, "status", C.POLICY_STATUS_TYPOS, r["category"], s)
    df = corrupt_dates(df, "effective_date", r["date"], s)
    df = inject_out_of_range(df, "annual_premium", r["range"], s, "negate")
    return inject_numeric_as_string(df, "annual_premium", r["numeric_as_string"], s)


def dirty_claims(df: DataFrame, cfg: C.GenConfig) -> DataFrame:
    r, s = cfg.rates, cfg.seed
    df = inject_orphans(df, "policy_id", "POL", 9, 900_000_000, r["orphan"], s)
    df = inject_nulls(df, ["peril_code", "reported_amount"], r["null"], s)
    df = inject_invalid_category(df, "claim_status", C.CLAIM_STATUS_TYPOS, r["category"], s)
    df = corrupt_dates(df, "claim_date", r["date"], s)
    df = inject_out_of_range(df, "loss_amount", r["range"], s, "over")
    return append_exact_duplicates(df, r["exact_dup"], s)


def dirty_payments(df: DataFrame, cfg: C.GenConfig) -> DataFrame:
    # payments carry no _n; derive one from the id for the hash
    d = df.withColumn("_n", F.xxhash64("payment_id"))
    return inject_out_of_range(d, "amount_due", cfg.rates["range"], cfg.seed, "negate").drop("_n")


def dirty_agents(df: DataFrame, cfg: C.GenConfig) -> DataFrame:
    df = inject_nulls(df, ["email"], cfg.rates["null"], cfg.seed)
    return inject_casing(df, "branch", cfg.rates["casing"], cfg.seed)


def dirty_events(df: DataFrame, cfg: C.GenConfig) -> DataFrame:
    r, s = cfg.rates, cfg.seed
    df = inject_nulls(df, ["speed_kmh"], r["null"], s)
    return inject_out_of_range(df, "speed_kmh", r["range"], s, "speed")
