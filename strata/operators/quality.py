"""Data quality: expectations, quarantine, scorecard, gate.

A rule is a ``(name, Column)`` pair whose Column is TRUE when the row
passes. A NULL condition counts as a failure (trap 2), so
``passed + quarantined = ingested`` always holds. All counts for all rules
come from one aggregate pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numbers import safe_ratio
from strata.operators._util import as_list

Rule = tuple  # (name, Column)


class ExpectationFailed(Exception):
    """Raised by ``expect_or_fail`` before anything is written."""


def _rules(rules) -> list[Rule]:
    if isinstance(rules, dict):
        return list(rules.items())
    return list(rules or [])


def flag_rules(df: DataFrame, rules) -> DataFrame:
    """K2: adds ``_dq_failed_rules`` (names of violated rules, in rule
    order) and ``_dq_reason`` (the same, comma separated)."""
    rules = _rules(rules)
    if not rules:
        return df.withColumn("_dq_failed_rules", F.array().cast("array<string>")).withColumn("_dq_reason", F.lit(None).cast("string"))
    failed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]),
                      lambda x: x.isNotNull())
    out = df.withColumn("_dq_failed_rules", failed)
    return out.withColumn("_dq_reason", F.when(F.size("_dq_failed_rules") > 0, F.concat_ws(",", "_dq_failed_rules")))


def all_pass(rules) -> Column:
    rules = _rules(rules)
    if not rules:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for _, c in rules])


def apply_expectations(df: DataFrame, rules) -> tuple[DataFrame, DataFrame]:
    """K1: ``(passed, quarantined)``; a row passes only when every rule is
    TRUE; no rules -> everything passes. The quarantined frame carries
    ``_dq_failed_rules`` and ``_dq_reason``. When both are written, cache or
    checkpoint ``df`` first so the source is read once."""
    rules = _rules(rules)
    passed = df.where(all_pass(rules))
    quarantined = flag_rules(df.where(~all_pass(rules)), rules)
    return passed, quarantined


def expectation_counts(df: DataFrame, rules) -> DataFrame:
    """One-row frame: ``total``, ``passed``, ``failed_<rule>`` per rule, in
    a single aggregate pass."""
    rules = _rules(rules)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(all_pass(rules)).alias("passed"),
        *[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"failed_{n}") for n, c in rules],
    )


def expect(df: DataFrame, rules, action: str = "warn") -> tuple[DataFrame, DataFrame]:
    """K3/K4: ``warn`` keeps every row, ``drop`` keeps passing rows,
    ``fail`` raises :class:`ExpectationFailed` when any row fails (checked
    with one aggregate before the caller writes). Returns
    ``(rows, counts)``."""
    counts = expectation_counts(df, rules)
    if action == "warn":
        return df, counts
    if action == "drop":
        return df.where(all_pass(rules)), counts
    if action == "fail":
        row = counts.first()
        if row["passed"] != row["total"]:
            bad = {k[len("failed_"):]: v for k, v in row.asDict().items() if k.startswith("failed_") and v}
            raise ExpectationFailed(f"expectations failed: {bad}")
        return df, counts
    raise ValueError(action)


def expect_all(df, rules: dict):
    return expect(df, rules, "warn")


def expect_all_or_drop(df, rules: dict):
    return expect(df, rules, "drop")


def expect_all_or_fail(df, rules: dict):
    return expect(df, rules, "fail")


def quarantine(df: DataFrame, reason) -> DataFrame:
    """K5: mark rows for the ``<table>_quarantine`` sink with ``_dq_reason``."""
    r = reason if isinstance(reason, Column) else F.lit(reason)
    return df.withColumn("_dq_reason", r)


def scorecard_row(df: DataFrame, table_name: str, rules, run_ts) -> DataFrame:
    """K6: one row (table_name, passed, quarantined, per_rule map, run_ts)
    from one aggregate pass over the checked frame."""
    rules = _rules(rules)
    per_rule = F.create_map(*[x for n, c in rules for x in (F.lit(n), F.count_if(~F.coalesce(c, F.lit(False))))]) \
        if rules else F.create_map().cast("map<string,bigint>")
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")
    return df.agg(
        F.lit(table_name).alias("table_name"),
        F.count_if(all_pass(rules)).alias("passed"),
        F.count_if(~all_pass(rules)).alias("quarantined"),
        per_rule.alias("per_rule"),
        ts.alias("run_ts"),
    )


def scorecard_of_flagged(flagged: DataFrame, table_name: str, rules, run_ts) -> DataFrame:
    """K6 from rows that :func:`flag_rules` marked and that were stored
    once: the same row as :func:`scorecard_row`, without evaluating the rules
    again."""
    names = [n for n, _ in _rules(rules)]
    bad = F.size("_dq_failed_rules") > 0
    per_rule = F.create_map(*[x for n in names for x in (F.lit(n), F.count_if(F.array_contains("_dq_failed_rules", n)))]) \
        if names else F.create_map().cast("map<string,bigint>")
    return flagged.agg(F.lit(table_name).alias("table_name"), F.count_if(~bad).alias("passed"), F.count_if(bad).alias("quarantined"),
                       per_rule.alias("per_rule"), F.lit(run_ts).cast("timestamp").alias("run_ts"))


def scorecard_rules(scorecard: DataFrame) -> DataFrame:
    """Long form of the per-rule map: (table_name, run_ts, rule, failed)."""
    return scorecard.select("table_name", "run_ts", F.explode("per_rule").alias("rule", "failed"))


def scorecard_view(scorecard: DataFrame) -> DataFrame:
    """K7/F2: latest run per table with ``quarantine_rate = q / (p + q)``.
    The scorecard has one row per (table, run), so the window is small."""
    w = Window.partitionBy("table_name").orderBy(F.col("run_ts").desc())
    latest = scorecard.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return latest.select("table_name", "passed", "quarantined",
                         safe_ratio("quarantined", F.col("passed") + F.col("quarantined")).alias("quarantine_rate"),
                         "run_ts")


def reconcile(ingested: DataFrame, scorecard: DataFrame) -> DataFrame:
    """K8: ``passed + quarantined = ingested`` per (table, run).
    ``ingested`` has (table_name, run_ts, ingested)."""
    j = ingested.join(scorecard.select("table_name", "run_ts", "passed", "quarantined"), ["table_name", "run_ts"], "full")
    return j.withColumn("reconciled", F.coalesce(F.col("passed") + F.col("quarantined") == F.col("ingested"), F.lit(False)))


def freshness(df: DataFrame, ts_col: str, by=None, name: str = "newest") -> DataFrame:
    """K9: newest timestamp (e.g. ``_ingest_ts``) per source."""
    return df.groupBy(*as_list(by)).agg(F.max(ts_col).alias(name))


@dataclass
class Check:
    name: str
    failing: Column  # TRUE for a row that violates the check


def dq_gate(df: DataFrame, checks: list[Check], max_failed: int = 0) -> DataFrame:
    """One aggregate pass counts the failing rows of every check;
    returns (check, failed_rows, status) plus an overall row ``ALL``."""
    agg = df.agg(*[F.count_if(F.coalesce(c.failing, F.lit(True))).alias(c.name) for c in checks])
    pairs = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(c.name).alias("failed_rows")) for c in checks])
    per = agg.select(F.inline(pairs))
    per = per.withColumn("status", F.when(F.col("failed_rows") <= max_failed, "PASS").otherwise("FAIL"))
    overall = per.agg(F.lit("ALL").alias("check"), F.sum("failed_rows").alias("failed_rows"),
                      F.when(F.max(F.col("failed_rows")) <= max_failed, "PASS").otherwise("FAIL").alias("status"))
    return per.unionByName(overall)


def orphan_facts(fact: DataFrame, dim: DataFrame, key, name: str = "orphans") -> DataFrame:
    """Number of fact rows whose key has no dimension row (expect 0)."""
    from strata.operators.joins import orphans

    return orphans(fact, dim, key).agg(F.count(F.lit(1)).alias(name))


def parse_rate(df: DataFrame, raw: str, parsed: str, by=None) -> DataFrame:
    """Share of non-NULL raw values that parsed."""
    return df.groupBy(*as_list(by)).agg(
        F.count(raw).alias("raw_values"),
        F.count_if(F.col(raw).isNotNull() & F.col(parsed).isNotNull()).alias("parsed_values"),
        safe_ratio(F.count_if(F.col(raw).isNotNull() & F.col(parsed).isNotNull()), F.count(raw)).alias("parse_rate"),
    )


def unique_key(df: DataFrame, key) -> DataFrame:
    """Keys present more than once (expect none)."""
    return df.groupBy(*as_list(key)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def grain_check(df: DataFrame, grain, expected=None) -> DataFrame:
    """Rows vs distinct grain values (equal when the grain holds);
    catches join fan-out. ``expected`` optionally gives the row count the
    grain should have (a one-row frame with column ``expected``)."""
    out = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_distinct(*[F.col(c) for c in as_list(grain)]).alias("distinct_grain"))
    out = out.withColumn("grain_ok", F.col("rows") == F.col("distinct_grain"))
    if expected is not None:
        out = out.withColumn("expected", expected.scalar())
        out = out.withColumn("grain_ok", F.col("grain_ok") & (F.col("rows") == F.col("expected")))
    return out
