"""Queries: data quality (K1-K14) on the orders table.

Rules are checked on derived dirty columns (NULLs and bad values made from
the clean columns inside the query), so every rule has real failures.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.dates import parse_date
from strata.functions import dirt
from strata.operators import quality as K
from strata.plans.registry import query
from strata.plans.star import Star

# Derived dirty view of orders, identical in both engines.
DIRTY_SQL = """
d AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate,
             CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS premium,
             CASE WHEN o_orderkey % 29 = 0 THEN -o_totalprice ELSE o_totalprice END AS premium_signed,
             CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS priority
      FROM orders)"""

RULES_SQL = {
    "premium_present": "coalesce(premium > 1000, false)",
    "premium_positive": "coalesce(premium_signed >= 0, false)",
    "priority_known": "coalesce(priority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'), false)",
    "date_in_range": "coalesce(o_orderdate < TIMESTAMP '2001-01-01', false)",
}


def dirty_orders(t):
    k = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        F.when(F.pmod(k, F.lit(13)) == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("premium"),
        F.when(F.pmod(k, F.lit(29)) == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("premium_signed"),
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"),
    )


def rules():
    return [
        ("premium_present", F.col("premium") > 1000),
        ("premium_positive", F.col("premium_signed") >= 0),
        ("priority_known", F.col("priority").isin("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
        ("date_in_range", F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")),
    ]


ALL = " AND ".join(RULES_SQL.values())
REASON = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT {c} THEN '{n}' END" for n, c in RULES_SQL.items()) + ")"


@query("expectations_passed", f"WITH {DIRTY_SQL} SELECT o_orderkey FROM d WHERE {ALL}")
def expectations_passed(t):
    """K1: rows passing every rule (a NULL condition fails)."""
    passed, _ = K.apply_expectations(dirty_orders(t), rules())
    return passed.select("o_orderkey")


@query("expectations_quarantined", f"WITH {DIRTY_SQL} SELECT o_orderkey, {REASON} AS _dq_reason FROM d WHERE NOT ({ALL})")
def expectations_quarantined(t):
    """K1/K2/K5: the rest, with the names of the violated rules."""
    _, q = K.apply_expectations(dirty_orders(t), rules())
    return q.select("o_orderkey", "_dq_reason")


@query("expectations_none", "SELECT count(*) AS total, count(*) AS passed FROM orders")
def expectations_none(t):
    """K1 edge: no rules -> everything passes."""
    return K.expectation_counts(t.orders, [])


COUNTS_SQL = f"WITH {DIRTY_SQL} SELECT count(*) AS total, count(*) FILTER (WHERE {ALL}) AS passed, " + \
    ", ".join(f"count(*) FILTER (WHERE NOT {c}) AS failed_{n}" for n, c in RULES_SQL.items()) + " FROM d"


@query("expect_counts", COUNTS_SQL)
def expect_counts(t):
    """K3/K4 ``expect`` (warn): all rows kept, per-rule counts in one pass."""
    _, counts = K.expect(dirty_orders(t), dict(rules()), "warn")
    return counts


@query("expect_or_drop", f"WITH {DIRTY_SQL} SELECT o_orderkey, premium FROM d WHERE {ALL}")
def expect_or_drop(t):
    """K3/K4 ``expect_or_drop``."""
    rows, _ = K.expect(dirty_orders(t), dict(rules()), "drop")
    return rows.select("o_orderkey", "premium")


def _runs(t):
    """Each order year is one load (run) of the orders table; lineitem and
    customer checks are single runs. Run time = the newest date in it."""
    d = dirty_orders(t).withColumn("run", F.year("o_orderdate"))
    return d


SCORE_SQL = f"""
WITH {DIRTY_SQL},
r AS (SELECT *, year(o_orderdate) AS run FROM d),
sc AS (SELECT 'orders' AS table_name, run, count(*) FILTER (WHERE {ALL}) AS passed,
              count(*) FILTER (WHERE NOT ({ALL})) AS quarantined, count(*) AS ingested,
              CAST(max(o_orderdate) AS TIMESTAMP) AS run_ts
       FROM r GROUP BY run
       UNION ALL
       SELECT 'lineitem', 0, count(*) FILTER (WHERE coalesce(l_discount <= 0.08, false)), count(*) FILTER (WHERE NOT coalesce(l_discount <= 0.08, false)),
              count(*), CAST(max(l_shipdate) AS TIMESTAMP) FROM lineitem)"""


def _scorecard(t):
    d = _runs(t)
    # every run of the orders table is scored in one grouped pass
    per_run = d.groupBy("run").agg(
        F.lit("orders").alias("table_name"),
        F.count_if(K.all_pass(rules())).alias("passed"),
        F.count_if(~K.all_pass(rules())).alias("quarantined"),
        F.count(F.lit(1)).alias("ingested"),
        F.max("o_orderdate").cast("timestamp").alias("run_ts"),
    )
    li_rules = [("discount_sane", F.col("l_discount") <= 0.08)]
    li = K.scorecard_row(t.lineitem, "lineitem", li_rules, t.lineitem.agg(F.max("l_shipdate").cast("timestamp")).scalar())
    li = li.select("table_name", F.lit(0).alias("run"), "passed", "quarantined",
                   (F.col("passed") + F.col("quarantined")).alias("ingested"), "run_ts")
    return per_run.select("table_name", "run", "passed", "quarantined", "ingested", "run_ts").unionByName(li)


@query("scorecard", SCORE_SQL + "\nSELECT table_name, passed, quarantined, run_ts FROM sc")
def scorecard(t):
    """K6: one row per (table, run)."""
    return _scorecard(t).select("table_name", "passed", "quarantined", "run_ts")


@query("scorecard_rules", f"""
WITH {DIRTY_SQL}
SELECT 'orders' AS table_name, rule, failed FROM (
  SELECT {', '.join(f"count(*) FILTER (WHERE NOT {c}) AS {n}" for n, c in RULES_SQL.items())} FROM d)
UNPIVOT (failed FOR rule IN ({', '.join(RULES_SQL)}))""")
def scorecard_rules(t):
    """K6: per-rule failure counts (the scorecard's map, long form)."""
    row = K.scorecard_row(dirty_orders(t), "orders", rules(), "2024-01-01 00:00:00")
    return K.scorecard_rules(row).select("table_name", "rule", "failed")


@query("scorecard_latest", SCORE_SQL + f"""
SELECT table_name, passed, quarantined, {'CAST(quarantined AS DOUBLE) / NULLIF(CAST(passed + quarantined AS DOUBLE), 0)'} AS quarantine_rate, run_ts
FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY run_ts DESC) rn FROM sc) WHERE rn = 1""")
def scorecard_latest(t):
    """K7/F2: latest run per table with its quarantine rate."""
    return K.scorecard_view(_scorecard(t))


@query("reconcile", SCORE_SQL + "\nSELECT table_name, run_ts, ingested, passed, quarantined, passed + quarantined = ingested AS reconciled FROM sc")
def reconcile(t):
    """K8: passed + quarantined = ingested per table and run (NULL rules
    included)."""
    sc = _scorecard(t)
    ing = sc.select("table_name", "run_ts", "ingested")
    return K.reconcile(ing, sc.drop("ingested")).select("table_name", "run_ts", "ingested", "passed", "quarantined", "reconciled")


@query("freshness", """
SELECT 'events' AS source, CAST(max(ts) AS TIMESTAMP) AS newest FROM events
UNION ALL SELECT 'orders', CAST(max(o_orderdate) AS TIMESTAMP) FROM orders
UNION ALL SELECT 'lineitem', CAST(max(l_shipdate) AS TIMESTAMP) FROM lineitem""")
def freshness(t):
    """K9: newest record time per source."""
    parts = [
        t.events.select(F.lit("events").alias("source"), F.col("ts").alias("_t")),
        t.orders.select(F.lit("orders").alias("source"), F.col("o_orderdate").alias("_t")),
        t.lineitem.select(F.lit("lineitem").alias("source"), F.col("l_shipdate").alias("_t")),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return K.freshness(u, "_t", "source", "newest")


GATE_SQL = """
WITH g AS (
  SELECT count(*) FILTER (WHERE coalesce(l_extendedprice <= 0, true)) AS non_positive_amount,
         count(*) FILTER (WHERE coalesce(l_discount > 0.1, true)) AS discount_over_cap,
         count(*) FILTER (WHERE coalesce(l_shipdate > TIMESTAMP '2001-06-30', true)) AS shipped_after_cutoff
  FROM lineitem),
per AS (SELECT "check", failed_rows, CASE WHEN failed_rows <= 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM g UNPIVOT (failed_rows FOR "check" IN (non_positive_amount, discount_over_cap, shipped_after_cutoff)))
SELECT * FROM per UNION ALL
SELECT 'ALL', CAST(sum(failed_rows) AS BIGINT), CASE WHEN max(failed_rows) <= 0 THEN 'PASS' ELSE 'FAIL' END FROM per"""


@query("dq_gate", GATE_SQL)
def dq_gate(t):
    """Publication gate: failing rows per check and PASS / FAIL."""
    li = t.lineitem
    checks = [
        K.Check("non_positive_amount", F.col("l_extendedprice") <= 0),
        K.Check("discount_over_cap", F.col("l_discount") > 0.1),
        K.Check("shipped_after_cutoff", F.col("l_shipdate") > F.lit("2001-06-30").cast("timestamp_ntz")),
    ]
    return K.dq_gate(li, checks)


@query("orphan_facts", """
WITH d AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT count(*) AS orphans FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM d)""")
def orphan_facts(t):
    """Orders (facts of the premium side) without coverage lines."""
    return K.orphan_facts(t.orders.select("o_orderkey"), t.lineitem.select("l_orderkey"), ("o_orderkey", "l_orderkey"))


@query("parse_rate", """
WITH r AS (
  SELECT CASE WHEN o_orderkey % 6 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
              WHEN o_orderkey % 6 = 1 THEN strftime(o_orderdate, '%d-%m-%Y')
              WHEN o_orderkey % 6 = 2 THEN strftime(CAST(o_orderdate AS DATE) + INTERVAL 60 MONTH, '%Y-%m-%d')
              WHEN o_orderkey % 6 = 3 THEN 'not_a_date'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw,
         o_orderkey % 6 <> 3 AS ok, o_orderpriority FROM orders)
SELECT o_orderpriority, count(raw) AS raw_values, count(*) FILTER (WHERE ok) AS parsed_values,
       CAST(count(*) FILTER (WHERE ok) AS DOUBLE) / NULLIF(CAST(count(raw) AS DOUBLE), 0) AS parse_rate
FROM r GROUP BY o_orderpriority""")
def parse_rate(t):
    """Share of raw dates that parsed, per product line."""
    o = t.orders.select("o_orderpriority", dirt.date_text("o_orderdate", F.pmod("o_orderkey", F.lit(6))).alias("raw"))
    o = o.withColumn("parsed", parse_date("raw"))
    return K.parse_rate(o, "raw", "parsed", "o_orderpriority")


@query("unique_key", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def unique_key(t):
    """Duplicate business keys."""
    return K.unique_key(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("grain_check", """
WITH fp AS (SELECT o_orderkey FROM orders)
SELECT (SELECT count(*) FROM orders) AS rows, (SELECT count(DISTINCT o_orderkey) FROM orders) AS distinct_grain,
       (SELECT count(*) FROM orders) = (SELECT count(DISTINCT o_orderkey) FROM orders) AS grain_ok""")
def grain_check(t):
    """The policy dimension holds one row per policy after its joins
    (customer, coverage rollup): no fan-out."""
    dp = Star(t).dim_policy
    return K.grain_check(dp, ["policy_id"])
