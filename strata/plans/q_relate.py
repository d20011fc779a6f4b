"""Queries: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.numbers import exact_sum
from strata.operators import joins as J
from strata.operators.scd import scd2_history, scd2_seed
from strata.plans.registry import query
from strata.plans.sql import xsum

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("join_inner", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_inner(t):
    """Lines whose order resolves."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return J.join_inner(t.lineitem.select(*LINE_KEYS), o, ("l_orderkey", "o_orderkey")).drop("o_orderkey")


@query("join_lookup", """
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""")
def join_lookup(t):
    """Left join to small lookups (nation, region: fixed size)."""
    nr = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    out = J.lookup(t.customer.select("c_custkey", "c_nationkey"), nr, ("c_nationkey", "n_nationkey"), bounded=True)
    return out.select("c_custkey", "n_name", "r_name")


@query("join_anti_orphans", """
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def join_anti_orphans(t):
    """Policies (orders) with no coverage line: anti join."""
    return J.orphans(t.orders.select("o_orderkey", "o_custkey"), t.lineitem.select("l_orderkey"), ("o_orderkey", "l_orderkey"))


@query("orphan_customers", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def orphan_customers(t):
    """Customers without any policy."""
    return J.orphans(t.customer.select("c_custkey"), t.orders.select("o_custkey"), ("c_custkey", "o_custkey"))


@query("join_multi_key", f"""
WITH ps AS (SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey, {xsum('l_quantity')} AS pair_quantity, count(*) AS pair_lines
            FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, pair_quantity, pair_lines
FROM lineitem JOIN ps ON l_partkey = ps_partkey AND l_suppkey = ps_suppkey""")
def join_multi_key(t):
    """C4: join on (part, supplier)."""
    ps = t.lineitem.groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).agg(
        exact_sum("l_quantity").alias("pair_quantity"), F.count(F.lit(1)).alias("pair_lines"))
    out = J.join_multi_key(t.lineitem.select(*LINE_KEYS), ps, [("l_partkey", "ps_partkey"), ("l_suppkey", "ps_suppkey")])
    return out.drop("ps_partkey", "ps_suppkey")


@query("join_cross", """
SELECT o_orderkey, scenario, o_totalprice * CASE scenario WHEN 'base' THEN 1.0 WHEN 'stress' THEN 1.25 ELSE 0.8 END AS premium
FROM orders, (VALUES ('base'), ('stress'), ('relief')) s(scenario)""")
def join_cross(t):
    """C5 (re-aimed): scenario fan-out by exploding a literal list; no
    Cartesian join."""
    o = J.fan_out(t.orders.select("o_orderkey", "o_totalprice"), "scenario", ["base", "stress", "relief"])
    factor = F.when(F.col("scenario") == "base", 1.0).when(F.col("scenario") == "stress", 1.25).otherwise(0.8)
    return o.select("o_orderkey", "scenario", (F.col("o_totalprice") * factor).alias("premium"))


@query("join_range_months", """
SELECT o_orderkey, CAST(m AS DATE) AS month FROM (
  SELECT o_orderkey, unnest(generate_series(
     CASE WHEN day(CAST(o_orderdate AS DATE)) = 1 THEN CAST(o_orderdate AS DATE)
          ELSE CAST(date_trunc('month', CAST(o_orderdate AS DATE)) + INTERVAL 1 MONTH AS DATE) END,
     CAST(date_trunc('month', CAST(o_orderdate AS DATE) + 120) AS DATE), INTERVAL 1 MONTH)) AS m
  FROM orders)""")
def join_range_months(t):
    """Theta join "month start between start and start + 120 days",
    as a per-row generator (no nested loop)."""
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("s"))
    o = o.withColumn("e", F.date_add("s", 120))
    return J.range_join_months(o, "s", "e", "month").select("o_orderkey", "month")


@query("join_star", f"""
SELECT n_name, p_type, o_orderpriority, count(*) AS lines, {xsum('l_extendedprice')} AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
GROUP BY n_name, p_type, o_orderpriority""")
def join_star(t):
    """Fact (lines) to four dimensions, fact first; the nation lookup is
    fixed-size (broadcast), the others are left to AQE by runtime size."""
    fact = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    dims = [
        (t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), ("l_orderkey", "o_orderkey"), "inner"),
        (t.customer.select("c_custkey", "c_nationkey"), ("o_custkey", "c_custkey"), "inner"),
        (F.broadcast(t.nation.select("n_nationkey", "n_name")), ("c_nationkey", "n_nationkey"), "inner"),
        (t.part.select("p_partkey", "p_type"), ("l_partkey", "p_partkey"), "inner"),
    ]
    s = J.star_join(fact, dims)
    return s.groupBy("n_name", "p_type", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum("l_extendedprice").alias("revenue"))


@query("aggregate_then_join", f"""
WITH a AS (SELECT o_custkey AS customer_id, count(*) AS orders, {xsum('o_totalprice')} AS ordered FROM orders GROUP BY o_custkey),
b AS (SELECT o_custkey AS customer_id, count(*) AS returned_lines, {xsum('l_extendedprice')} AS returned
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY o_custkey)
SELECT customer_id, coalesce(orders, 0) AS orders, coalesce(ordered, 0.0) AS ordered,
       coalesce(returned_lines, 0) AS returned_lines, coalesce(returned, 0.0) AS returned
FROM a FULL OUTER JOIN b USING (customer_id)""")
def aggregate_then_join(t):
    """Two facts aggregated to the customer grain, then joined."""
    a = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("ordered"))
    r = t.lineitem.where(F.col("l_returnflag") == "R").join(t.orders.select("o_orderkey", "o_custkey"),
                                                            F.col("l_orderkey") == F.col("o_orderkey"))
    b = r.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("returned_lines"), exact_sum("l_extendedprice").alias("returned"))
    out = J.aggregate_then_join(a, b, "customer_id")
    return out.na.fill({"orders": 0, "ordered": 0.0, "returned_lines": 0, "returned": 0.0})


def user_versions(t, where=None):
    e = t.events if where is None else t.events.where(where)
    return scd2_history(e.select("user_id", "event_type", "ts", "event_id"), "user_id", ["event_type"], "ts",
                        tie_break=["event_id"])


@query("join_current", """
WITH cur AS (SELECT user_id, event_type AS current_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)
SELECT event_id, user_id, current_type FROM events LEFT JOIN cur USING (user_id)""")
def join_current(t):
    """Every event joined to its user's *current* SCD2 version only."""
    dim = user_versions(t).select("user_id", F.col("event_type").alias("current_type"), "is_current")
    return J.join_current(t.events.select("event_id", "user_id"), dim, "user_id").select("event_id", "user_id", "current_type")


@query("join_as_of", """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
o AS (SELECT user_id, ts, event_type FROM events WHERE event_type <> 'purchase')
SELECT p.event_id, p.user_id, o.event_type AS state_at_purchase
FROM p ASOF LEFT JOIN o ON p.user_id = o.user_id AND p.ts >= o.ts""")
def join_as_of(t):
    """Each purchase with the user's state (SCD2 version built from the
    other events) in force at the purchase time."""
    versions = user_versions(t, F.col("event_type") != "purchase")
    facts = t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    out = J.join_as_of(facts, versions.select("user_id", "effective_from", "effective_to", "event_type"),
                       "user_id", "ts", attrs=["event_type"])
    return out.select("event_id", "user_id", F.col("event_type").alias("state_at_purchase"))


CUT = "2024-01-15 00:00:00"

CHANGED_SQL = f"""
WITH s AS (SELECT user_id, event_type, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    WHERE ts >= TIMESTAMP '{CUT}') WHERE rn = 1),
c AS (SELECT user_id, event_type AS old_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    WHERE ts < TIMESTAMP '{CUT}') WHERE rn = 1)
SELECT s.user_id, s.event_type, s.ts, c.old_type FROM s JOIN c USING (user_id) WHERE s.event_type <> c.old_type"""


@query("changed_rows", CHANGED_SQL)
def changed_rows(t):
    """C11: keys whose newest row after the cut differs from the version
    current before it (hash compare after an inner join)."""
    cut = F.lit(CUT).cast("timestamp_ntz")
    e = t.events.select("user_id", "event_type", "ts", "event_id")
    dim = scd2_seed(e.where(F.col("ts") < cut), "user_id", ["event_type"], "ts", tie_break=["event_id"])
    src = scd2_seed(e.where(F.col("ts") >= cut), "user_id", ["event_type"], "ts", tie_break=["event_id"])
    src = src.select("user_id", "event_type", F.col("effective_from").cast("timestamp_ntz").alias("ts"), "_hash")
    ch = J.changed_rows(src, dim.select("user_id", "_hash", F.col("event_type").alias("old_type")), "user_id")
    cur = dim.select("user_id", F.col("event_type").alias("old_type"))
    return ch.join(cur, "user_id").select("user_id", "event_type", "ts", "old_type")


@query("join_salted", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_salted(t):
    """The same join with every key spread over 16 salts."""
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return J.salted_join(t.lineitem.select(*LINE_KEYS), o, "l_orderkey", n=16, row_id=LINE_KEYS)


@query("join_salted_hot", f"""
SELECT o_orderpriority, count(*) AS lines, {xsum('l_extendedprice')} AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def join_salted_hot(t):
    """C12 on a hot key: every line joined to its order priority (5 keys for
    all rows, so each key holds about a fifth of them)."""
    o = t.orders.select("o_orderkey", "o_orderpriority")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    prio = o.select("o_orderpriority").distinct().withColumn("w", F.lit(1))
    j = J.salted_join(lines, prio, "o_orderpriority", n=16, row_id=LINE_KEYS)
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), exact_sum("l_extendedprice").alias("revenue"))


@query("split_fk", """
SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS _fk_ok FROM orders""")
def split_fk(t):
    """Valid / orphan in one pass."""
    return J.split_fk(t.orders.select("o_orderkey"), t.lineitem.select("l_orderkey"), ("o_orderkey", "l_orderkey"))
