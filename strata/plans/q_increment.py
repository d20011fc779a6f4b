"""Queries: tables that are kept up to date batch by batch (J7, J8, L8, L13, L15, S8),
stored sketches (E3, E5) and interval joins (C6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import intervals, sketches
from strata.operators.scd import ChangeSpec
from strata.plans import model
from strata.plans.hops import Hop, Parent, Silver
from strata.plans.kept import KeptMarts
from strata.plans.q_marts import LOSS_RATIO_SQL
from strata.plans.registry import query
from strata.plans.sql import PAYMENTS, with_, xsum
from strata.sources.ingest import file_stream
from strata.sources.keyed import KeyedTable
from strata.sources.sinks import move_path
from strata.streaming.cdc import apply_changes_keyed
from strata.streaming.runs import run_dir

ARRIVALS = 3


def silver_hops() -> tuple[Hop, Hop]:
    """Customers (newest row counts, balance not negative) and the orders
    that refer to them."""
    customers = Hop("customers", lambda df, *carry: df.select("c_custkey", "c_acctbal", "c_nationkey", "sent", *carry),
                    [("balance_not_negative", F.col("c_acctbal") >= 0)], "c_custkey bigint, c_nationkey int, c_acctbal double, sent int",
                    newest=(["c_custkey"], ["sent"]))
    orders = Hop("orders", lambda df, *carry: df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", *carry),
                 [("customer_exists", F.col("has_customer")), ("price_in_range", F.col("o_totalprice") < 250000),
                  ("same_region_limit", ~F.coalesce((F.col("c_nationkey") < 3) & (F.col("o_totalprice") > 200000), F.lit(False)))],
                 "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string",
                 parents=[Parent(customers, ("o_custkey", "c_custkey"), "has_customer", ("c_nationkey",))], distinct=True)
    return customers, orders


@query("silver_incremental_three_batches", """
WITH c AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal >= 0),
f AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, array_to_string(list_filter([
    CASE WHEN c.c_custkey IS NULL THEN 'customer_exists' END, CASE WHEN NOT o_totalprice < 250000 THEN 'price_in_range' END,
    CASE WHEN coalesce(c_nationkey < 3 AND o_totalprice > 200000, false) THEN 'same_region_limit' END], lambda x: x IS NOT NULL), ',') AS failed
  FROM orders LEFT JOIN c ON o_custkey = c.c_custkey)
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, failed, true AS bronze_read_once FROM f""")
def silver_incremental_three_batches(t):
    """Orders and customers arrive in three parts, orders often
    before their customer; every tenth customer comes with a good balance first
    and the true one last, and orders are sent twice. Passed and quarantined
    rows together, as one run over everything gives them."""
    root = run_dir(t.spark, "silver-hops")
    third = lambda key: F.pmod(F.col(key), F.lit(ARRIVALS))
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    early = c.where("c_custkey % 10 = 0").withColumn("c_acctbal", F.abs("c_acctbal")).withColumns({"sent": F.lit(0), "part": F.lit(0)})
    true = c.withColumns({"sent": F.lit(1), "part": F.when(F.col("c_custkey") % 10 == 0, ARRIVALS - 1).otherwise(third("c_custkey")).cast("int")})
    early.unionByName(true).write.partitionBy("part").parquet(f"{root}/staging/customers")
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    again = o.where("o_orderkey % 50 = 0").withColumn("part", F.lit(ARRIVALS - 1))
    o.withColumn("part", third("o_orderkey").cast("int")).unionByName(again).write.partitionBy("part").parquet(f"{root}/staging/orders")
    silver = Silver(t.spark, f"{root}/bronze", f"{root}/silver")
    customers, orders = silver_hops()
    read = 0
    for hop in (customers, orders):
        hop.folders = "/in=*"
    for n in range(ARRIVALS):
        for hop in (customers, orders):
            move_path(t.spark, f"{root}/staging/{hop.name}/part={n}", f"{root}/bronze/{hop.name}/in={n}")
            read += silver.run(hop)
    sent = t.customer.agg(F.count(F.lit(1)) + F.count_if(F.col("c_custkey") % 10 == 0)).scalar() + t.orders.agg(
        F.count(F.lit(1)) + F.count_if(F.col("o_orderkey") % 50 == 0)).scalar()
    rows = silver.passed(orders).withColumn("failed", F.lit("")).unionByName(
        silver.quarantined(orders).withColumn("failed", F.array_join("_dq_failed_rules", ",")).drop("_dq_failed_rules", "_dq_reason"))
    return rows.withColumn("bronze_read_once", F.lit(read) == sent)


def _changes(df, deleted=False):
    return df.withColumn("_deleted", F.lit(deleted))


def loss_ratio_batches(t) -> list[dict]:
    """Three batches that end in the given tables: late and corrected
    customers (their state), policies and claims, and rows that come and are
    deleted again."""
    cust = model.customers(t).select("customer_id", "state")
    pol = model.policies(t).select("policy_id", "customer_id", "product_line", "effective_date", "expiration_date", "annual_premium")
    cl = model.claims(t).select("claim_id", "policy_id", "loss_date", "loss_amount", "part_key")
    wrong_state = F.col("customer_id") % 7 == 0
    late_cust, late_pol, late_claim = F.col("customer_id") % 5 == 0, F.col("policy_id") % 3 == 2, F.col("part_key") % 2 == 1
    wrong_pol, wrong_claim = F.col("policy_id") % 4 == 0, F.col("part_key") % 13 == 0
    bad_cust = cust.withColumn("state", F.when(wrong_state, "UNKNOWN").otherwise(F.col("state")))
    bad_pol = pol.withColumn("annual_premium", F.when(wrong_pol, F.col("annual_premium") * 2).otherwise(F.col("annual_premium"))).withColumn(
        "product_line", F.when(wrong_pol, "OLD").otherwise(F.col("product_line")))
    bad_claim = cl.withColumn("loss_amount", F.when(wrong_claim, F.col("loss_amount") + 10.25).otherwise(F.col("loss_amount")))
    extra_pol = pol.where("policy_id % 11 = 0").withColumn("policy_id", -1 - F.col("policy_id"))
    extra_claim = cl.where("part_key % 9 = 0").withColumn("claim_id", F.concat(F.lit("x"), "claim_id"))
    claims = lambda df, deleted=False: _changes(df.drop("part_key"), deleted)
    return [
        {"customers": _changes(bad_cust.where(~late_cust)), "policies": _changes(bad_pol.where(~late_pol).unionByName(extra_pol)),
         "claims": claims(bad_claim.where(~late_claim).unionByName(extra_claim))},
        {"customers": _changes(bad_cust.where(late_cust)), "policies": _changes(pol.where(late_pol | wrong_pol)), "claims": claims(bad_claim.where(late_claim))},
        {"customers": _changes(cust.where(wrong_state)), "policies": _changes(extra_pol, True),
         "claims": claims(cl.where(wrong_claim)).unionByName(claims(extra_claim, True))},
    ]


@query("loss_ratio_incremental", LOSS_RATIO_SQL)
def loss_ratio_incremental(t):
    """L8 kept up to date through inserts, corrections, deletes and
    customers that move; the last batch is sent twice."""
    marts = KeptMarts(t.spark, run_dir(t.spark, "kept-loss-ratio"), buckets=16)
    batches = loss_ratio_batches(t)
    for n, changes in enumerate(batches):
        marts.apply(n, changes)
    marts.apply(len(batches) - 1, batches[-1])
    return marts.loss_ratio()


@query("billing_leakage_incremental", with_(PAYMENTS) + f"""
SELECT month_key, {xsum('amount_due')} AS written, {xsum('coalesce(amount_paid, 0.0)')} AS collected,
  {xsum('CASE WHEN is_overdue THEN amount_due ELSE 0.0 END')} AS overdue_exposure, count(*) FILTER (WHERE is_overdue) AS overdue_installments,
  count(*) AS installments FROM fpay GROUP BY month_key""")
def billing_leakage_incremental(t):
    """L13 kept up to date: every fourth installment is open first and paid
    or missed later, some are cancelled again."""
    marts = KeptMarts(t.spark, run_dir(t.spark, "kept-billing"), buckets=16)
    pay = model.payments(t).select("payment_id", "due_date", "amount_due", "amount_paid", "status", "installment_no")
    open_first = F.col("installment_no") == 1
    first = pay.withColumns({"status": F.when(open_first, "PENDING").otherwise(F.col("status")),
                             "amount_paid": F.when(~open_first, F.col("amount_paid"))})
    extra = pay.where("installment_no = 2").withColumn("payment_id", F.concat(F.lit("x"), "payment_id"))
    cols = ["payment_id", "due_date", "amount_due", "amount_paid", "status"]
    marts.apply(0, {"payments": _changes(first.unionByName(extra).select(*cols))})
    marts.apply(1, {"payments": _changes(pay.where(open_first).select(*cols)).unionByName(_changes(extra.select(*cols), True))})
    return marts.billing_leakage()


@query("cdc_keyed_table", """
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status, true AS old_files_kept
FROM orders WHERE o_custkey % 5 <> 0""")
def cdc_keyed_table(t):
    """A stream of changes folded into a table of key buckets; each
    micro-batch writes the buckets of its keys only."""
    root = run_dir(t.spark, "cdc-keyed")
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"))
    feed = o.withColumns({"seq": F.lit(0), "op": F.lit("u"), "part": F.lit(0)})
    later = o.where("o_custkey % 7 = 0").withColumns({"status": F.lit("X"), "seq": F.lit(2), "op": F.lit("u"), "part": F.lit(1)})
    gone = o.where("o_custkey % 5 = 0").withColumns({"seq": F.lit(3), "op": F.lit("d"), "part": F.lit(1)})
    stale = o.where("o_custkey % 7 = 0").withColumns({"status": F.lit("S"), "seq": F.lit(1), "op": F.lit("u"), "part": F.lit(2)})
    one = o.where(F.col("o_orderkey") == t.orders.agg(F.min("o_orderkey")).scalar()).withColumns({"seq": F.lit(0), "op": F.lit("u"), "part": F.lit(3)})
    every = feed.unionByName(later).unionByName(gone).unionByName(stale).unionByName(one)
    every.write.partitionBy("part").parquet(f"{root}/staging")
    table = KeyedTable(t.spark, f"{root}/t", "o_orderkey", buckets=16)
    spec = ChangeSpec(keys=["o_orderkey"], sequence_by="seq", delete_when=F.col("op") == "d")
    stream = file_stream(t.spark, f"{root}/in/n=*", "parquet", every.drop("part").schema).drop("_source_file", "_ingest_ts")
    manifests = []
    for n in range(4):
        move_path(t.spark, f"{root}/staging/part={n}", f"{root}/in/n={n}")
        apply_changes_keyed(stream, table, f"{root}/ck", spec)
        manifests.append(table.current())
    before, after = manifests[-2:]  # the last batch holds one key
    kept = sum(before[b] == after[b] for b in before) >= len(before) - 1
    return table.rows().where("NOT _deleted").select("o_orderkey", "o_custkey", "status", F.lit(kept).alias("old_files_kept"))


_ROLL_UPS = [("month_flag", ["m", "l_returnflag"]), ("month", ["m"]), ("flag", ["l_returnflag"]), ("all", [])]


@query("distinct_rollups", """
WITH f AS (SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS m, l_returnflag FROM lineitem)
SELECT 'month_flag' AS grain, m, l_returnflag, count(*) AS rows, true AS within_bound FROM f GROUP BY ALL
UNION ALL SELECT 'month', m, NULL, count(*), true FROM f GROUP BY ALL
UNION ALL SELECT 'flag', NULL, l_returnflag, count(*), true FROM f GROUP BY ALL
UNION ALL SELECT 'all', NULL, NULL, count(*), true FROM f""")
def distinct_rollups(t):
    """Sketches of the distinct orders per month and return flag, stored
    once and rolled up to every grain; each estimate is within four standard
    errors of the exact count."""
    li = t.lineitem.select(F.expr("year(l_shipdate) * 100 + month(l_shipdate)").cast("int").alias("m"), "l_returnflag", "l_orderkey")
    path = f"{run_dir(t.spark, 'sketches')}/distinct"
    sketches.distinct_sketches(li, ["m", "l_returnflag"], "l_orderkey").write.parquet(path)
    stored, out = t.spark.read.parquet(path), None
    for grain, by in _ROLL_UPS:
        exact = li.groupBy(*by).agg(F.countDistinct("l_orderkey").alias("exact"))
        got = sketches.estimate(sketches.roll_up(stored, by))
        got = got.join(exact, by) if by else got.withColumn("exact", exact.scalar())
        near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * 0.01625 * F.col("exact"))
        part = got.select(F.lit(grain).alias("grain"), *[(F.col(c) if c in by else F.lit(None).cast(k)).alias(c) for c, k in (("m", "int"), ("l_returnflag", "string"))],
                          "rows", near.alias("within_bound"))
        out = part if out is None else out.unionByName(part)
    return out


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("profile_merged_loads", """
SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS column_name, (SELECT count(*) FROM lineitem) AS n, p AS probability, true AS within_bound
FROM (SELECT unnest([CAST(0.25 AS DOUBLE), 0.5, 0.75]) AS p)""")
def profile_merged_loads(t):
    """E5: quantile sketches of eight loads, merged into one profile: the
    rank of every quartile is within 3 % of what was asked for."""
    path = f"{run_dir(t.spark, 'sketches')}/quantiles"
    loads = t.lineitem.withColumn("load", F.pmod(F.xxhash64("l_orderkey"), F.lit(8)))
    sketches.quantile_sketches(loads, "load", _NUMBERS).write.parquet(path)
    found = sketches.profile_sketches(sketches.merge_quantiles(t.spark.read.parquet(path), _NUMBERS), _NUMBERS)
    long = t.lineitem.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in _NUMBERS])))
    counts = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("k"))  # equal values once
    rank = counts.join(F.broadcast(found.withColumnRenamed("value", "q")), "column_name").groupBy("column_name", "probability").agg(  # nine rows
        F.max("n").alias("n"), F.sum(F.when(F.col("v") < F.col("q"), F.col("k")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("q"), F.col("k")).otherwise(0)).alias("upto"))
    off = F.greatest(F.col("below") / F.col("n") - F.col("probability"), F.col("probability") - F.col("upto") / F.col("n"))
    return rank.select("column_name", "n", "probability", (off <= 0.03).alias("within_bound"))


_SPANS = """
WITH o AS (SELECT o_orderkey, o_custkey % 25 AS area, CAST(o_orderdate AS DATE) AS o_from, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS o_to, o_totalprice FROM orders),
p AS (SELECT p_partkey, p_partkey % 25 AS area, DATE '1995-01-01' + CAST(p_partkey % 2400 AS INTEGER) AS p_from,
  DATE '1995-01-01' + CAST(p_partkey % 2400 + CASE WHEN p_partkey % 50 = 0 THEN 1500 ELSE p_size END AS INTEGER) AS p_to FROM part)
"""


def _spans(t):
    day = lambda d: F.date_add(F.lit("1995-01-01").cast("date"), d.cast("int"))
    at = F.to_date("o_orderdate")
    o = t.orders.select("o_orderkey", (F.col("o_custkey") % 25).alias("area"), at.alias("o_from"), F.date_add(at, (F.col("o_orderkey") % 40).cast("int")).alias("o_to"), "o_totalprice")
    begin, length = F.col("p_partkey") % 2400, F.when(F.col("p_partkey") % 50 == 0, 1500).otherwise(F.col("p_size"))
    p = t.part.select("p_partkey", (F.col("p_partkey") % 25).alias("area"), day(begin).alias("p_from"), day(begin + length).alias("p_to"))
    return o, p


@query("interval_overlap", _SPANS + f"""
SELECT p_partkey, count(*) AS orders, {xsum('o_totalprice')} AS amount FROM p JOIN o ON p.area = o.area AND o_from <= p_to AND p_from <= o_to GROUP BY p_partkey""")
def interval_overlap(t):
    """Orders whose span of days overlaps a campaign of their area; one
    campaign in fifty lasts four years."""
    o, p = _spans(t)
    met = intervals.interval_join(p, o, ("p_from", "p_to"), ("o_from", "o_to"), on="area", how="totals", sums={"amount": "o_totalprice"}, count="orders")
    return met.groupBy("p_partkey").agg(F.sum("orders").alias("orders"), F.sum("amount").cast("double").alias("amount"))


@query("point_in_interval", _SPANS + """
SELECT o_orderkey, o_from, o_totalprice FROM o WHERE EXISTS (SELECT 1 FROM p WHERE p.area = o.area AND o_from BETWEEN p_from AND p_to)""")
def point_in_interval(t):
    """Orders placed during any campaign of their area."""
    o, p = _spans(t)
    return intervals.interval_join(o, p, ("o_from", "o_from"), ("p_from", "p_to"), on="area", how="left_semi").select("o_orderkey", "o_from", "o_totalprice")
