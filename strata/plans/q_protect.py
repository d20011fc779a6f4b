"""Queries: masks, row filters, tag policies (P1-P5) and key skew (Q3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.masks import mask_email, mask_hash, mask_phone, redact_emails
from strata.operators.layout import key_skew as key_skew_op
from strata.operators.protect import Caller, apply_policies, row_filter as row_filter_op
from strata.plans import model
from strata.plans.registry import query

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"


def _phone():
    return F.concat(F.lit("("), F.lpad((F.col("c_nationkey") + 200).cast("string"), 3, "0"), F.lit(") 555-"),
                    F.lpad(F.pmod("c_custkey", F.lit(10000)).cast("string"), 4, "0"))


@query("mask_contacts", f"""
SELECT doc_id, regexp_replace(e, '^.*@', '***@') AS masked_email, e AS clear_email
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL}')) AS e FROM documents)""")
def mask_contacts(t):
    """Every e-mail address found in the documents, masked for an
    unprivileged reader and clear for a privileged one."""
    text = F.col("text")
    d = t.documents.where(text.contains("@")).select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))).alias("email"))
    return d.select("doc_id", mask_email("email", False).alias("masked_email"), mask_email("email", True).alias("clear_email"))


@query("mask_phone", """
SELECT c_custkey, 'XXX-XXX-' || right('(' || lpad(CAST(c_nationkey + 200 AS VARCHAR), 3, '0') || ') 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0'), 4) AS phone,
       sha256(c_name) AS name_hash
FROM customer""")
def mask_phone_q(t):
    """Phone reduced to its last four digits; name hashed."""
    c = t.customer.select("c_custkey", "c_name", _phone().alias("phone"))
    return c.select("c_custkey", mask_phone("phone").alias("phone"), mask_hash("c_name").alias("name_hash"))


@query("redact_text", f"""
SELECT doc_id, regexp_replace(text, '[A-Za-z0-9._%+-]+@([A-Za-z0-9-]+\\.[A-Za-z0-9.-]+)', '***@\\1', 'g') AS text FROM documents""")
def redact_text(t):
    """P1 over whole texts: every address's local part masked."""
    return t.documents.select("doc_id", redact_emails("text").alias("text"))


@query("row_filter", """
SELECT c_custkey, c_name, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA'""")
def row_filter(t):
    """An analyst of region AMERICA sees only that region's rows."""
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = model.nations(t)
    c = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("nation_key")).select("c_custkey", "c_name", "region")
    return row_filter_op(c, "region", Caller(groups={"analysts"}, attrs={"region": "AMERICA"}))


@query("row_filter_admin", "SELECT c_custkey FROM customer")
def row_filter_admin(t):
    """An admin sees every row."""
    return row_filter_op(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", Caller(groups={"admins"})) \
        .select("c_custkey")


@query("tag_policy", """
SELECT c_custkey, sha256(c_name) AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment, c_nationkey FROM customer""")
def tag_policy(t):
    """P5: two tags, two policies, one select; the finance group would see
    balances in clear, this caller is not in it."""
    tags = {"c_name": "pii_name", "c_acctbal": "financial"}
    policies = {"pii_name": "hash", "financial": "null"}
    c = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    return apply_policies(c, tags, policies, Caller(groups={"analysts"}), exempt_groups={"financial": "finance"})


HOT = """
h AS (SELECT CASE WHEN event_type = 'view' THEN 0 ELSE user_id END AS user_id FROM events),
c AS (SELECT user_id, count(*) AS rows FROM h GROUP BY user_id)"""


def _hot(t):
    e = t.events
    return e.select(F.when(F.col("event_type") == "view", F.lit(0)).otherwise(F.col("user_id")).alias("user_id"))


@query("key_skew", f"""
WITH {HOT}
SELECT count(*) AS keys, quantile_cont(CAST(rows AS DOUBLE), 0.5) AS median_rows, max(rows) AS max_rows,
       max(rows) / quantile_cont(CAST(rows AS DOUBLE), 0.5) AS skew_ratio FROM c""")
def key_skew(t):
    """Q3: rows per key with a hot key (all 'view' events on user 0)."""
    summary, _ = key_skew_op(_hot(t), "user_id")
    return summary


@query("key_skew_top", f"WITH {HOT} SELECT user_id, rows FROM c ORDER BY rows DESC, user_id LIMIT 3")
def key_skew_top(t):
    """Q3: the heaviest keys (top-k report)."""
    _, heavy = key_skew_op(_hot(t), "user_id")
    return heavy


@query("sql_functions", """
SELECT o_orderkey,
       CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS premium,
       CAST(o_totalprice AS DOUBLE) / NULLIF(CAST(o_orderkey % 5 AS DOUBLE), 0) AS ratio,
       o_orderstatus = 'F' AS flag,
       'XXX-XXX-' || right('555' || lpad(CAST(o_custkey AS VARCHAR), 7, '0'), 4) AS phone
FROM orders""")
def sql_functions(t):
    """The same operators called from SQL as temporary SQL functions
    (inlined by Catalyst) over a view of the orders table."""
    from strata.functions.sql_functions import register_sql_functions

    register_sql_functions(t.spark)
    view = f"strata_orders_{abs(hash(t.sf_dir)) % 10_000_000}"
    t.orders.createOrReplaceTempView(view)
    return t.spark.sql(f"""
        SELECT o_orderkey,
               date_key(CAST(o_orderdate AS DATE)) AS date_key,
               parse_money(CASE WHEN o_orderkey % 7 = 0 THEN 'n/a'
                                ELSE concat('$', format_number(o_totalprice, 2)) END) AS premium,
               safe_ratio(o_totalprice, CAST(o_orderkey % 5 AS DOUBLE)) AS ratio,
               parse_bool(CASE o_orderstatus WHEN 'F' THEN ' YES ' ELSE 'no' END) AS flag,
               mask_phone(concat('555', lpad(CAST(o_custkey AS STRING), 7, '0')), false) AS phone
        FROM {view}""")
