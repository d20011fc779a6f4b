"""Queries: scalar cleaning (B1-B24) as round trips.

Each round-trip query dirties a clean column inside the query (the shape
chosen by the row's key), cleans it with the operator under test, and
returns the cleaned value; the oracle is the *original* clean column, so
both sides cannot share one mistake. Every row of the table is processed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import dirt
from strata.functions.categories import POLICY_STATUS_FIXES, map_category
from strata.functions.dates import band, flag_future, parse_date, tenure_months
from strata.functions.flags import case_when, parse_bool
from strata.functions.hashing import row_hash, surrogate_key
from strata.functions.numbers import in_range, parse_money, within_parent_limit
from strata.functions.text import normalize_text, split_part
from strata.operators.joins import lookup
from strata.plans import model
from strata.plans.registry import query


@query("clean_text_rt", "SELECT p_partkey, p_name AS cleaned FROM part")
def clean_text_rt(t):
    """B1: upper / lower / padded / doubled-space names normalised back."""
    p = t.part
    dirty = dirt.casing_variant("p_name", F.pmod("p_partkey", F.lit(5)))
    return p.select("p_partkey", normalize_text(dirty, "lower").alias("cleaned"))


@query("parse_money_rt", """
SELECT o_orderkey, CASE WHEN o_orderkey % 41 = 7 THEN NULL ELSE o_totalprice END AS parsed FROM orders""")
def parse_money_rt(t):
    """B2 (trap 1): ``$1,234.50``, padded, decimal comma, ``$-``, garbage."""
    o = t.orders
    v = F.pmod("o_orderkey", F.lit(5))
    text = dirt.money_text(F.when(v == 3, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")), v)
    text = F.when(F.pmod("o_orderkey", F.lit(41)) == 7, F.lit("abc")).otherwise(text)
    parsed = parse_money(text)
    return o.select("o_orderkey", F.when(v == 3, -parsed).otherwise(parsed).alias("parsed"))


@query("parse_date_rt", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 6 = 3 THEN NULL
            WHEN o_orderkey % 6 = 2 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 60 MONTH AS DATE)
            ELSE CAST(o_orderdate AS DATE) END AS parsed,
       (CASE WHEN o_orderkey % 6 = 3 THEN NULL
            WHEN o_orderkey % 6 = 2 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 60 MONTH AS DATE)
            ELSE CAST(o_orderdate AS DATE) END) > DATE '2001-01-01' AS is_future
FROM orders""")
def parse_date_rt(t):
    """B3/B4 (traps 8, 9): three layouts, a +5-year shift (detectable
    only as a future date), ``not_a_date`` -> NULL."""
    o = t.orders
    text = dirt.date_text("o_orderdate", F.pmod("o_orderkey", F.lit(6)))
    parsed = parse_date(text)
    return o.select("o_orderkey", parsed.alias("parsed"), flag_future(parsed, "2001-01-01").alias("is_future"))


@query("parse_date_invalid", """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-02-' || CAST(30 + o_orderkey % 2 AS VARCHAR) AS s,
       CAST(NULL AS DATE) AS parsed FROM orders""")
def parse_date_invalid(t):
    """B3 edge: impossible calendar dates derived from real dates (day 30 or
    31 of February) never parse."""
    o = t.orders
    s = F.concat(F.year(F.to_date("o_orderdate")).cast("string"), F.lit("-02-"),
                 (F.lit(30) + F.pmod("o_orderkey", F.lit(2))).cast("string"))
    return o.select("o_orderkey", s.alias("s"), parse_date(s).alias("parsed"))


BOOL_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN (l_orderkey + l_linenumber) % 9 = 8 THEN NULL ELSE l_linestatus = 'F' END AS parsed
FROM lineitem"""


@query("parse_bool_rt", BOOL_SQL)
def parse_bool_rt(t):
    """``true Y 1 YES`` / ``false N 0 NO`` / `` yes `` / ``maybe``."""
    li = t.lineitem
    v = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(9))
    yes = F.element_at(F.array(*[F.lit(x) for x in ["true", "Y", "1", "YES", " yes "]]), (F.pmod(v, F.lit(5)) + 1).cast("int"))
    no = F.element_at(F.array(*[F.lit(x) for x in ["false", "N", "0", "NO"]]), (F.pmod(v, F.lit(4)) + 1).cast("int"))
    token = F.when(v == 8, F.lit("maybe")).when(F.col("l_linestatus") == "F", yes).otherwise(no)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", parse_bool(token).alias("parsed"))


# Typo spellings per canonical policy state, used to dirty the
# clean states (first entry = a spelling that stays invalid after fixing).
STATUS_TYPOS = {
    "ACTIVE": ["active", "Active ", "ACTIVEE", "Actv"],
    "LAPSED": ["LAPSE", "lapsed", "LAPSED"],
    "PENDING": ["pend", "Pening", "PENDING"],
}

CATEGORY_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL
            ELSE CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'LAPSED' WHEN 'P' THEN 'PENDING' END
       END AS status
FROM orders"""


@query("category_rt", CATEGORY_SQL)
def category_rt(t):
    """B7 + B8 (trap 10): typos mapped, then checked against the lookup of
    valid states (derived from the clean data); the rest become NULL."""
    pol = model.policies(t)
    k = F.col("policy_id")
    typo = None
    for canon, spellings in STATUS_TYPOS.items():
        arr = F.array(*[F.lit(s) for s in spellings])
        pick = F.element_at(arr, (F.pmod(k, F.lit(len(spellings))) + 1).cast("int"))
        typo = F.when(F.col("status") == canon, pick) if typo is None else typo.when(F.col("status") == canon, pick)
    dirty = F.when(F.pmod(k, F.lit(53)) == 0, F.lit("XX")).otherwise(typo)
    mapped = pol.select(F.col("policy_id").alias("o_orderkey"),
                        map_category(dirty, POLICY_STATUS_FIXES).alias("_status"))
    valid = pol.select(F.col("status").alias("_valid")).distinct()
    out = lookup(mapped, valid, ("_status", "_valid"))
    return out.select("o_orderkey", F.col("_valid").alias("status"))


@query("validate_category", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderpriority END AS priority,
       o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS quarantined
FROM orders""")
def validate_category(t):
    """Values outside a lookup (here the three named priorities that the
    part of the lookup covers) become NULL and are marked for quarantine."""
    o = t.orders.select("o_orderkey", "o_orderpriority")
    from strata.operators.projection import validate_category as vc

    ref = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")).select(F.col("o_orderpriority").alias("code"))
    out = vc(o, "o_orderpriority", ref, "code", "quarantined")
    return out.select("o_orderkey", F.col("o_orderpriority").alias("priority"), "quarantined")


@query("cast_types", """
SELECT CAST(o_orderkey AS VARCHAR) AS policy_id, CAST(o_custkey AS INTEGER) AS customer_id,
       CAST(o_totalprice AS DECIMAL(18,2)) AS premium, CAST(o_orderdate AS DATE) AS effective_date,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank
FROM orders""")
def cast_types(t):
    """Typed projection with ``try_cast`` (bad text -> NULL)."""
    from strata.operators.projection import cast_types as ct

    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                        F.substring("o_orderpriority", 1, 1).alias("priority_rank"))
    spec = {"o_orderkey": "string", "o_custkey": "int", "o_totalprice": "decimal(18,2)",
            "o_orderdate": "date", "priority_rank": "int"}
    out = ct(o, spec)
    return out.select(F.col("o_orderkey").alias("policy_id"), F.col("o_custkey").alias("customer_id"),
                      F.col("o_totalprice").alias("premium"), F.col("o_orderdate").alias("effective_date"),
                      "priority_rank")


@query("row_hash", """
SELECT c_custkey, sha256(concat_ws('||', coalesce(CAST(c_name AS VARCHAR), '<null>'),
                                     coalesce(CAST(c_mktsegment AS VARCHAR), '<null>'),
                                     coalesce(CAST(c_nationkey AS VARCHAR), '<null>'),
                                     coalesce(CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS VARCHAR), '<null>'))) AS _hash
FROM customer""")
def row_hash_q(t):
    """NULL-safe change hash (NULLs injected on every 7th key)."""
    c = t.customer
    seg2 = F.when(F.pmod("c_custkey", F.lit(7)) == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", row_hash(["c_name", "c_mktsegment", "c_nationkey", seg2]).alias("_hash"))


@query("surrogate_key", """
SELECT 'customer' AS source, count(*) AS rows, count(DISTINCT c_custkey) AS keys, true AS one_to_one FROM customer
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey), true FROM orders
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)), true FROM lineitem""")
def surrogate_key_q(t):
    """64-bit surrogate keys are as many as the business keys, and never
    NULL."""
    def per(df, name, keys):
        sk = df.select(*keys, surrogate_key(keys).alias("sk"))
        return sk.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("rows"), F.count_distinct(*keys).alias("keys"),
                      ((F.count_distinct("sk") == F.count_distinct(*keys)) & (F.count("sk") == F.count(F.lit(1)))).alias("one_to_one"))

    return per(t.customer, "customer", ["c_custkey"]).unionByName(per(t.orders, "orders", ["o_orderkey"])).unionByName(
        per(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]))


@query("split_column", "SELECT c_custkey, split_part(c_name, '#', 2) AS name_number, "
                       "CAST(NULL AS VARCHAR) AS missing_part FROM customer")
def split_column(t):
    """Split and index; out of range -> NULL."""
    c = t.customer
    return c.select("c_custkey", split_part("c_name", "#", 1).alias("name_number"),
                    split_part("c_name", "#", 5).alias("missing_part"))


@query("fill_nulls", """
SELECT c_custkey, coalesce(n, 0) AS n_orders, coalesce(total, 0.0) AS total_price, coalesce(last_status, 'NONE') AS last_status
FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) AS total, max(o_orderstatus) AS last_status
  FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey""")
def fill_nulls(t):
    """Per-column defaults after a left join."""
    from strata.functions.numbers import exact_sum
    from strata.operators.projection import fill_nulls as fn

    o = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), exact_sum("o_totalprice").alias("total_price"),
        F.max("o_orderstatus").alias("last_status"))
    j = t.customer.select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    return fn(j, {"n_orders": 0, "total_price": 0.0, "last_status": "NONE"})


@query("tenure", """
SELECT o_orderkey,
       CAST((year(DATE '2002-01-01') - year(CAST(o_orderdate AS DATE))) * 12 + (month(DATE '2002-01-01') - month(CAST(o_orderdate AS DATE)))
            - CASE WHEN day(DATE '2002-01-01') < day(CAST(o_orderdate AS DATE)) THEN 1 ELSE 0 END AS INTEGER) AS tenure_months
FROM orders""")
def tenure(t):
    """Whole months from the policy start to the reporting date."""
    return t.orders.select("o_orderkey", tenure_months("o_orderdate", model.AS_OF).alias("tenure_months"))


@query("age_bands", """
SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal < 0 THEN 'negative'
                       WHEN c_acctbal < 1000 THEN '0-999' WHEN c_acctbal < 5000 THEN '1000-4999'
                       ELSE '5000+' END AS balance_band
FROM customer""")
def age_bands(t):
    """Labelled bands over a numeric column (exact ``when`` ladder)."""
    return t.customer.select("c_custkey", band("c_acctbal", [0, 1000, 5000], ["0-999", "1000-4999", "5000+"],
                                               below="negative").alias("balance_band"))


@query("region_lookup", """
SELECT c_custkey, r_name AS region
FROM customer LEFT JOIN nation ON CAST(substr(lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0'), 1, 2) AS INTEGER) = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""")
def region_lookup(t):
    """The leading digits of a code resolve a region through a fixed
    lookup (broadcast: the lookup has a fixed size)."""
    from strata.operators.projection import region_from_prefix

    c = t.customer.select("c_custkey", F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
                                                F.lpad(F.pmod("c_custkey", F.lit(1000)).cast("string"), 3, "0")).alias("postal"))
    ref = model.nations(t).select(F.lpad(F.col("nation_key").cast("string"), 2, "0").alias("prefix"), "region")
    return region_from_prefix(c, "postal", ref, "prefix", 2).select("c_custkey", "region")


@query("in_range", """
SELECT event_id, value BETWEEN 0 AND 300 AS valid_speed, value >= 0 AS non_negative FROM events""")
def in_range_q(t):
    """Range predicates."""
    e = t.events
    return e.select("event_id", in_range("value", 0, 300).alias("valid_speed"), in_range("value", lo=0).alias("non_negative"))


@query("within_parent_limit", """
WITH lim AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, o_totalprice
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice <= o_totalprice * 0.2 AS within_limit FROM lim""")
def within_parent_limit_q(t):
    """Claim amount against a limit of the parent policy (20 % of the
    premium), after the join."""
    li = t.lineitem.where(F.col("l_returnflag") == "R")
    j = li.join(t.orders.select("o_orderkey", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    within_parent_limit("l_extendedprice", F.col("o_totalprice") * 0.2).alias("within_limit"))


@query("case_when", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_discount >= 0.08 THEN 'deep' WHEN l_discount >= 0.04 THEN 'mid' WHEN l_discount > 0 THEN 'light' ELSE 'none' END AS discount_class
FROM lineitem""")
def case_when_q(t):
    """Conditional column."""
    d = F.col("l_discount")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             case_when([(d >= 0.08, "deep"), (d >= 0.04, "mid"), (d > 0, "light")], "none").alias("discount_class"))


@query("select_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) AS net_price,
       CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' AND l_discount BETWEEN 0.05 AND 0.07""")
def select_filter(t):
    """Projection + filter; both reach the parquet scan (pushed
    filters, pruned read schema)."""
    li = t.lineitem.where(
        (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        & F.col("l_discount").between(0.05, 0.07))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("net_price"),
                     F.to_date("l_shipdate").alias("ship_date"))


@query("parse_timestamp_rt", """
SELECT event_id, CASE WHEN event_id % 37 = 5 THEN NULL ELSE date_trunc('second', ts) END AS parsed FROM events""")
def parse_timestamp_rt(t):
    """ISO text (``yyyy-MM-ddTHH:mm:ss``) back to a timestamp; garbage
    -> NULL."""
    e = t.events
    text = F.when(F.pmod("event_id", F.lit(37)) == 5, F.lit("2024-13-45T99:00:00")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    from strata.functions.dates import parse_timestamp

    return e.select("event_id", parse_timestamp(text).cast("timestamp_ntz").alias("parsed"))


RESCUE_SQL = """
SELECT event_id,
       CASE WHEN event_id % 15 = 0 THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_id % 15 = 0 AND event_id % 10 = 0 THEN '{"k":"abc","extra":"x"}'
            WHEN event_id % 15 = 0 THEN '{"k":"abc"}'
            WHEN event_id % 10 = 0 THEN '{"extra":"x"}' END AS _rescued_data
FROM events"""


@query("rescue_data", RESCUE_SQL)
def rescue_data(t):
    """JSON text parsed with a fixed schema ``{k: int}``; a field the
    schema lacks (``extra``) or a value of the wrong type (``"abc"``) goes
    to ``_rescued_data`` instead of failing or vanishing."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    from strata.sources.schema import with_rescued

    e = t.events
    k = F.get_json_object("props", "$.k")
    body = F.when(F.pmod("event_id", F.lit(15)) == 0, F.lit('{"k": "abc"')).otherwise(F.concat(F.lit('{"k": '), k))
    text = F.concat(body, F.when(F.pmod("event_id", F.lit(10)) == 0, F.lit(', "extra": "x"}')).otherwise(F.lit("}")))
    df = e.select("event_id", text.alias("raw"))
    return with_rescued(df, "raw", StructType([StructField("k", IntegerType())]))
