"""Queries: aggregates (E1-E10), ranking (F1-F6), de-duplication and set
operations (D1-D4), nested data (H1-H6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import dirt
from strata.functions.numbers import exact_sum, safe_ratio
from strata.operators import aggregates as A
from strata.operators import dedup as D
from strata.operators import nested as H
from strata.operators import ranking as R
from strata.plans import marts
from strata.plans.registry import query
from strata.plans.sql import ratio, xsum
from strata.plans.star import Star

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("agg_basic", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(l_extendedprice) AS n_values,
       {xsum('l_extendedprice')} AS total, {ratio(xsum('l_extendedprice'), 'count(l_extendedprice)')} AS mean,
       min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_basic(t):
    """Count / sum / avg / min / max per group (exact sums)."""
    return A.basic_stats(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")


@query("agg_distinct", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY l_returnflag""")
def agg_distinct(t):
    """Exact distinct counts."""
    parts = A.count_distinct(t.lineitem, "l_returnflag", "l_partkey", "n_parts")
    return parts.join(A.count_distinct(t.lineitem, "l_returnflag", "l_orderkey", "n_orders"), "l_returnflag")


@query("agg_approx_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, true AS within_bound FROM lineitem GROUP BY l_returnflag")
def agg_approx_distinct(t):
    """HyperLogLog estimate, within three standard errors of the exact
    distinct count."""
    about = A.approx_distinct(t.lineitem, "l_returnflag", "l_partkey", 0.02, "approx_parts")
    exact = A.count_distinct(t.lineitem, "l_returnflag", "l_partkey", "n_parts")
    return about.join(exact, "l_returnflag").select(
        "l_returnflag", "n_parts", (F.abs(F.col("approx_parts") - F.col("n_parts")) <= 3 * 0.02 * F.col("n_parts")).alias("within_bound"))


@query("agg_conditional", f"""
SELECT o_orderpriority,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS active,
       {ratio("count(*) FILTER (WHERE o_orderstatus = 'F')", 'count(*)')} AS lapse_rate,
       {xsum("CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0.0 END")} AS pending_premium
FROM orders GROUP BY o_orderpriority""")
def agg_conditional(t):
    """Conditional counts, rates and sums."""
    s = F.col("o_orderstatus")
    return A.conditional(t.orders, "o_orderpriority", {
        "active": F.count_if(s == "O"),
        "lapse_rate": safe_ratio(F.count_if(s == "F"), F.count(F.lit(1))),
        "pending_premium": exact_sum(F.when(s == "P", F.col("o_totalprice")).otherwise(F.lit(0.0))),
    })


@query("children_rollup", f"""
WITH r AS (SELECT l_orderkey, count(*) AS lines, {xsum('l_quantity')} AS quantity FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(lines, 0) AS lines, coalesce(quantity, 0.0) AS quantity
FROM orders LEFT JOIN r ON o_orderkey = l_orderkey""")
def children_rollup(t):
    """Child rollup per parent, parents without children kept."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    return A.rollup_children(t.orders.select("o_orderkey"), lines, "o_orderkey",
                             {"lines": F.count(F.lit(1)), "quantity": exact_sum("l_quantity")},
                             {"lines": 0, "quantity": 0.0})


@query("histogram", """
SELECT event_type, floor(value / 50.0) * 50.0 AS bucket, count(*) AS n FROM events WHERE value IS NOT NULL
GROUP BY event_type, floor(value / 50.0) * 50.0""")
def histogram(t):
    """Fixed-width bucket counts per event type."""
    return A.histogram(t.events, "value", 50.0, by="event_type")


@query("rate_in_range", f"""
SELECT event_type, {ratio('count(*) FILTER (WHERE value BETWEEN 0 AND 300)', 'count(value)')} AS share_in_range,
       count(value) AS n_cells
FROM events GROUP BY event_type""")
def rate_in_range(t):
    """Share of cells inside a sane range."""
    return A.rate_in_range(t.events, "value", 0, 300, by="event_type")


@query("weighted_score", f"""
SELECT user_id,
       CAST(sum(CAST(event_type = 'error' AS INTEGER)) AS BIGINT) AS is_error_events,
       CAST(sum(CAST(event_type = 'purchase' AS INTEGER)) AS BIGINT) AS is_purchase_events,
       {xsum('value')} AS distance,
       100.0 * ((2.0 * CAST(sum(CAST(event_type = 'error' AS INTEGER)) AS DOUBLE) + 0.5 * CAST(sum(CAST(event_type = 'purchase' AS INTEGER)) AS DOUBLE))
                / NULLIF({xsum('value')}, 0)) AS score
FROM events GROUP BY user_id""")
def weighted_score(t):
    """Weighted flag events per 100 distance units."""
    e = t.events.select("user_id", "value", (F.col("event_type") == "error").alias("is_error"),
                        (F.col("event_type") == "purchase").alias("is_purchase"))
    return A.weighted_score(e, "user_id", {"is_error": 2.0, "is_purchase": 0.5}, "value")


@query("weighted_score_milli", """
SELECT user_id, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS is_error_events,
       CAST(sum(CAST(value / 1000 AS DECIMAL(38,6))) AS DOUBLE) AS distance,
       100.0 * ((2.0 * CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE)) / NULLIF(CAST(sum(CAST(value / 1000 AS DECIMAL(38,6))) AS DOUBLE), 0)) AS score
FROM events GROUP BY user_id""")
def weighted_score_milli(t):
    """E10 over distances with five decimals: nothing is cut to cents."""
    e = t.events.select("user_id", (F.col("value") / 1000).alias("value"), (F.col("event_type") == "error").alias("is_error"))
    return A.weighted_score(e, "user_id", {"is_error": 2.0}, "value")


@query("profile", f"""
WITH v AS (SELECT 'l_quantity' AS c, l_quantity AS x FROM lineitem UNION ALL
           SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem),
s AS (SELECT c, CAST(count(x) AS DOUBLE) AS cnt, {xsum('x')} / count(x) AS mean, round(stddev_samp(x), 6) AS sd,
             min(x) AS mn, max(x) AS mx, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50,
             quantile_cont(x, 0.75) AS p75 FROM v GROUP BY c)
SELECT c AS "column", statistic, value FROM s
UNPIVOT (value FOR statistic IN (cnt AS 'count', mean AS 'mean', sd AS 'stddev', mn AS 'min', mx AS 'max',
                                 p25 AS 'p25', p50 AS 'p50', p75 AS 'p75'))""")
def profile(t):
    """E5: long-format profile with exact interpolated quartiles."""
    return A.profile(t.lineitem, ["l_quantity", "l_discount", "l_extendedprice"])


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(t):
    """Set semantics."""
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("latest_per_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def latest_per_key(t):
    """newest row per repeated (order, line) key, deterministic ties."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return R.latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey"])


@query("quintiles", """
SELECT o_orderkey, o_totalprice, CAST(ntile(5) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS quintile FROM orders""")
def quintiles(t):
    """exact ``ntile(5)`` from a distributed rank."""
    return R.quantile_bucket(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 5, "o_orderkey", "quintile")


@query("top_agents", """
SELECT l_suppkey AS agent_id, count(DISTINCT l_orderkey) AS policies_sold FROM lineitem
GROUP BY l_suppkey ORDER BY policies_sold DESC, agent_id LIMIT 10""")
def top_agents(t):
    """top 10 agents by policies sold (a top-k report: the limit is the
    feature), ties by key."""
    sold = t.lineitem.groupBy(F.col("l_suppkey").alias("agent_id")).agg(
        F.countDistinct("l_orderkey").alias("policies_sold"))
    return R.top_n(sold, "policies_sold", 10, "agent_id")


@query("top_per_group", """
SELECT o_orderpriority, o_orderkey, o_totalprice, rank FROM (
  SELECT o_orderpriority, o_orderkey, o_totalprice,
         CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
  FROM orders) WHERE rank <= 3""")
def top_per_group(t):
    """F4 per group: top 3 premiums per product line, pre-cut per salt."""
    o = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return R.top_n_per_group(o, "o_orderpriority", "o_totalprice", 3, "o_orderkey")


@query("sort_by", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_by(t):
    """ordered presentation (range-partitioned sort)."""
    return R.sort_by(t.customer.select("c_custkey", "c_acctbal"), F.col("c_acctbal").desc(), "c_custkey")


@query("month_trend", f"""
SELECT strftime(l_shipdate, '%Y-%m') AS year_month, {xsum('l_extendedprice')} AS revenue, count(*) AS lines
FROM lineitem GROUP BY 1""")
def month_trend(t):
    """a measure per year-month."""
    li = t.lineitem.withColumn("year_month", F.date_format("l_shipdate", "yyyy-MM"))
    return R.month_trend(li, "year_month", {"revenue": exact_sum("l_extendedprice"), "lines": F.count(F.lit(1))})


@query("dedup_exact", """
SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R')""")
def dedup_exact(t):
    """A table stacked with a slice of itself, exact copies removed
    (lineage columns excluded from equality)."""
    li = t.lineitem
    load1 = li.withColumn("_source_file", F.lit("a"))
    load2 = li.where(F.col("l_returnflag") == "R").withColumn("_source_file", F.lit("b"))
    return D.drop_exact_duplicates(load1.unionByName(load2)).drop("_source_file")


@query("dedup_fuzzy", """
SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS version FROM customer""")
def dedup_fuzzy(t):
    """Fuzzy copies (casing / spacing changed, newer version) resolved
    to one normalised row per key."""
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment").withColumn("version", F.lit(0))
    copies = c.where(F.col("c_mktsegment") == "BUILDING").withColumn(
        "c_name", dirt.casing_variant("c_name", F.pmod("c_custkey", F.lit(4)))).withColumn("version", F.lit(1))
    return D.drop_fuzzy_duplicates(c.unionByName(copies), "c_custkey", {"c_name": "upper"}, ["version"])


@query("union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL, 'supplier' FROM supplier""")
def union_by_name(t):
    """D3: stack by column name; the supplier side has no segment."""
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"),
                          F.lit("customer").alias("kind"))
    s = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nationkey"),
                          F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return D.union_by_name(c, s)


@query("union_distinct", """
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
def union_distinct(t):
    """Union with set semantics."""
    return D.union_distinct(t.customer.select(F.col("c_nationkey").alias("nationkey")),
                            t.supplier.select(F.col("s_nationkey").alias("nationkey")))


_PARTS_SQL = """
li AS (SELECT *, row_number() OVER () AS rid FROM lineitem),
p AS (SELECT rid, l_linestatus,
  unnest([{'part': 'net', 'amount': l_extendedprice * (1 - l_discount)}, {'part': 'discount', 'amount': l_extendedprice * l_discount},
          {'part': 'tax', 'amount': l_extendedprice * l_tax}]) AS x FROM li WHERE l_linestatus = 'F' OR l_tax > 0),
e AS (SELECT rid, x.part AS part, x.amount AS amount FROM p WHERE x.amount > 0 AND (l_linestatus = 'F' OR x.part <> 'net'))"""
_PARTS_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, part, amount"


def _line_parts(t):
    """Every line with an array of its own amounts: net, discount and tax of
    closed lines; discount and tax of open ones that are taxed; NULL for the
    others. Zero amounts are left out, so an array may be empty."""
    price = F.col("l_extendedprice")
    part = lambda name, amount: F.struct(F.lit(name).alias("part"), amount.alias("amount"))
    net, cut, tax = (part(n, a) for n, a in (("net", price * (1 - F.col("l_discount"))), ("discount", price * F.col("l_discount")),
                                             ("tax", price * F.col("l_tax"))))
    parts = F.when(F.col("l_linestatus") == "F", F.array(net, cut, tax)).when(F.col("l_tax") > 0, F.array(cut, tax))
    return t.lineitem.select(*LINE_KEYS, F.filter(parts, lambda x: x["amount"] > 0).alias("parts"))


@query("explode_lines", f"WITH {_PARTS_SQL} SELECT {_PARTS_COLS} FROM li JOIN e USING (rid)")
def explode_lines(t):
    """H1: the amounts of every line, one row each."""
    return H.explode_lines(_line_parts(t), LINE_KEYS, "parts")


@query("explode_outer", f"WITH {_PARTS_SQL} SELECT {_PARTS_COLS} FROM li LEFT JOIN e USING (rid)")
def explode_outer(t):
    """H2: lines whose array is empty or NULL are kept with NULL fields."""
    return H.explode_lines(_line_parts(t), LINE_KEYS, "parts", keep_empty=True)


@query("struct_fields", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus END AS urgent_status,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS urgent_price
FROM orders""")
def struct_fields(t):
    """H3: an optional struct (present for one product line only) flattened
    to prefixed columns."""
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT",
                                             F.struct(F.col("o_orderstatus").alias("status"),
                                                      F.col("o_totalprice").alias("price"))).alias("urgent"))
    return H.struct_fields(o, "urgent")


@query("date_spine_months", """
WITH b AS (SELECT CAST(date_trunc('month', min(l_shipdate)) AS DATE) AS s, CAST(date_trunc('month', max(l_shipdate)) AS DATE) AS e FROM lineitem)
SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 MONTH)) AS DATE) AS month FROM b""")
def date_spine_months(t):
    """H4: month spine over the span of the ship dates."""
    b = t.lineitem.agg(F.trunc(F.min(F.to_date("l_shipdate")), "month").alias("start"),
                       F.trunc(F.max(F.to_date("l_shipdate")), "month").alias("end"))
    return H.date_spine(b, step="1 month", name="month")


@query("json_field", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.missing') AS missing FROM events""")
def json_field(t):
    """H6: fields of a JSON text column."""
    return t.events.select("event_id", H.json_field("props", "$.k", "int").alias("k"),
                           H.json_field("props", "$.missing").alias("missing"))


@query("event_risk", f"""
WITH v AS (SELECT user_id AS policy_id, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS harsh_events,
                  {xsum('value')} AS distance
           FROM events WHERE value BETWEEN 0.0 AND 300.0 GROUP BY user_id),
c AS (SELECT DISTINCT l_orderkey AS policy_id FROM lineitem WHERE l_returnflag = 'R')
SELECT v.*, 100.0 * (1.0 * CAST(harsh_events AS DOUBLE) / NULLIF(distance, 0)) AS harsh_score,
       c.policy_id IS NOT NULL AS had_claim
FROM v LEFT JOIN c USING (policy_id)""")
def event_risk(t):
    """Harsh events per 100 distance units over valid rows, and
    whether the policy (user id as policy id) had a claim."""
    s = Star(t)
    return marts.agg_telematics_risk(s.trips, s.fact_claims_core)


@query("dedup_documents", """
SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text""")
def dedup_documents(t):
    """D1 on whole texts: one document per identical text (the smallest id)
    with its number of copies. Texts are grouped by their SHA-256, so the
    shuffle carries a 64-character key, not the text."""
    d = t.documents.select("doc_id", F.sha2("text", 256).alias("_h"))
    return d.groupBy("_h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).drop("_h")


@query("normalize_conversations", r"""
SELECT conv_id, turn, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS text FROM conversations""")
def normalize_conversations(t):
    """B1 over whole conversation turns: whitespace runs collapsed,
    trimmed, lower-cased."""
    from strata.functions.text import normalize_text

    c = t.conversations
    return c.select("conv_id", "turn", normalize_text("text", "lower").alias("text"))


@query("conversation_keys", """
SELECT conv_id, turn, count(*) AS n FROM conversations GROUP BY conv_id, turn HAVING count(*) > 1""")
def conversation_keys(t):
    """K13 on (conv_id, turn): expect no duplicate keys."""
    from strata.operators.quality import unique_key

    return unique_key(t.conversations, ["conv_id", "turn"])


@query("label_coverage", """
SELECT lang, count(*) AS documents, count(l.doc_id) AS labelled,
       CAST(sum(l.quality) AS BIGINT) AS quality_docs, CAST(sum(l.toxic) AS BIGINT) AS toxic_docs,
       CAST(sum(l.quality) AS DOUBLE) / NULLIF(CAST(count(l.doc_id) AS DOUBLE), 0) AS quality_share
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang""")
def label_coverage(t):
    """C2 + E4: labels joined to documents (left, unlabelled kept);
    coverage and label shares per language."""
    d = t.documents.select("doc_id", "lang")
    lab = t.labels.select(F.col("doc_id").alias("_lid"), "quality", "toxic")
    j = d.join(lab, F.col("doc_id") == F.col("_lid"), "left")
    return j.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"), F.count("_lid").alias("labelled"),
        F.sum("quality").cast("bigint").alias("quality_docs"), F.sum("toxic").cast("bigint").alias("toxic_docs"),
        safe_ratio(F.sum("quality"), F.count("_lid")).alias("quality_share"))
