"""SQL fragments for the DuckDB oracle (the same model as ``model.py``,
written independently in SQL)."""


def xsum(expr: str, scale: int = 6) -> str:
    """Exact sum of amounts, added as decimals, as a double."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,{scale}))) AS DOUBLE)"


def ratio(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


def date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def month_key(d: str) -> str:
    return f"CAST(year({d}) * 100 + month({d}) AS INTEGER)"


POLICIES = """
pol AS (
  SELECT o_orderkey AS policy_id, o_custkey AS customer_id,
         o_orderkey % (SELECT count(*) FROM supplier) AS agent_id,
         o_orderpriority AS product_line,
         CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'LAPSED' WHEN 'P' THEN 'PENDING' END AS status,
         CAST(o_orderdate AS DATE) AS effective_date,
         CAST(CAST(o_orderdate AS DATE) + 365 AS DATE) AS expiration_date,
         o_totalprice AS annual_premium
  FROM orders)"""

NATIONS = """
nat AS (
  SELECT n_nationkey AS nation_key, n_name AS state, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

CUSTOMERS = """
cust AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment,
         c_acctbal AS account_balance, nat.state, nat.region
  FROM customer LEFT JOIN nat ON c_nationkey = nat.nation_key)"""

AGENTS = """
agt AS (
  SELECT s_suppkey AS agent_id, s_name AS agent_name, s_acctbal AS commission_base, nat.state, nat.region
  FROM supplier LEFT JOIN nat ON s_nationkey = nat.nation_key)"""

COVERAGE_ROLLUP = f"""
cov AS (
  SELECT l_orderkey AS policy_id, count(*) AS coverage_count, {xsum('l_extendedprice')} AS total_limit
  FROM lineitem GROUP BY l_orderkey)"""

DIM_POLICY = """
dim_pol AS (
  SELECT pol.*, cust.state,
         coalesce(cov.coverage_count, 0) AS coverage_count,
         coalesce(cov.total_limit, 0.0) AS total_limit
  FROM pol LEFT JOIN cust USING (customer_id) LEFT JOIN cov USING (policy_id))"""

CLAIMS = """
clm AS (
  SELECT sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS claim_id,
         l_orderkey AS policy_id,
         CAST(l_shipdate AS DATE) AS loss_date,
         l_extendedprice AS loss_amount,
         l_extendedprice * (1.0 - l_discount) AS paid_amount,
         (l_linestatus = 'F') AS fraud_flag,
         CASE l_linestatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' END AS claim_status,
         p_type AS peril_code
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  WHERE l_returnflag = 'R')"""

FACT_CLAIMS = f"""
fc AS (
  SELECT clm.claim_id, clm.policy_id, d.customer_id, d.agent_id, d.product_line, d.state,
         {date_key('clm.loss_date')} AS date_key, {month_key('clm.loss_date')} AS month_key,
         clm.peril_code, clm.claim_status, clm.loss_amount, clm.paid_amount, clm.fraud_flag
  FROM clm LEFT JOIN dim_pol d USING (policy_id))"""

MONTH_CEIL = ("CASE WHEN day(effective_date) = 1 THEN effective_date "
              "ELSE CAST(date_trunc('month', effective_date) + INTERVAL 1 MONTH AS DATE) END")

FACT_PREMIUM = f"""
pol_state AS (
  SELECT pol.*, cust.state FROM pol LEFT JOIN cust USING (customer_id)),
fp_m AS (
  SELECT *, CAST(unnest(generate_series({MONTH_CEIL}, CAST(date_trunc('month', expiration_date) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM pol_state),
fp AS (
  SELECT policy_id, customer_id, agent_id, product_line, status, annual_premium, state,
         {month_key('month')} AS month_key, annual_premium / 12.0 AS earned_premium
  FROM fp_m)"""

PAYMENTS = f"""
pay AS (
  SELECT sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS payment_id,
         l_orderkey AS policy_id, l_linenumber AS installment_no,
         CAST(l_shipdate AS DATE) AS due_date,
         CASE WHEN l_returnflag = 'A' THEN CAST(CAST(l_shipdate AS DATE) + 30 AS DATE)
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS paid_date,
         l_extendedprice AS amount_due,
         CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F')
              THEN l_extendedprice * (1.0 - l_discount) END AS amount_paid,
         CASE WHEN l_returnflag = 'R' THEN 'MISSED' WHEN l_returnflag = 'A' THEN 'LATE'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'PAID'
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'PENDING' END AS status
  FROM lineitem),
fpay AS (
  SELECT payment_id, policy_id, installment_no, due_date, paid_date,
         {date_key('due_date')} AS date_key, {month_key('due_date')} AS month_key,
         amount_due, amount_paid, status, status IN ('LATE', 'MISSED') AS is_overdue
  FROM pay)"""

TRIPS = """
trp AS (
  SELECT event_id, ts, user_id AS policy_id, event_type, (event_type = 'error') AS harsh,
         value AS distance, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


DIM_CUSTOMER = """
since AS (SELECT customer_id, min(effective_date) AS customer_since FROM pol GROUP BY customer_id),
ten AS (
  SELECT cust.*, since.customer_since,
         CAST(floor(((year(DATE '2002-01-01') - year(customer_since)) * 12
                     + (month(DATE '2002-01-01') - month(customer_since))
                     - CASE WHEN day(DATE '2002-01-01') < day(customer_since) THEN 1 ELSE 0 END) / 12) AS INTEGER)
           AS tenure_years
  FROM cust LEFT JOIN since USING (customer_id)),
dc AS (
  SELECT customer_id, name, segment, state, region, customer_since, tenure_years,
         CASE WHEN tenure_years IS NULL THEN NULL WHEN tenure_years < 0 THEN NULL
              WHEN tenure_years < 1 THEN '<1y' WHEN tenure_years < 3 THEN '1-2y'
              WHEN tenure_years < 5 THEN '3-4y' WHEN tenure_years < 10 THEN '5-9y' ELSE '10y+' END AS tenure_band
  FROM ten)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


BASE = (POLICIES, NATIONS, CUSTOMERS)
STAR = (POLICIES, NATIONS, CUSTOMERS, COVERAGE_ROLLUP, DIM_POLICY, CLAIMS, FACT_CLAIMS, FACT_PREMIUM)
