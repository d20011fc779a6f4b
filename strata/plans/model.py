"""The insurance model mapped onto the driver's tables.

Each function returns a cleaned, "silver"-shaped DataFrame with the column
names the marts expect, so every mart works on any source that is mapped to
these shapes:

========== ================================================================
policies   orders: policy_id, customer_id, agent_id, product_line, status,
           effective_date, expiration_date (+365 days), annual_premium
coverages  lineitem lines of an order: policy_id, coverage_code (part),
           limit_amount (extended price), deductible (quantity)
claims     lineitem rows with return flag R: claim_id, policy_id,
           loss_date, loss_amount, paid_amount, peril_code (part type),
           fraud_flag (line status F), claim_status
payments   every lineitem row as one installment
customers  customer + nation (state) + region
agents     supplier + nation + region
trips      events: event_id, ts, policy_id (user), harsh (type 'error'),
           distance (value), k (props.k)
========== ================================================================
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import row_hash
from strata.operators.nested import json_field
from strata.tables import Tables

# Fixed values of the mapping.
AS_OF = "2002-01-01"  # reporting date: after the last order date in the data
TERM_DAYS = 365
POLICY_STATUS = {"O": "ACTIVE", "F": "LAPSED", "P": "PENDING"}
CLAIM_STATUS = {"F": "CLOSED", "O": "OPEN"}
# installment state from (return flag, line status)
PAYMENT_STATUS = (("R", None, "MISSED"), ("A", None, "LATE"), ("N", "F", "PAID"), ("N", "O", "PENDING"))
LATE_DAYS = 30
HARSH_EVENT = "error"


def _map(col: str, mapping: dict):
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, F.col(col))


def line_id(prefix_cols=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")):
    """Stable id of a lineitem row (these four columns are unique)."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in prefix_cols]), 256)


def agent_count(t: Tables):
    """Number of agents as a scalar subquery (evaluated once, no join)."""
    return t.supplier.agg(F.count(F.lit(1))).scalar()


def policies(t: Tables) -> DataFrame:
    eff = F.to_date(F.col("o_orderdate"))
    return t.orders.select(
        F.col("o_orderkey").alias("policy_id"),
        F.col("o_custkey").alias("customer_id"),
        F.pmod(F.col("o_orderkey"), agent_count(t)).alias("agent_id"),
        F.col("o_orderpriority").alias("product_line"),
        _map("o_orderstatus", POLICY_STATUS).alias("status"),
        eff.alias("effective_date"),
        F.date_add(eff, TERM_DAYS).alias("expiration_date"),
        F.col("o_totalprice").alias("annual_premium"),
    )


def nations(t: Tables) -> DataFrame:
    """nation + region names; both tables have a fixed size (25 / 5 rows)."""
    return t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("state"), F.col("r_name").alias("region")
    )


def customers(t: Tables) -> DataFrame:
    c = t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("account_balance"),
    )
    return c.join(F.broadcast(nations(t)), "nation_key", "left").drop("nation_key")


def agents(t: Tables) -> DataFrame:
    s = t.supplier.select(
        F.col("s_suppkey").alias("agent_id"),
        F.col("s_name").alias("agent_name"),
        F.col("s_nationkey").alias("nation_key"),
        F.col("s_acctbal").alias("commission_base"),
    )
    return s.join(F.broadcast(nations(t)), "nation_key", "left").drop("nation_key")


def coverages(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("policy_id"),
        F.col("l_partkey").alias("coverage_code"),
        F.col("l_extendedprice").alias("limit_amount"),
        F.col("l_quantity").alias("deductible"),
    )


def claims(t: Tables) -> DataFrame:
    li = t.lineitem.where(F.col("l_returnflag") == "R")
    return li.select(
        line_id().alias("claim_id"),
        F.col("l_orderkey").alias("policy_id"),
        F.col("l_partkey").alias("part_key"),
        F.to_date(F.col("l_shipdate")).alias("loss_date"),
        F.col("l_extendedprice").alias("loss_amount"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("paid_amount"),
        (F.col("l_linestatus") == "F").alias("fraud_flag"),
        _map("l_linestatus", CLAIM_STATUS).alias("claim_status"),
    )


def perils(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part_key"), F.col("p_type").alias("peril_code"))


def claims_with_peril(t: Tables) -> DataFrame:
    """Claims with the peril resolved through the part table (a shuffle or
    a runtime broadcast join chosen by AQE; the part table grows with the
    data, so no fixed broadcast)."""
    return claims(t).join(perils(t), "part_key", "left").drop("part_key")


def payment_status():
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    out = None
    for flag, line, state in PAYMENT_STATUS:
        cond = (rf == flag) if line is None else ((rf == flag) & (ls == line))
        out = F.when(cond, F.lit(state)) if out is None else out.when(cond, F.lit(state))
    return out


def payments(t: Tables) -> DataFrame:
    status = payment_status()
    due = F.to_date(F.col("l_shipdate"))
    paid = status.isin("PAID", "LATE")
    return t.lineitem.select(
        line_id().alias("payment_id"),
        F.col("l_orderkey").alias("policy_id"),
        F.col("l_linenumber").alias("installment_no"),
        due.alias("due_date"),
        F.when(paid, F.date_add(due, F.when(status == "LATE", LATE_DAYS).otherwise(0))).alias("paid_date"),
        F.col("l_extendedprice").alias("amount_due"),
        F.when(paid, F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("amount_paid"),
        status.alias("status"),
    )


def trips(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id"),
        F.col("ts"),
        F.col("user_id").alias("policy_id"),
        F.col("event_type"),
        (F.col("event_type") == HARSH_EVENT).alias("harsh"),
        F.col("value").alias("distance"),
        json_field("props", "$.k", "int").alias("k"),
    )


def row_id(df: DataFrame):
    return row_hash(df.columns)
