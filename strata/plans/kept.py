"""Marts kept up to date from changes.

Base tables are :class:`KeyedTable`; the marts' sums are small states. A batch
brings changed and deleted rows of any base table; deltas of the joins under
the aggregates are worked out from the batch and the rows it touches, added to
the states, and everything is published by one pointer. A batch that was
committed already is a no-op, so a retry after a crash is safe.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import month_key
from strata.functions.flags import is_overdue
from strata.functions.numbers import safe_ratio
from strata.operators.incremental import WEIGHT, aggregate_delta, consolidate, keyed_delta, left_join_delta, merge_aggregate
from strata.operators.nested import expand_months
from strata.sources.keyed import KeyedTable
from strata.sources.pointer import read_text, replace_text

GRAIN = ["month_key", "product_line", "state"]
BASES = {"customers": "customer_id", "policies": "policy_id", "claims": "claim_id", "payments": "payment_id"}


class KeptMarts:
    """``agg_loss_ratio`` and ``billing_leakage`` over kept base tables.

    Changes carry the columns of the base tables and a boolean ``_deleted``
    (of deleted rows only the key is read); one row a key in a batch. Base
    columns: customers (customer_id, state), policies (policy_id, customer_id,
    product_line, effective_date, expiration_date, annual_premium), claims
    (claim_id, policy_id, loss_date, loss_amount), payments (payment_id,
    due_date, amount_due, amount_paid, status).
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = {n: KeyedTable(spark, f"{self.root}/base/{n}", k, buckets) for n, k in BASES.items()}

    def _state(self) -> dict:
        return json.loads(read_text(self.spark, f"{self.root}/_STATE") or '{"batch": -1, "bases": {}, "marts": {}}')

    def _mart(self, state: dict, name: str) -> DataFrame | None:
        path = state["marts"].get(name)
        return self.spark.read.parquet(f"{self.root}/{path}") if path else None

    def _store(self, df: DataFrame, name: str) -> str:
        path = f"marts/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.root}/{path}")
        return path

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self._store(df, name)}")

    def apply(self, batch: int, changes: dict[str, DataFrame]) -> None:
        """Take in one batch of changes."""
        state = self._state()
        if batch <= state["batch"]:
            return
        manifests = {n: state["bases"].get(n, {}) for n in self.base}
        # changes of a table with rows are read twice
        changes = {n: self._stored(df, f"changes-{n}") if manifests[n] else df for n, df in changes.items()}
        old, delta, after = {}, {}, dict(manifests)
        for n, table in self.base.items():
            old[n] = table.rows(manifests[n])
            if n in changes:
                after[n], left, came = table.merge(manifests[n], changes[n])  # reads the touched buckets only
                came = changes[n].where("_deleted").limit(0) if came is None else came.withColumn("_deleted", F.lit(False))
                delta[n] = keyed_delta(left, came, BASES[n], matched=True)
        new = {n: t.rows(after[n]) for n, t in self.base.items()}
        marts = dict(state["marts"])
        if delta.keys() & {"customers", "policies", "claims"}:
            marts |= self._loss_ratio(state, old, new, delta)
        if "payments" in delta:
            paid = F.coalesce("amount_paid", F.lit(0.0))
            late = is_overdue("status")
            d = delta["payments"].withColumns({"month_key": month_key("due_date"), "late": late.cast("long")})
            sums = {"written": "amount_due", "collected": paid, "overdue_exposure": F.when(late, F.col("amount_due")).otherwise(0.0), "overdue_installments": "late"}
            marts["billing"] = self._store(merge_aggregate(self._mart(state, "billing"), aggregate_delta(d, "month_key", sums), "month_key"), "billing")
        replace_text(self.spark, f"{self.root}/_STATE", json.dumps({"batch": batch, "bases": after, "marts": marts}))

    def _loss_ratio(self, state: dict, old: dict, new: dict, delta: dict) -> dict[str, str]:
        none = lambda n, like: like.limit(0).withColumn(WEIGHT, F.lit(1).cast("long")) if n not in delta else delta[n]
        place = lambda df: None if df is None else df.select("customer_id", "state")
        if new["customers"] is None or new["policies"] is None:
            raise ValueError("customers and policies come with or before the claims")
        moved = delta["customers"].select("customer_id").distinct() if "customers" in delta else new["customers"].select("customer_id").limit(0)
        # policies with their customer's state
        d_pol = left_join_delta(old["policies"], none("policies", new["policies"]), place(old["customers"]), place(new["customers"]), moved, "customer_id")
        d_pol = self._stored(consolidate(d_pol.select("policy_id", "product_line", "state", "effective_date", "expiration_date", "annual_premium", WEIGHT)), "delta-policies")
        months = expand_months(d_pol, "effective_date", "expiration_date", "month").withColumn("month_key", month_key("month"))
        earned = merge_aggregate(self._mart(state, "earned"), aggregate_delta(months, GRAIN, {"premium": "annual_premium"}), GRAIN)
        out = {"earned": self._store(earned, "earned")}
        if new["claims"] is None:
            return out
        # claims with their policy's product line and state
        touched = d_pol.select("policy_id").distinct()
        d_claims = none("claims", new["claims"])
        wanted = touched.unionByName(d_claims.select("policy_id")).distinct()

        def dim(bases: dict) -> DataFrame | None:
            if bases["policies"] is None:
                return None
            p = bases["policies"].join(wanted, "policy_id", "left_semi").select("policy_id", "customer_id", "product_line")
            c = place(bases["customers"])
            p = p.join(c, "customer_id", "left") if c is not None else p.withColumn("state", F.lit(None).cast("string"))
            return p.drop("customer_id")

        d = left_join_delta(old["claims"], d_claims, dim(old), dim(new), touched, "policy_id").withColumn("month_key", month_key("loss_date"))
        losses = merge_aggregate(self._mart(state, "losses"), aggregate_delta(d, GRAIN, {"losses": "loss_amount"}), GRAIN)
        return out | {"losses": self._store(losses, "losses")}

    # -- the marts

    def loss_ratio(self) -> DataFrame:
        """As ``marts.agg_loss_ratio``, from the states alone."""
        state = self._state()
        earned = self._mart(state, "earned").select(*GRAIN, (F.col("premium").cast("double") / F.lit(12.0)).alias("earned_premium"))
        losses = self._mart(state, "losses")
        losses = losses.select(*GRAIN, F.col("rows").alias("claim_count"), F.col("losses").cast("double").alias("incurred_losses"))
        zero = F.lit(0.0)
        # a state may be NULL (policy without customer): null-safe keys
        sides = earned.withColumns({"claim_count": F.lit(None).cast("long"), "incurred_losses": F.lit(None).cast("double")}).unionByName(
            losses.withColumn("earned_premium", F.lit(None).cast("double")))
        out = sides.groupBy(*GRAIN).agg(*[F.max(c).alias(c) for c in ("claim_count", "incurred_losses", "earned_premium")])
        return out.select(*GRAIN, F.coalesce("claim_count", F.lit(0)).alias("claim_count"), F.coalesce("incurred_losses", zero).alias("incurred_losses"),
                          F.coalesce("earned_premium", zero).alias("earned_premium"),
                          safe_ratio(F.coalesce("incurred_losses", zero), "earned_premium").alias("loss_ratio"))

    def billing_leakage(self) -> DataFrame:
        """As ``marts.billing_leakage`` by month."""
        m = self._mart(self._state(), "billing")
        return m.select("month_key", *[F.col(c).cast("double").alias(c) for c in ("written", "collected", "overdue_exposure")],
                        F.col("overdue_installments").cast("long").alias("overdue_installments"), F.col("rows").alias("installments"))
