"""Builds the star schema over the driver's tables (shared by queries)."""

from __future__ import annotations

from functools import cached_property

from strata.plans import marts, model
from strata.tables import Tables


class Star:
    def __init__(self, t: Tables, as_of: str = model.AS_OF):
        self.t = t
        self.as_of = as_of

    @cached_property
    def policies(self):
        return model.policies(self.t)

    @cached_property
    def customers(self):
        return model.customers(self.t)

    @cached_property
    def agents(self):
        return model.agents(self.t)

    @cached_property
    def dim_policy(self):
        return marts.dim_policy(self.policies, self.customers, model.coverages(self.t))

    @cached_property
    def dim_customer(self):
        return marts.dim_customer(self.customers, self.policies, self.as_of)

    @cached_property
    def dim_agent(self):
        from strata.operators.scd import scd2_current, scd2_seed

        from pyspark.sql import functions as F

        seeded = scd2_seed(self.agents.withColumn("updated_at", F.lit("2000-01-01 00:00:00").cast("timestamp")),
                           "agent_id", ["agent_name", "state", "region", "commission_base"], "updated_at")
        return scd2_current(seeded, ["agent_id"])

    @cached_property
    def fact_claims(self):
        """Claims with the peril resolved (for marts by peril)."""
        return marts.fact_claims(model.claims(self.t), self.dim_policy, model.perils(self.t))

    @cached_property
    def fact_claims_core(self):
        """Claims without the peril lookup (marts that never use it)."""
        return marts.fact_claims(model.claims(self.t), self.dim_policy).drop("peril_code")

    @cached_property
    def fact_premium(self):
        return marts.fact_premium(self.policies, self.customers)

    @cached_property
    def fact_payments(self):
        return marts.fact_payments(model.payments(self.t))

    @cached_property
    def trips(self):
        return model.trips(self.t)
