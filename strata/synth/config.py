"""Generator knobs.

Fixed values: defect rates and business rates of the dirty insurance data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

DEFECT_RATES = {
    "null": 0.02,
    "exact_dup": 0.01,
    "fuzzy_dup": 0.008,
    "casing": 0.05,
    "category": 0.03,
    "range": 0.015,
    "date": 0.02,
    "orphan": 0.01,
    "numeric_as_string": 0.02,
    "late": 0.03,
}

# Business rates.
FRAUD_RATE = 0.04
LATE_PAYMENT_RATE = 0.12
MISSED_PAYMENT_RATE = 0.04
COMMERCIAL_SHARE = 0.18
AUTO_SHARE = 0.60
AGENT_ACTIVE_SHARE = 0.85
POLICY_STATUS_WEIGHTS = {"ACTIVE": 0.72, "CANCELLED": 0.12, "LAPSED": 0.10, "PENDING": 0.06}
PAYMENT_FREQUENCY_WEIGHTS = {"ANNUAL": 0.25, "SEMI_ANNUAL": 0.20, "QUARTERLY": 0.20, "MONTHLY": 0.35}
INSTALLMENTS = {"ANNUAL": 1, "SEMI_ANNUAL": 2, "QUARTERLY": 4, "MONTHLY": 12}
CLAIM_STATES = ["OPEN", "CLOSED", "DENIED", "IN_REVIEW", "REOPENED", "WITHDRAWN"]
CLAIM_STATUS_WEIGHTS = {"OPEN": 0.30, "CLOSED": 0.45, "DENIED": 0.12, "IN_REVIEW": 0.13}
PREMIUM_NORMAL = {"AUTO": (1200.0, 350.0), "PROPERTY": (1600.0, 600.0)}
PREMIUM_FLOOR = 150.0
REGION_ZIP1 = {"Northeast": "0", "South": "3", "Midwest": "5", "West": "9"}
# The dirty spellings that cleaning has to deal with.
INVALID_STATES = ["ca", "tx", "Ny", " FL", "XX", "ZZ", "Calif", "N/A", "99", "us"]
POLICY_STATUS_TYPOS = ["active", "Active ", "ACTIVEE", "cancelled", "LAPSE", "pend", "Pening", "Actv"]
CLAIM_STATUS_TYPOS = ["open", "Closed ", "denied", "in review", "CLOSE", "opn", "Reviewing"]
FRAUD_TRUE = ["true", "Y", "1", "YES"]
FRAUD_FALSE = ["false", "N", "0", "NO"]
# Coverage and peril code lookups per product line.
AUTO_COVERAGES = ["BI", "PD", "COLLC", "COMPC", "MEDPAY", "RENTAL"]
PROPERTY_COVERAGES = ["DWELL", "OTHST", "PERSP", "LOSSU", "PERSL", "MEDPAYP"]
AUTO_PERILS = ["COLL", "COMP", "LIAB", "UMBI", "PIP", "THEFT", "HAIL"]
PROPERTY_PERILS = ["FIRE", "WIND", "FLOOD", "WATER", "THEFTP", "LIABP", "QUAKE", "SMOKE", "VANDAL"]
# A few states per region (first postal digit from REGION_ZIP1).
REGION_STATES = {
    "Northeast": ["NY", "MA", "PA", "NJ"],
    "South": ["TX", "FL", "GA", "NC"],
    "Midwest": ["IL", "OH", "MI", "MN"],
    "West": ["CA", "WA", "AZ", "CO"],
}


@dataclass
class GenConfig:
    seed: int = 42
    customers: int = 10_000
    agents: int = 300
    policies: int = 12_000
    claims: int = 7_000
    events: int = 30_000
    start: str = "2018-01-01"
    end: str = "2026-03-31"
    rates: dict = field(default_factory=lambda: dict(DEFECT_RATES))
