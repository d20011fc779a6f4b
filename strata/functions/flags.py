"""Boolean and conditional columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._col import as_col, as_lit

# The mixed boolean tokens of the dirty sources (compared
# after lower-casing and trimming).
TRUE_TOKENS = ("true", "y", "1", "yes")
FALSE_TOKENS = ("false", "n", "0", "no")

# Installment states that count as overdue.
OVERDUE_STATES = ("LATE", "MISSED")


def parse_bool(c, true_tokens=TRUE_TOKENS, false_tokens=FALSE_TOKENS) -> Column:
    """Token -> True / False; anything else (``maybe``, NULL) -> NULL."""
    s = F.lower(F.trim(as_col(c).cast("string")))
    return (
        F.when(s.isin(*[t.lower() for t in true_tokens]), F.lit(True))
        .when(s.isin(*[t.lower() for t in false_tokens]), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


def is_overdue(status, overdue_states=OVERDUE_STATES) -> Column:
    """The installment is LATE or MISSED."""
    return as_col(status).isin(*overdue_states)


def case_when(branches, otherwise=None) -> Column:
    """``[(condition, value), ...]`` -> one CASE WHEN column."""
    branches = list(branches)
    if not branches:
        return as_lit(otherwise)
    cond, value = branches[0]
    out = F.when(cond, as_lit(value))
    for cond, value in branches[1:]:
        out = out.when(cond, as_lit(value))
    return out.otherwise(as_lit(otherwise)) if otherwise is not None else out
