"""Category standardisation."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._col import as_col

# Known typos of policy and claim states and their canonical
# value. Keys are written after upper-casing, trimming and ' ' -> '_'.
POLICY_STATUS_FIXES = {
    "ACTIVEE": "ACTIVE",
    "ACTV": "ACTIVE",
    "LAPSE": "LAPSED",
    "PEND": "PENDING",
    "PENING": "PENDING",
}
CLAIM_STATUS_FIXES = {
    "CLOSE": "CLOSED",
    "OPN": "OPEN",
    "REVIEWING": "IN_REVIEW",
}


def category_key(c) -> Column:
    """Upper-case, trim, collapse whitespace to one ``_``."""
    return F.regexp_replace(F.upper(F.trim(as_col(c).cast("string"))), r"\s+", "_")


def map_category(c, fixes: dict, canonical=None) -> Column:
    """Standardise a category.

    The key is upper-cased, trimmed, with spaces as ``_``; a known typo is
    replaced by its canonical value. When ``canonical`` is given, any key
    that is then not canonical becomes NULL (to be quarantined); otherwise
    the key passes through for a later lookup check (B8).
    """
    key = category_key(c)
    if fixes:
        mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(fixes.items())])
        fixed = F.coalesce(F.try_element_at(mapping, key), key)
    else:
        fixed = key
    if canonical is not None:
        return F.when(fixed.isin(*canonical), fixed)
    return fixed
