"""Numeric parsing and arithmetic (B2, B17, B20, B21, exact sums)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._col import as_col, as_lit

# Shapes of an amount once the currency sign and white space are gone. A comma
# before one or two last digits is a decimal comma; commas before groups of
# three are thousands separators. Anything else is ambiguous: NULL.
DECIMAL_COMMA = r"^-?\d+,\d{1,2}$"
PLAIN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
GROUPED = r"^-?\d{1,3}(,\d{3})+(\.\d+)?$"


def parse_money(c) -> Column:
    """B2: ``"$1,234.50"``, ``"  1200.0 "``, ``"1234,56"``, ``"$-50.00"`` -> double.

    ``"$1234,56"`` is 1234.56. Unparseable or ambiguous text (``"abc"``, empty,
    ``"1.234,56"``) gives NULL, never an error.
    """
    s = F.regexp_replace(as_col(c).cast("string"), r"[$\s]", "")
    cleaned = (
        F.when(s.rlike(PLAIN), s)
        .when(s.rlike(DECIMAL_COMMA), F.replace(s, F.lit(","), F.lit(".")))
        .when(s.rlike(GROUPED), F.replace(s, F.lit(","), F.lit("")))
    )
    return cleaned.try_cast("double")


def safe_ratio(numerator, denominator) -> Column:
    """Numerator / denominator, NULL when the denominator is 0 or NULL."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def in_range(c, lo=None, hi=None) -> Column:
    """``lo <= c <= hi``; an open side is omitted. NULL stays NULL."""
    c = as_col(c)
    if lo is not None and hi is not None:
        return c.between(as_lit(lo), as_lit(hi))
    if lo is not None:
        return c >= as_lit(lo)
    if hi is not None:
        return c <= as_lit(hi)
    return F.lit(True)


def within_parent_limit(child, parent) -> Column:
    """Child amount does not exceed the parent's limit."""
    return as_col(child) <= as_col(parent)


def exact_sum(c, scale: int = 6) -> Column:
    """Order-independent sum, as the nearest double to the exact total.

    Values are added as ``decimal(38, scale)``: a column of that type or of a
    smaller scale is added as it is, a double without a declared scale keeps
    ``scale`` decimals. Totals stay exact up to 38 digits (no 64-bit count of
    units that could overflow), and do not depend on partitioning.
    """
    return F.sum(as_col(c).cast(f"decimal(38,{scale})")).cast("double")


def exact_avg(c, scale: int = 6) -> Column:
    """Exact sum / count of non-NULL values."""
    return F.try_divide(exact_sum(c, scale), F.count(as_col(c)).cast("double"))
