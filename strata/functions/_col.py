"""Small helpers shared by the column-function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def as_lit(v) -> Column:
    """Accept a literal or a Column."""
    return v if isinstance(v, Column) else F.lit(v)
