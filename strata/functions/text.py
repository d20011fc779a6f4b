"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._col import as_col


def collapse_spaces(c) -> Column:
    """Trim and collapse every run of whitespace to one space."""
    return F.trim(F.regexp_replace(as_col(c), r"\s+", " "))


def normalize_text(c, case: str | None = None) -> Column:
    """B1: trim, collapse inner whitespace runs, then apply ``case``.

    ``case`` is one of ``None``, ``"upper"``, ``"lower"``, ``"title"``.
    Trim alone misses the doubled inner spaces the dirty sources carry.
    """
    out = collapse_spaces(c)
    if case is None:
        return out
    if case == "upper":
        return F.upper(out)
    if case == "lower":
        return F.lower(out)
    if case == "title":
        return F.initcap(out)
    raise ValueError(f"unknown case {case!r}")


def split_part(c, sep: str, index: int) -> Column:
    """The ``index``-th (0-based) piece of ``c`` split on the literal
    ``sep``; NULL when out of range (``get`` never raises under ANSI)."""
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.get(F.split(as_col(c), pattern), index)


def word_count(c) -> Column:
    """Number of whitespace-separated words in the whole text."""
    t = F.trim(as_col(c))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))
