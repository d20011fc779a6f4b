"""Shared helpers for operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (list, tuple)):
        return list(x)
    return [x]


def key_pairs(key) -> list[tuple[str, str]]:
    """``"k"`` / ``["a", "b"]`` / ``("child_k", "parent_k")`` /
    ``[("child_k", "parent_k"), ...]`` -> list of (child, parent) pairs."""
    if isinstance(key, tuple) and len(key) == 2 and all(isinstance(k, str) for k in key):
        return [key]
    out = []
    for k in as_list(key):
        out.append(k if isinstance(k, tuple) else (k, k))
    return out


def broadcast_dim(df: DataFrame) -> DataFrame:
    """Q4: broadcast hint for a table whose size is fixed by its nature (a
    nation list, one row per partition). Tables that grow with the data get
    no hint: plan statistics and AQE's measured sizes decide."""
    return F.broadcast(df)
