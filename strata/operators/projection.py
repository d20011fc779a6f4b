"""Typed projection, defaults and lookups of codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast_types(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """``{column: type}`` -> columns cast with ``try_cast`` (text that
    does not convert becomes NULL instead of failing the job)."""
    return df.select(*[F.col(c).try_cast(spec[c]).alias(c) if c in spec else F.col(c) for c in df.columns])


def fill_nulls(df: DataFrame, values: dict) -> DataFrame:
    """Per-column defaults."""
    return df.na.fill(values)


def validate_category(df: DataFrame, col: str, ref: DataFrame, ref_key: str, flag: str = "_invalid") -> DataFrame:
    """Values absent from the lookup become NULL and are flagged for
    quarantine. The lookup is de-duplicated first, so the join never
    multiplies rows."""
    from strata.operators.joins import lookup

    keys = ref.select(F.col(ref_key).alias("_ref")).distinct()
    out = lookup(df, keys, (col, "_ref"))
    return out.withColumn(flag, F.col(col).isNotNull() & F.col("_ref").isNull()) \
        .withColumn(col, F.col("_ref")).drop("_ref")


def region_from_prefix(df: DataFrame, code: str, ref: DataFrame, ref_prefix: str, length: int = 1) -> DataFrame:
    """The first ``length`` characters of ``code`` resolve a region
    through a small lookup (broadcast after a size check)."""
    from strata.operators.joins import lookup

    d = df.withColumn("_prefix", F.substring(F.col(code), 1, length))
    return lookup(d, ref, ("_prefix", ref_prefix)).drop("_prefix", ref_prefix)
