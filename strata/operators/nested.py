"""Nested data and generated rows (H1-H6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators._util import as_list


def explode_lines(df: DataFrame, keys, array_col: str, keep_empty: bool = False, position: str | None = None) -> DataFrame:
    """H1/H2: one row per array element with the struct flattened.

    ``keep_empty=True`` (``explode_outer``) keeps parents whose array is
    empty or NULL, with NULL element fields. ``position`` names a 0-based
    element index column.
    """
    fn = F.posexplode_outer if keep_empty else F.posexplode
    pos = position or "_pos"
    out = df.select(*as_list(keys), fn(array_col).alias(pos, "_el"))
    el_type = df.schema[array_col].dataType.elementType
    from pyspark.sql.types import StructType

    if isinstance(el_type, StructType):
        out = out.select(*as_list(keys), pos, "_el.*")
    else:
        out = out.withColumnRenamed("_el", array_col)
    return out if position else out.drop(pos)


def struct_fields(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """H3: flatten an optional struct into columns (NULL struct -> NULL
    fields)."""
    fields = df.schema[col].dataType.fieldNames()
    p = f"{col}_" if prefix is None else prefix
    return df.select(*[c for c in df.columns if c != col], *[F.col(f"{col}.{f}").alias(f"{p}{f}") for f in fields])


def date_spine(spark_or_bounds, start=None, end=None, step: str = "1 day", name: str = "date") -> DataFrame:
    """H4: every date from ``start`` to ``end`` inclusive.

    Either ``date_spine(spark, "2018-01-01", "2027-12-31")`` or
    ``date_spine(bounds_df)`` where ``bounds_df`` has one row with columns
    ``start`` and ``end`` (e.g. the min and max of a table's dates), so the
    spine follows the data.
    """
    if isinstance(spark_or_bounds, DataFrame):
        bounds = spark_or_bounds
    else:
        bounds = spark_or_bounds.range(1).select(F.to_date(F.lit(start)).alias("start"), F.to_date(F.lit(end)).alias("end"))
    return bounds.select(F.explode(F.sequence(F.col("start"), F.col("end"), F.expr(f"INTERVAL {step}"))).alias(name))


def month_ceiling(c):
    """The first month start on or after a date."""
    d = F.to_date(c if not isinstance(c, str) else F.col(c))
    t = F.trunc(d, "month")
    return F.when(d == t, t).otherwise(F.add_months(t, 1))


def expand_months(df: DataFrame, start: str, end: str, name: str = "month") -> DataFrame:
    """H5: one row per month start ``m`` with ``start <= m <= end``.

    A 365-day term starting mid-month yields 12 rows. Rows whose window
    holds no month start yield none. Generated per row: no join, no
    shuffle, the row count grows only with the months each row spans.
    """
    lo = month_ceiling(start)
    hi = F.trunc(F.to_date(F.col(end)), "month")
    months = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH")))
    return df.withColumn(name, F.explode(months))


def json_field(c, path: str, cast: str | None = None):
    """H6: a field of a JSON text column (``$.k``); NULL when absent."""
    out = F.get_json_object(F.col(c) if isinstance(c, str) else c, path)
    return out.try_cast(cast) if cast else out
