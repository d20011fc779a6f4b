"""Stored sketches that roll up without the rows.

Distinct counts: HyperLogLog sketches per fine group, united to any coarser
group. Quantiles: KLL sketches per load, merged over any set of loads. Both are
aggregate functions of Spark with a partial step, bounded in size whatever the
number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators._util import as_list

LG_K = 12  # 4,096 registers: a relative standard error of 1.04 / sqrt(4096) = 1.6 %
KLL_K = 200  # rank error of about 1.7 % at 99 % confidence


def distinct_sketches(df: DataFrame, by, column: str, lg_k: int = LG_K) -> DataFrame:
    """Per group: rows and a sketch of the distinct values of ``column``
    (NULL is no value)."""
    return df.groupBy(*as_list(by)).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(column, lg_k).alias("sketch"))


def roll_up(sketches: DataFrame, by=()) -> DataFrame:
    """Coarser groups (no columns: everything) from stored sketches."""
    return sketches.groupBy(*as_list(by)).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketches: DataFrame) -> DataFrame:
    """The sketch replaced by its estimate ``distinct_values``."""
    return sketches.withColumn("distinct_values", F.hll_sketch_estimate("sketch")).drop("sketch")


def quantile_sketches(df: DataFrame, by, columns, k: int = KLL_K) -> DataFrame:
    """Per group: rows, and for each numeric column a KLL sketch of its
    values as doubles (NULL left out)."""
    return df.groupBy(*as_list(by)).agg(F.count(F.lit(1)).alias("rows"), *[
        F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in as_list(columns)])


def merge_quantiles(sketches: DataFrame, columns, by=()) -> DataFrame:
    """The sketches of many loads as one per group (no columns: one row)."""
    return sketches.groupBy(*as_list(by)).agg(F.sum("rows").alias("rows"), *[F.kll_merge_agg_double(c).alias(c) for c in as_list(columns)])


def profile_sketches(sketches: DataFrame, columns, probabilities=(0.25, 0.5, 0.75), by=()) -> DataFrame:
    """Long form of merged sketches: the groups, column_name, n (values),
    probability, value."""
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.kll_sketch_get_n_double(c).alias("n"), F.lit(float(p)).alias("probability"),
                              F.kll_sketch_get_quantile_double(c, F.lit(float(p))).alias("value"))
                     for c in as_list(columns) for p in probabilities])
    return sketches.select(*as_list(by), F.inline(rows))
