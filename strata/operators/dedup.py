"""De-duplication and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.functions.text import normalize_text
from strata.operators._util import as_list
from strata.operators.ranking import latest_per_key

# Lineage columns that differ between two loads of the same record.
LINEAGE_COLUMNS = ("_source_file", "_ingest_ts", "_rescued_data")


def drop_exact_duplicates(df: DataFrame, exclude=LINEAGE_COLUMNS) -> DataFrame:
    """Fully equal rows collapse to one; lineage columns are ignored
    (otherwise no two loaded rows are ever equal). Hash aggregate with a
    map-side step, so a row repeated a million times is merged per task."""
    cols = [c for c in df.columns if c not in set(exclude)]
    return df.dropDuplicates(cols)


def drop_fuzzy_duplicates(df: DataFrame, key, norm_cols: dict, order, tie_break=None) -> DataFrame:
    """Normalise text columns (``{col: case}``), then keep the newest
    row per key (F1)."""
    out = df
    for c, case in norm_cols.items():
        out = out.withColumn(c, normalize_text(c, case))
    return latest_per_key(out, key, order, tie_break)


def union_by_name(a: DataFrame, b: DataFrame, allow_missing: bool = True) -> DataFrame:
    """D3: stack rows by column name; a column missing on one side is NULL."""
    return a.unionByName(b, allowMissingColumns=allow_missing)


def union_distinct(a: DataFrame, b: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Union with set semantics."""
    return a.unionByName(b, allowMissingColumns=allow_missing).distinct()


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys present more than once, with their count."""
    from pyspark.sql import functions as F

    return df.groupBy(*as_list(key)).agg(F.count("*").alias("n")).where("n > 1")
