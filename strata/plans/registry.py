"""The registered query catalogue: name -> (spark, sf_dir) -> DataFrame,
plus the equivalent DuckDB SQL used as an independent oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.session import configure
from strata.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Registered outputs carry wall-clock timestamps without a time zone
    (``TIMESTAMP_NTZ``, UTC session), like the source tables and the SQL
    oracle; zoned timestamps (e.g. from watermarked streams or windows) are
    converted."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import TimestampType

    if not any(isinstance(f.dataType, TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return naive_timestamps(fn(Tables(spark, sf_dir)))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every catalogue module (they register on import)."""
    from strata.plans import (  # noqa: F401
        q_marts,
        q_clean,
        q_relate,
        q_shape,
        q_change,
        q_quality,
        q_tiles,
        q_stream,
        q_protect,
        q_source,
        q_increment,
    )
