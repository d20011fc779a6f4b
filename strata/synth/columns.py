"""Deterministic column generators (Y1, Y2): each value is a function of
(seed, column name, row id) only, so output is identical for any
partitioning, cluster size or task retry."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dirt import hash_unit


def gen_ids(spark: SparkSession, prefix: str, start: int, n: int, width: int, name: str = "id",
            partitions: int | None = None) -> DataFrame:
    """``prefix`` + zero-padded number for ids ``start .. start+n-1``;
    also keeps the numeric ``_n``."""
    r = spark.range(start, start + n, numPartitions=partitions) if partitions else spark.range(start, start + n)
    return r.select(F.col("id").alias("_n"), F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), width, "0")).alias(name))


def uniform(seed: int, name: str, idcol: str = "_n") -> Column:
    return hash_unit(seed, name, idcol)


def uniform_int(seed: int, name: str, lo: int, hi: int, idcol: str = "_n") -> Column:
    """Integer in ``[lo, hi]``."""
    return (F.lit(lo) + F.floor(uniform(seed, name, idcol) * (hi - lo + 1))).cast("int")


def normal(seed: int, name: str, mean: float, sd: float, idcol: str = "_n") -> Column:
    """Box-Muller from two independent hash uniforms."""
    u1 = F.greatest(uniform(seed, name + "#1", idcol), F.lit(1e-12))
    u2 = uniform(seed, name + "#2", idcol)
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)
    return F.lit(mean) + F.lit(sd) * z


def choice(seed: int, name: str, weights: dict, idcol: str = "_n") -> Column:
    """A value drawn with the given weights."""
    u = uniform(seed, name, idcol)
    acc, out = 0.0, None
    items = list(weights.items())
    for value, w in items[:-1]:
        acc += w
        out = F.when(u < acc, F.lit(value)) if out is None else out.when(u < acc, F.lit(value))
    last = F.lit(items[-1][0])
    return out.otherwise(last) if out is not None else last


def pick(seed: int, name: str, values, idcol: str = "_n") -> Column:
    """A uniformly chosen element of ``values``."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(uniform(seed, name, idcol) * len(values)) + 1).cast("int"))


def gen_dates(seed: int, name: str, start: str, end: str, idcol: str = "_n") -> Column:
    """Y2: a date uniform in ``[start, end)``."""
    span = F.datediff(F.to_date(F.lit(end)), F.to_date(F.lit(start)))
    return F.date_add(F.to_date(F.lit(start)), F.floor(uniform(seed, name, idcol) * span).cast("int"))


def gen_timestamps(seed: int, name: str, start: str, end: str, idcol: str = "_n") -> Column:
    """Y2: a second-precision timestamp uniform in ``[start, end)``."""
    s = F.unix_timestamp(F.lit(start).cast("timestamp"))
    e = F.unix_timestamp(F.lit(end).cast("timestamp"))
    return F.timestamp_seconds(s + F.floor(uniform(seed, name, idcol) * (e - s)))
