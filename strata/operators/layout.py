"""File layout: compaction, clustering, skew profile (Q1-Q3)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators._util import as_list


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = 128 * 1024 * 1024, fmt: str = "parquet") -> int:
    """Q1: rewrite many small files as about ``total / target_bytes`` files
    in a new folder (the source is never overwritten in place). The total
    size comes from the file listing, not from reading the data. Returns
    the number of output files requested."""
    from strata.sources.files import list_landing

    total = list_landing(spark, src).agg(F.sum("length")).first()[0] or 0
    n = max(1, math.ceil(total / target_bytes))
    spark.read.format(fmt).load(src).repartition(n).write.format(fmt).mode("errorifexists").save(dst)
    return n


def cluster_by(df: DataFrame, keys, files: int) -> DataFrame:
    """Q2: range-partition by ``keys`` into ``files`` partitions and sort
    inside each, so each written file covers a narrow key range and
    predicates on the keys skip files through parquet min/max statistics."""
    keys = as_list(keys)
    return df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)


def file_ranges(spark: SparkSession, path: str, col: str) -> DataFrame:
    """Per data file: min and max of ``col`` (one aggregate grouped by the
    hidden file-path column)."""
    df = spark.read.parquet(path)
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(col).alias("lo"), F.max(col).alias("hi"))


def files_touched(spark: SparkSession, path: str, col: str, lo, hi) -> DataFrame:
    """Q2 proof: how many files a range predicate ``lo <= col <= hi`` must
    open (files whose [min, max] overlaps it) out of all files."""
    r = file_ranges(spark, path, col)
    overlap = (F.col("hi") >= F.lit(lo)) & (F.col("lo") <= F.lit(hi))
    return r.agg(F.count(F.lit(1)).alias("files"), F.count_if(overlap).alias("files_touched"))


def key_skew(df: DataFrame, key, top: int = 3) -> tuple[DataFrame, DataFrame]:
    """Q3: rows per key: (keys, median, max, max / median) and the ``top``
    heaviest keys. The per-key counts are a partial aggregate; the median
    buffer holds distinct count values only."""
    keys = as_list(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    summary = counts.agg(
        F.count(F.lit(1)).alias("keys"),
        F.percentile(F.col("rows"), 0.5).alias("median_rows"),
        F.max("rows").alias("max_rows"),
    ).withColumn("skew_ratio", F.col("max_rows") / F.col("median_rows"))
    heavy = counts.orderBy(F.col("rows").desc(), *[F.col(k) for k in keys]).limit(top)
    return summary, heavy
