"""Layout (compaction, clustering, skew) and protection policies."""

import os

from pyspark.sql import functions as F

from strata.operators import layout as Q
from strata.operators.protect import Caller, apply_policies, row_filter


def test_compact(spark, tmp):
    src = os.path.join(tmp, "small")
    spark.range(1000).repartition(20).write.parquet(src)
    n = Q.compact(spark, src, os.path.join(tmp, "big"), target_bytes=1 << 30)
    assert n == 1
    assert spark.read.parquet(os.path.join(tmp, "big")).count() == 1000


def test_cluster_by_skips_files(spark, tmp):
    df = spark.range(10000).select(F.pmod(F.col("id") * 7919, F.lit(10000)).alias("k"))
    df.repartition(8).write.parquet(os.path.join(tmp, "raw"))
    Q.cluster_by(df, "k", 8).write.parquet(os.path.join(tmp, "clustered"))
    raw = Q.files_touched(spark, os.path.join(tmp, "raw"), "k", 100, 200).first()
    clu = Q.files_touched(spark, os.path.join(tmp, "clustered"), "k", 100, 200).first()
    assert raw.files_touched == raw.files and clu.files_touched == 1


def test_key_skew(spark):
    df = spark.createDataFrame([(0,)] * 50 + [(i,) for i in range(1, 11)], "k int")
    s, top = Q.key_skew(df, "k")
    r = s.first()
    assert r.keys == 11 and r.max_rows == 50 and r.median_rows == 1.0
    assert top.first().k == 0


def test_policies_and_filters(spark):
    df = spark.createDataFrame([("a@x.com", "US", 1.0), ("b@y.com", "EU", 2.0)], "email string, region string, bal double")
    out = apply_policies(df, {"email": "pii", "bal": "fin"}, {"pii": "email", "fin": "null"}, Caller({"finance"}),
                         exempt_groups={"fin": "finance"}).collect()
    assert out[0].email == "***@x.com" and out[0].bal == 1.0
    assert row_filter(df, "region", Caller(attrs={"region": "EU"})).count() == 1
    assert row_filter(df, "region", Caller(groups={"admins"})).count() == 2
    assert row_filter(df, "region", Caller()).count() == 0
