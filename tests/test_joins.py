"""Joins: salted = plain, as-of vs brute force, split foreign keys."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import joins as J
import pytest

from strata.operators._util import broadcast_dim
from strata.session import configure


def test_salted_equals_plain(spark):
    big = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    plain = sorted(tuple(r) for r in big.join(small, "k").collect())
    salted = sorted(tuple(r) for r in J.salted_join(big, small, "k", n=16).select("k", "v", "name").collect())
    assert plain == salted


def test_as_of_matches_brute_force(spark):
    random.seed(7)
    vers = []
    for k in range(4):
        t = dt.datetime(2024, 1, 1)
        for i in range(random.randint(1, 6)):
            t2 = t + dt.timedelta(hours=random.randint(1, 60))
            vers.append((k, t, t2 if i < 5 else None, f"v{k}{i}"))
            t = t2
    facts = [(i, random.randint(0, 4), dt.datetime(2024, 1, 1) + dt.timedelta(hours=random.randint(-5, 300))) for i in range(200)]
    V = spark.createDataFrame(vers, "k int, effective_from timestamp, effective_to timestamp, label string")
    Fd = spark.createDataFrame(facts, "id int, k int, ts timestamp")
    got = {r.id: r.label for r in J.join_as_of(Fd, V, "k", "ts", attrs=["label"]).collect()}
    want = {}
    for i, k, t in facts:
        hit = [v for v in vers if v[0] == k and v[1] <= t and (v[2] is None or t < v[2])]
        want[i] = hit[0][3] if hit else None
    assert got == want


def test_split_fk_and_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (10,)], "pk int")
    flags = {r.id: r._fk_ok for r in J.split_fk(child, parent, ("fk", "pk")).collect()}
    assert flags == {1: True, 2: False, 3: False}
    assert sorted(r.id for r in J.orphans(child, parent, ("fk", "pk")).collect()) == [2, 3]


def test_broadcast_hint_only_for_fixed_tables(spark):
    small, big = spark.range(5), spark.range(100)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(J.lookup(big, small, "id", bounded=True)) and not hinted(J.lookup(big, small, "id"))
    assert hinted(big.join(broadcast_dim(small), "id"))


def test_salted_join_types(spark):
    big = spark.createDataFrame([(i % 3, i) for i in range(40)], "k int, v int")
    small = spark.createDataFrame([(0, "a"), (7, "b")], "k int, n string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = J.salted_join(big, small, "k", 8, how)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, big.join(small, "k", how).collect()), key=repr)
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            J.salted_join(big, small, "k", 8, how)


def test_fan_out(spark):
    df = spark.range(3)
    assert J.fan_out(df, "s", ["a", "b"]).count() == 6


def plan_after_run(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_compressed_bytes_do_not_decide_on_a_broadcast(spark, tmp):
    """Some 10 MB of files hold 48 MB of rows."""
    configure(spark)
    spark.range(2_000_000).select("id", F.lit(1.0).alias("v")).write.parquet(f"{tmp}/p")
    p = spark.read.parquet(f"{tmp}/p")
    assert p._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 24 << 20
    out = J.join_inner(spark.range(3_000_000).where("id % 100000 = 0"), p, "id").groupBy("id").agg(F.sum("v"))
    assert "BuildRight" not in plan_after_run(out)


def test_salted_join_does_not_broadcast_its_copies(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    assert "Broadcast" not in plan_after_run(J.salted_join(big, small, "k", n=16))
