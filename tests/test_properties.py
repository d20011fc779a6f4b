"""Property-based invariants (hypothesis) from the test strategy: salted
join = plain join, explode row count = sum of array sizes, newest-per-key
independent of partitioning, SCD2 replay is a no-op."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import joins as J
from strata.operators import nested as H
from strata.operators import ranking as R
from strata.operators import scd as S

SETTINGS = settings(max_examples=12, deadline=None)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(-50, 50)), min_size=0, max_size=60),
       st.lists(st.integers(0, 6), min_size=0, max_size=8, unique=True), st.integers(1, 9))
def test_salted_join_equals_join(spark, big, small, n):
    b = spark.createDataFrame(big, "k int, v int")
    s = spark.createDataFrame([(k, f"s{k}") for k in small], "k int, name string")
    plain = sorted(tuple(r) for r in b.join(s, "k").select("k", "v", "name").collect())
    salted = sorted(tuple(r) for r in J.salted_join(b, s, "k", n=n).select("k", "v", "name").collect())
    assert plain == salted


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=5)), max_size=25))
def test_explode_count_is_sum_of_sizes(spark, arrays):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "id int, arr array<int>")
    assert H.explode_lines(df, "id", "arr").count() == sum(len(a) for a in arrays if a)
    assert H.explode_lines(df, "id", "arr", keep_empty=True).count() == sum(max(1, len(a or [])) for a in arrays)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.text("ab", max_size=2)),
                max_size=40))
def test_latest_per_key_partition_free(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v string")
    a = sorted(tuple(r) for r in R.latest_per_key(df, "k", ["t"]).collect())
    b = sorted(tuple(r) for r in R.latest_per_key(df.repartition(5), "k", ["t"]).collect())
    assert a == b
    assert len(a) == len({r[0] for r in rows})


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["x", "y", None]), st.integers(1, 20)), max_size=30))
def test_scd2_replay_is_noop(spark, rows):
    schema = "id int, city string, updated_at timestamp"
    src = spark.createDataFrame([(k, c, dt.datetime(2024, 1, d)) for k, c, d in rows], schema)
    dim = S.scd2_seed(spark.createDataFrame([(0, "x", dt.datetime(2024, 1, 1))], schema), "id", ["city"], "updated_at")
    once = S.scd2_apply(dim, src, "id", ["city"], "updated_at")
    twice = S.scd2_apply(once, src, "id", ["city"], "updated_at")
    key = lambda r: (r.id, str(r.city), r.effective_from, str(r.effective_to), r.is_current)
    assert sorted(map(key, once.collect())) == sorted(map(key, twice.collect()))
    assert once.where("is_current").groupBy("id").count().where("count > 1").count() == 0
