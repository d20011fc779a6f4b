"""Expectations, quarantine, scorecard and gate (trap 2: NULL rules)."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import quality as K


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, x double, s string")


def rules():
    return [("x_positive", F.col("x") > 0), ("s_known", F.col("s").isin("a", "b"))]


def test_all_pass_all_fail_null_no_rules(spark):
    df = frame(spark, [(1, 1.0, "a"), (2, -1.0, "z"), (3, None, "a"), (4, 2.0, None)])
    passed, q = K.apply_expectations(df, rules())
    assert sorted(r.id for r in passed.collect()) == [1]
    got = {r.id: r._dq_failed_rules for r in q.collect()}
    assert got == {2: ["x_positive", "s_known"], 3: ["x_positive"], 4: ["s_known"]}
    p0, q0 = K.apply_expectations(df, [])
    assert p0.count() == 4 and q0.count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
                          st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), max_size=30))
def test_reconciles_with_nulls(spark, rows):
    df = frame(spark, [(i, x, s) for i, (x, s) in enumerate(rows)])
    row = K.scorecard_row(df, "t", rules(), "2024-01-01").first()
    assert row.passed + row.quarantined == len(rows)


def test_expect_modes(spark):
    df = frame(spark, [(1, 1.0, "a"), (2, -1.0, "a")])
    rows, counts = K.expect(df, dict(rules()), "drop")
    assert rows.count() == 1
    assert counts.first().failed_x_positive == 1
    with pytest.raises(K.ExpectationFailed):
        K.expect(df, dict(rules()), "fail")
    rows, _ = K.expect(df, dict(rules()), "warn")
    assert rows.count() == 2


def test_scorecard_view_latest(spark):
    sc = spark.createDataFrame(
        [("t", 1, 1, "2024-01-01"), ("t", 3, 1, "2024-02-01"), ("u", 0, 0, "2024-01-01")],
        "table_name string, passed long, quarantined long, run_ts string").withColumn("run_ts", F.col("run_ts").cast("timestamp"))
    v = {r.table_name: r for r in K.scorecard_view(sc).collect()}
    assert v["t"].passed == 3 and v["t"].quarantine_rate == 0.25
    assert v["u"].quarantine_rate is None


def test_dq_gate(spark):
    df = frame(spark, [(1, 1.0, "a"), (2, -1.0, "a")])
    out = {r.check: r for r in K.dq_gate(df, [K.Check("neg", F.col("x") < 0), K.Check("nulls", F.col("s").isNull())]).collect()}
    assert out["neg"].status == "FAIL" and out["nulls"].status == "PASS" and out["ALL"].status == "FAIL"


def test_grain_and_unique(spark):
    df = frame(spark, [(1, 1.0, "a"), (1, 2.0, "b"), (2, 1.0, "a")])
    assert K.grain_check(df, ["id"]).first().grain_ok is False
    assert [r.id for r in K.unique_key(df, "id").collect()] == [1]
