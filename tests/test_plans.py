"""Physical-plan properties the operators are built for (checked with
``explain``-level plan strings on the sf0.001 tables)."""

import __spark_entry__ as E
from strata.plans import registry

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "select_filter")
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_discount), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in p


def test_fixed_size_lookups_are_broadcast(spark):
    p = plan(spark, "join_lookup")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_newest_per_key_is_a_partial_aggregate_not_a_window(spark):
    p = plan(spark, "latest_per_key")
    assert "Window" not in p
    assert "partial_max_by" in p


def test_ordered_per_key_work_is_split_by_time_bucket(spark):
    for name in ("scd2_history", "join_as_of", "session_counts"):
        p = plan(spark, name)
        windows = [line for line in p.splitlines() if "Window [" in line]
        assert windows, name
        # every per-key window also partitions by the bucket column, except
        # the ones over the one-row-per-bucket summary (ordered by _b)
        for w in windows:
            assert "_b" in w, (name, w)


def test_money_sums_are_decimal_partial_aggregates(spark):
    p = plan(spark, "loss_ratio_monthly")
    partial = [line for line in p.splitlines() if "partial_sum" in line]
    assert partial and all("decimal(38,6)" in line for line in partial)


def test_no_cartesian_products(spark):
    E.queries()
    landed = ("stream_", "ingest_", "copy_", "snapshot_", "write_", "list_", "schema_drift", "compact_", "cluster_", "read_json")
    for name in registry.QUERIES:
        if name.startswith(landed):  # they return a plain read of their target
            continue
        p = plan(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_ordered_work_reads_its_input_once(spark):
    """Both branches of ``neighbors`` share one exchange: what ran has one
    scan of the events per evaluation of the input."""
    for name, most in (("scd2_history", 1), ("version_at", 1), ("join_as_of", 4), ("agent_performance", 6)):
        df = E.queries()[name](spark, SF)
        df.collect()
        ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert ran.count("FileScan") <= most, (name, ran.count("FileScan"))
