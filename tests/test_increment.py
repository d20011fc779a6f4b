"""Incremental tables, marts and change feeds; skipping, sketches, interval
joins."""

import itertools
import os
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.hashing import row_hash, surrogate_key
from strata.operators import incremental, intervals, sketches, skipping
from strata.operators import scd as S
from strata.operators.joins import join_as_of
from strata.plans.hops import Hop, Parent, Silver
from strata.plans.kept import KeptMarts
from strata.session import cut_lineage
from strata.sources.keyed import KeyedTable, replace_keys
from strata.streaming.quarantine import LateQuarantine


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


# -- silver hops ------------------------------------------------------------

def test_hop_survives_a_batch_that_died(spark, tmp):
    parents = Hop("p", lambda df, *c: df.select("k", "ok", "n", *c), [("ok", F.col("ok"))], "k int, ok boolean, n int", newest=("k", "n"))
    kids = Hop("c", lambda df, *c: df.select("id", "k", *c), [("has_parent", F.col("found")), ("small", F.col("id") < 100)], "id int, k int",
               parents=[Parent(parents, "k", "found")])
    silver = Silver(spark, f"{tmp}/bronze", f"{tmp}/silver")

    def land(hop, data, schema):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp}/bronze/{hop.name}")

    land(kids, [(1, 10), (2, 20), (3, None), (200, 10)], "id int, k int")
    assert silver.run(kids) == 4  # before any parent came
    assert silver.passed(kids).count() == 0
    os.makedirs(f"{tmp}/silver/c/log/batch-000000000001-dead")  # what a died batch leaves
    land(parents, [(10, True, 1), (20, False, 1)], "k int, ok boolean, n int")
    for hop in (parents, kids):
        silver.run(hop)
    assert rows(silver.passed(kids), "id", "k") == [(1, 10)]
    assert rows(silver.quarantined(kids), "id", "_dq_failed_rules") == [(2, ["has_parent"]), (200, ["small"]), (3, ["has_parent"])]
    land(parents, [(10, False, 2), (20, True, 2)], "k int, ok boolean, n int")  # one fails now, one passes
    silver.run(parents)
    assert silver.run(kids) == 0  # no bronze row is read again
    assert rows(silver.passed(kids), "id") == [(2,)]
    assert rows(silver.quarantined(kids), "id", "_dq_failed_rules") == [(1, ["has_parent"]), (200, ["has_parent", "small"]), (3, ["has_parent"])]
    before = rows(silver.view(kids), "id", "_row", "_dq_failed_rules")
    silver._rejudge(kids)
    assert rows(silver.view(kids), "id", "_row", "_dq_failed_rules") == before


# -- deltas -----------------------------------------------------------------

def test_left_join_delta_on_random_changes(spark):
    rng = random.Random(4)
    a_schema, b_schema = "id int, k int, v double", "k int, s string"
    a, b = {}, {}
    frame = lambda d, s: spark.createDataFrame([(k, *v) for k, v in d.items()], s)
    state = None
    for _ in range(4):
        old_a, old_b = dict(a), dict(b)
        ch_a, ch_b = {}, {}
        for i in rng.sample(range(20), 7):
            ch_a[i] = None if i in a and rng.random() < 0.3 else (rng.choice([None, 1, 2, 3, 4]), float(rng.randrange(50)))
        for k in rng.sample([1, 2, 3, 4], 2):
            ch_b[k] = None if k in b and rng.random() < 0.4 else (rng.choice("xyz"),)
        for table, changes in ((a, ch_a), (b, ch_b)):
            for k, v in changes.items():
                table.pop(k, None)
                if v is not None:
                    table[k] = v
        delta = lambda old, ch, key, s, width: incremental.keyed_delta(
            frame(old, s) if old else None, spark.createDataFrame([(k, *(v or (None,) * width), v is None) for k, v in ch.items()], s + ", _deleted boolean"), key)
        da, db = delta(old_a, ch_a, "id", a_schema, 2), delta(old_b, ch_b, "k", b_schema, 1)
        d = incremental.left_join_delta(frame(old_a, a_schema) if old_a else None, da, frame(old_b, b_schema) if old_b else None, frame(b, b_schema),
                                        db.select("k"), "k")
        state = incremental.merge_aggregate(state, incremental.aggregate_delta(d, "s", {"total": "v"}), "s")
        state = cut_lineage(state)
        want = frame(a, a_schema).join(frame(b, b_schema), "k", "left").groupBy("s").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.col("v").cast("decimal(38,6)")).cast("decimal(38,6)").alias("total"))
        assert rows(state, "s", "rows", "total") == rows(want, "s", "rows", "total")


def test_kept_marts_replay(spark, tmp):
    marts = KeptMarts(spark, tmp, buckets=4)
    pay = spark.createDataFrame([("a", date(2024, 1, 5), 10.0, 4.0, "PAID", False), ("b", date(2024, 1, 9), 5.0, None, "MISSED", False)],
                                "payment_id string, due_date date, amount_due double, amount_paid double, status string, _deleted boolean")
    marts.apply(0, {"payments": pay})
    marts.apply(0, {"payments": pay})
    marts.apply(1, {"payments": pay.where("payment_id = 'a'").withColumn("_deleted", F.lit(True))})
    assert [tuple(r) for r in marts.billing_leakage().collect()] == [(202401, 5.0, 0.0, 5.0, 1, 1)]


def test_keyed_table_writes_touched_buckets_only(spark, tmp):
    table = KeyedTable(spark, tmp, "k", buckets=32)
    everything = spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(False).alias("_deleted"))
    table.update(everything, replace_keys("k"))
    first = table.current()
    table.update(everything.where("k IN (3, 4)").withColumns({"v": F.lit("b"), "_deleted": F.col("k") == 4}), replace_keys("k"))
    second = table.current()
    assert sum(first[b] != second.get(b) for b in first) <= 2
    assert table.rows().count() == 499 and rows(table.rows().where("v = 'b'"), "k") == [(3,)]
    table.update(everything.limit(0), replace_keys("k"))
    assert table.current() == second


def test_merge_moves_rows_once_and_returns_what_left(spark, tmp):
    ids = ["ab", "AB", "abc", "", "0f" * 32, "ab\n", "é", "x" + "0f" * 32]
    frame = lambda r: spark.createDataFrame(r, "k string, v int, _deleted boolean")
    table = KeyedTable(spark, tmp, "k", buckets=2)
    first, left, came = table.merge({}, frame([(k, n, False) for n, k in enumerate(ids)] + [("gone", 9, True)]))
    assert came.count() == len(ids)
    assert left is None and rows(table.rows(first), "k", "v") == sorted(((k, n) for n, k in enumerate(ids)), key=repr)
    second, left, came = table.merge(first, frame([("ab", 50, False), ("é", None, True), ("new", 7, False), ("never", 1, True), ("0f" * 32, 60, False)]))
    assert rows(came, "k", "v") == sorted([("ab", 50), ("new", 7), ("0f" * 32, 60)], key=repr)
    assert rows(left, "k", "v") == sorted([("ab", 0), ("é", 6), ("0f" * 32, 4)], key=repr)
    want = {**{k: n for n, k in enumerate(ids) if k != "é"}, "ab": 50, "0f" * 32: 60, "new": 7}
    assert rows(table.rows(second), "k", "v") == sorted(want.items(), key=repr)
    assert rows(table.rows(first), "k", "v") == sorted(((k, n) for n, k in enumerate(ids)), key=repr)
    third, left, came = table.merge(second, frame([(k, None, True) for k in want]))
    assert third == {} and came is None and left.count() == len(want)


CHANGE = st.tuples(st.integers(1, 2), st.sampled_from("ab"), st.booleans(), st.integers(1, 6))


@given(st.lists(CHANGE, min_size=1, max_size=9), st.randoms(use_true_random=False))
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
def test_any_split_into_batches_equals_one_batch(spark, changes, rng):
    spec = S.ChangeSpec(keys=["id"], sequence_by="t", scd_type=2, delete_when=F.col("gone"), tracked=["v"], tie_break=["n"])
    data = [(i, v, gone, at(day), n) for n, (i, v, gone, day) in enumerate(changes)]
    feed = lambda r: spark.createDataFrame(r, "id int, v string, gone boolean, t timestamp, n int").coalesce(1)
    cols = ("id", "v", "effective_from", "effective_to", "is_current")
    whole = rows(S.apply_changes(None, feed(data), spec), *cols)
    shuffled = rng.sample(data, len(data))
    cuts = sorted(rng.sample(range(len(data) + 1), min(2, len(data))))
    table = None
    for lo, hi in zip([0, *cuts], [*cuts, len(data)]):
        if hi > lo:
            table = cut_lineage(S.apply_changes(table, feed(shuffled[lo:hi]), spec, keep_tombstones=True))
    table = S.apply_changes(table, feed(shuffled[:2]), spec, keep_tombstones=True)  # replayed
    assert rows(S.visible(table), *cols) == whole


# -- late events ------------------------------------------------------------

def test_late_quarantine_accounts_for_every_event(spark, tmp):
    q = LateQuarantine(spark, tmp, "ts", "id", 3600)
    frame = lambda r: spark.createDataFrame(r, "id int, ts timestamp")
    q.take(frame([(1, at(1, 10)), (1, at(1, 10)), (2, at(1, 11)), (3, None)]), 0)
    q.take(frame([(2, at(1, 11)), (4, at(1, 9)), (5, at(1, 14))]), 1)
    q.take(frame([(5, at(1, 14)), (6, at(1, 13)), (7, at(1, 12))]), 2)
    q.take(frame([(8, at(1, 20))]), 2)  # tried again: nothing happens
    assert q.counts() == {"sent": 10, "kept": 4, "late": 3, "duplicates": 3}
    assert rows(q.kept(), "id") == [(1,), (2,), (5,), (6,)] and rows(q.late(), "id") == [(3,), (4,), (7,)]


# -- skipping ---------------------------------------------------------------

@pytest.mark.parametrize("dims, bits", [(1, 6), (2, 5), (3, 3), (4, 2)])
def test_hilbert_curve_is_continuous(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = skipping.hilbert_index(points, bits)
    assert sorted(place.tolist()) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_indexed_table(spark, tmp):
    df = spark.range(4000).select("id", F.pmod(F.col("id") * 7919, F.lit(4000)).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("d"),
                                  F.when(F.col("id") % 10 > 0, F.concat(F.lit("s"), "id")).alias("s"))
    table = skipping.IndexedTable(spark, tmp, ranges=["k", "d"], lookups=["s"])
    table.append(skipping.curve_by(df, ["k", "d"], 64))
    assert table.index().count() == 64 and table.read().count() == 4000
    for c, span in (("k", (100, 150)), ("d", (date(2024, 3, 1), date(2024, 3, 5)))):
        assert table.files(between={c: span}).count() <= 20
        assert table.read(between={c: span}).count() == df.where(F.col(c).between(*map(F.lit, span))).count()
    assert table.files({"s": "s1234"}).count() <= 6 and rows(table.read({"s": "s1234"}), "id") == ([] if 1234 % 10 == 0 else [(1234,)])
    assert table.read({"s": "nowhere"}).count() == 0
    table.append(df.where("id < 300").repartition(12))
    large = {r["file"] for r in table.index().orderBy(F.desc("length")).limit(64).collect()}
    limit = min(r["length"] for r in table.index().collect() if r["file"] in large)
    assert table.compact(target_bytes=limit * 3, small_bytes=limit) == 12
    assert large <= {r["file"] for r in table.index().collect()} and table.index().count() < 70
    assert table.read().count() == 4300 and rows(table.read({"s": "s123"}), "id") == [(123,), (123,)]
    assert table.compact(target_bytes=limit * 3, small_bytes=10) == 0


def test_pack_fills_bins(spark):
    sizes = [7, 5, 5, 4, 3, 3, 2, 1]
    plan = skipping.pack(spark.createDataFrame([(f"f{i}", n) for i, n in enumerate(sizes)], "file string, length long"), 10).toPandas()
    load = plan.assign(n=[sizes[int(f[1:])] for f in plan.file]).groupby("bin").n.sum()
    assert len(plan) == 8 and load.max() <= 10 and len(load) == 3


# -- sketches ---------------------------------------------------------------

def test_sketches_roll_up(spark):
    df = spark.range(6000).select(F.pmod("id", F.lit(6)).alias("g"), F.pmod("id", F.lit(2)).alias("h"), F.floor(F.col("id") / 4).alias("v"))
    fine = sketches.distinct_sketches(df, ["g", "h"], "v")
    assert all(abs(r["distinct_values"] - 1500) < 100 for r in sketches.estimate(sketches.roll_up(fine, "h")).collect())
    assert sketches.estimate(sketches.roll_up(fine)).head()["rows"] == 6000
    loads = sketches.quantile_sketches(df.withColumn("v", F.when(F.col("v") % 5 > 0, F.col("v"))), "g", "v")
    got = {r["probability"]: r["value"] for r in sketches.profile_sketches(sketches.merge_quantiles(loads, "v"), "v").collect()}
    assert all(abs(got[p] - 1500 * p) < 60 for p in (0.25, 0.5, 0.75))


# -- interval joins ---------------------------------------------------------

@given(st.lists(st.tuples(st.integers(-40, 40), st.sampled_from([0, 1, 3, 7, 8, 50, -1])), max_size=9),
       st.lists(st.tuples(st.integers(-40, 40), st.sampled_from([0, 1, 2, 4, 16, 70])), max_size=9))
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
def test_interval_join_against_all_pairs(spark, left, right):
    a = [(n, n % 2, lo, lo + w) for n, (lo, w) in enumerate(left)] + [(90, 0, None, 5), (91, None, 0, 5)]
    b = [(n, n % 2, lo, lo + w) for n, (lo, w) in enumerate(right)]
    fa = spark.createDataFrame(a, "ai int, g int, alo long, ahi long")
    fb = spark.createDataFrame(b, "bi int, g int, blo long, bhi long")
    want = [(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] is not None and x[2] <= x[3] and max(x[2], y[2]) <= min(x[3], y[3])]
    assert rows(intervals.interval_join(fa, fb, ("alo", "ahi"), ("blo", "bhi"), "g"), "ai", "bi") == sorted(want, key=repr)
    semi = rows(intervals.interval_join(fa, fb, ("alo", "ahi"), ("blo", "bhi"), "g", "left_semi"), "ai")
    assert semi == sorted({(i,) for i, _ in want}, key=repr)


@given(st.lists(st.tuples(st.integers(-20, 20), st.sampled_from([0, 1, 3, 8, 50, -1])), max_size=9),
       st.lists(st.tuples(st.integers(-20, 20), st.sampled_from([0, 1, 4, 16, 70]), st.sampled_from([None, 1.25, -3.0])), max_size=9))
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
def test_interval_totals_against_all_pairs(spark, left, right):
    a = [(n % 5, n % 2, lo, lo + w) for n, (lo, w) in enumerate(left + left[:3])] + [(90, 0, None, 5), (91, None, 0, 5)]
    b = [(n % 2, lo, lo + w, v) for n, (lo, w, v) in enumerate(right)] + [(None, 0, 5, 9.0), (0, None, 5, 9.0)]
    fa = spark.createDataFrame(a, "ai int, g int, alo long, ahi long")
    fb = spark.createDataFrame(b, "g int, blo long, bhi long, v double")
    for on in (["g"], []):
        want = []
        for x in a:
            ok = x[2] is not None and x[2] <= x[3] and (not on or x[1] is not None)
            met = [y[3] for y in b if ok and y[1] is not None and (not on or x[1] == y[0]) and max(x[2], y[1]) <= min(x[3], y[2])]
            if met:
                values = [v for v in met if v is not None]
                want.append((x[0], x[1], x[2], x[3], len(met), sum(values) if values else None))
        r = fb if on else fb.drop("g")
        got = intervals.interval_join(fa, r, ("alo", "ahi"), ("blo", "bhi"), on, "totals", {"s": "v"}, "n")
        assert rows(got.withColumn("s", F.col("s").cast("double")), "ai", "g", "alo", "ahi", "n", "s") == sorted(want, key=repr)
        semi = intervals.interval_join(fa, r, ("alo", "ahi"), ("blo", "bhi"), on, "left_semi")
        assert rows(semi, *fa.columns) == sorted([w[:4] for w in want], key=repr)


def test_totals_and_semi_joins_make_no_pairs(spark):
    """Nine million pairs, of one key."""
    a = spark.range(3000).select("id", F.lit(0).alias("lo"), F.lit(10).alias("hi"))
    b = spark.range(3000).select(F.lit(5).alias("blo"), F.lit(6).alias("bhi"))
    out = intervals.interval_join(a, b, ("lo", "hi"), ("blo", "bhi"), how="totals")
    assert out.agg(F.sum("rows")).first()[0] == 9_000_000
    for df in (out, intervals.interval_join(a, b, ("lo", "hi"), ("blo", "bhi"), how="left_semi")):
        assert "_bin" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_long_intervals_make_few_rows(spark):
    a = spark.createDataFrame([(0, date(1900, 1, 1), date(2100, 1, 1))], "ai int, alo date, ahi date")
    b = spark.range(300).select("id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("blo"))
    out = intervals.interval_join(a, b, ("alo", "ahi"), ("blo", "blo"))
    assert out.count() == 300
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# -- keys -------------------------------------------------------------------

def test_hashes_tell_rows_apart(spark):
    data = [("a||b", "c"), ("a", "b||c"), ("a", "b|"), ("a|", "b"), ("<null>", "x"), (None, "x"), ("x", None), ("\\", "|"), ("\\|", ""), (None, None), ("", None)]
    df = spark.createDataFrame(data, "x string, y string")
    for key in (row_hash(["x", "y"]), surrogate_key(["x", "y"]), surrogate_key(["x", "y"], 128)):
        assert df.select(key.alias("h")).distinct().count() == len(data)


def test_as_of_ignores_versions_without_a_key(spark):
    facts = spark.createDataFrame([(1, at(5)), (None, at(5))], "k int, ts timestamp")
    versions = spark.createDataFrame([(1, "one", at(1), None), (None, "none", at(1), None)], "k int, v string, effective_from timestamp, effective_to timestamp")
    assert rows(join_as_of(facts, versions, "k", "ts"), "k", "v") == [(1, "one"), (None, None)]


def test_money_is_the_same_in_sql(spark):
    from strata.functions.numbers import parse_money
    from strata.functions.sql_functions import register_sql_functions

    register_sql_functions(spark)
    shapes = ["$1234,56", "1.234,56", "$-1,234.50", "12,34,567", "1,234", "-5", "1e3", "$", "", None, " 7 ", "+3.", "1,2,3", "1,23", "-1,234,567.8"]
    df = spark.createDataFrame([(v,) for v in shapes], "v string").select(parse_money("v").alias("a"), F.expr("parse_money(v)").alias("b"))
    assert all(r.a == r.b for r in df.collect())


def test_delay_is_an_interval(spark, tmp):
    """A watermark of a day keeps what an hour would quarantine."""
    q = LateQuarantine(spark, tmp, "ts", "id", int(timedelta(days=1).total_seconds()))
    frame = lambda r: spark.createDataFrame(r, "id int, ts timestamp")
    q.take(frame([(1, at(2, 10))]), 0)
    q.take(frame([(2, at(1, 12)), (1, at(2, 10))]), 1)
    assert q.counts() == {"sent": 3, "kept": 2, "late": 0, "duplicates": 1}
