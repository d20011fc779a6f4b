"""SCD2 / SCD1 / CDC edge rows (trap 11) and invariants."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import Window

from strata.operators import scd as S
from strata.session import cut_lineage

T = ["name", "city"]


def ts(d):
    return dt.datetime(2024, 1, d)


def src(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, city string, updated_at timestamp")


def dim0(spark):
    return S.scd2_seed(src(spark, [(1, "a", "x", ts(1)), (2, "b", "y", ts(1)), (3, "c", None, ts(1)), (5, "e", "q", ts(5))]),
                       "id", T, "updated_at")


def versions(df):
    return sorted(((r.id, r.name, r.city, r.effective_from.day, r.effective_to.day if r.effective_to else None, r.is_current)
                   for r in df.collect()), key=repr)


def test_seed(spark):
    d = dim0(spark)
    assert d.count() == 4 and d.where("is_current").count() == 4


def test_apply_edge_rows(spark):
    d = dim0(spark)
    batch = src(spark, [
        (1, "a", "x", ts(3)),            # unchanged
        (2, "b", "z", ts(2)),            # change 1 of 2 in one batch
        (2, "b", "w", ts(4)),            # change 2 of 2: only the newest applies
        (3, "c", "v", ts(3)),            # NULL tracked value -> value
        (4, "d", "u", ts(3)),            # new key
        (5, "e", "r", ts(2)),            # stale (older than current)
    ])
    nxt = S.scd2_apply(d, batch, "id", T, "updated_at")
    assert versions(nxt) == sorted([
        (1, "a", "x", 1, None, True),
        (2, "b", "y", 1, 4, False), (2, "b", "w", 4, None, True),
        (3, "c", None, 1, 3, False), (3, "c", "v", 3, None, True),
        (4, "d", "u", 3, None, True),
        (5, "e", "q", 5, None, True),
    ], key=repr)
    stale = S.scd2_stale(d, batch, "id", T, "updated_at")
    assert [r.id for r in stale.collect()] == [5]
    # replaying the same batch is a no-op
    assert versions(S.scd2_apply(nxt, batch, "id", T, "updated_at")) == versions(nxt)


def test_equal_timestamp_tie_is_deterministic(spark):
    d = dim0(spark)
    batch = src(spark, [(1, "a", "p", ts(6)), (1, "a", "q", ts(6))])
    outs = {tuple(versions(S.scd2_apply(d, batch.repartition(n), "id", T, "updated_at"))) for n in (1, 3, 5)}
    assert len(outs) == 1


def test_history_invariants(spark):
    rows = [(k, f"n{(i // 2) % 3}", "c", dt.datetime(2024, 1, 1 + i % 28, i % 24)) for k in range(5) for i in range(40)]
    h = S.scd2_history(src(spark, rows), "id", T, "updated_at")
    cur = h.where("is_current").groupBy("id").count().collect()
    assert all(r["count"] == 1 for r in cur) and len(cur) == 5
    w = Window.partitionBy("id").orderBy("effective_from")
    gaps = h.withColumn("prev_to", F.lag("effective_to").over(w)).where(
        F.col("prev_to").isNotNull() & (F.col("prev_to") != F.col("effective_from")))
    assert gaps.count() == 0
    # no two consecutive versions carry the same values
    same = h.withColumn("ph", F.lag("_hash").over(w)).where(F.col("ph") == F.col("_hash"))
    assert same.count() == 0


def test_history_matches_brute_force(spark):
    import random

    random.seed(3)
    rows = [(random.randint(0, 3), random.choice("ab"), "c", dt.datetime(2024, 1, random.randint(1, 20), random.randint(0, 23), random.randint(0, 59)))
            for _ in range(300)]
    rows = list({(r[0], r[3]): r for r in rows}.values())  # unique (key, time)
    h = S.scd2_history(src(spark, rows), "id", T, "updated_at", unit="hour")
    want = []
    for k in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == k), key=lambda r: r[3])
        kept = [r for i, r in enumerate(seq) if i == 0 or (seq[i - 1][1], seq[i - 1][2]) != (r[1], r[2])]
        for i, r in enumerate(kept):
            want.append((k, r[1], r[3], kept[i + 1][3] if i + 1 < len(kept) else None))
    got = [(r.id, r.name, r.effective_from, r.effective_to) for r in h.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_version_at_and_current(spark):
    rows = [(1, "a", "x", ts(1)), (1, "b", "x", ts(5)), (1, "c", "x", ts(9))]
    h = S.scd2_history(src(spark, rows), "id", T, "updated_at")
    assert [r.name for r in S.version_at(h, "2024-01-06").collect()] == ["b"]
    cur = S.scd2_current(h, "id").collect()
    assert [r.name for r in cur] == ["c"] and cur[0].sk is not None


def test_upsert_and_cdc(spark):
    target = src(spark, [(1, "a", "x", ts(1)), (2, "b", "y", ts(5))])
    changes = src(spark, [(1, "a2", "x", ts(2)), (2, "old", "y", ts(3)), (3, "c", "z", ts(2))])
    up = {r.id: r.name for r in S.upsert(target, changes, "id", "updated_at").collect()}
    assert up == {1: "a2", 2: "b", 3: "c"}
    feed = changes.withColumn("op", F.when(F.col("id") == 3, "D").otherwise("U"))
    spec = S.ChangeSpec(keys=["id"], sequence_by="updated_at", scd_type=1, delete_when=F.col("op") == "D")
    out = {r.id: r.name for r in S.apply_changes(target.withColumn("op", F.lit("U")), feed, spec).collect()}
    assert out == {1: "a2", 2: "b"}


def test_cdc_type2_extends_the_target(spark):
    feed = lambda rows: spark.createDataFrame(rows, "id int, name string, op string, t timestamp")
    spec = S.ChangeSpec(keys=["id"], sequence_by="t", scd_type=2, delete_when=F.col("op") == "D", tracked=["name"])
    rows = [(1, "a", "U", ts(1)), (1, "b", "U", ts(3)), (1, None, "D", ts(5)), (1, "c", "U", ts(8)), (2, "x", "U", ts(2)), (2, "y", "U", ts(6)),
            (3, "only", "U", ts(4)), (None, "n", "U", ts(1)), (None, "m", "U", ts(7))]
    show = lambda df: sorted(((r.id, r.name, r.effective_from, r.effective_to, r.is_current) for r in df.collect()), key=repr)
    whole = show(S.apply_changes(None, feed(rows), spec))
    assert (1, "b", ts(3), ts(5), False) in whole and (3, "only", ts(4), None, True) in whole
    for cut in (2, 6):
        first = cut_lineage(S.apply_changes(None, feed([r for r in rows if r[3] < ts(cut)]), spec))
        second = cut_lineage(S.apply_changes(first, feed([r for r in rows if r[3] >= ts(cut)]), spec))
        assert show(second) == whole
        assert show(S.apply_changes(second, feed([r for r in rows if r[3] >= ts(cut)]), spec)) == whole  # replayed
    # a late change finds its place between the versions
    late = [r for r in rows if r[3] != ts(3)]
    assert show(S.apply_changes(cut_lineage(S.apply_changes(None, feed(late), spec)), feed([rows[1]]), spec)) == whole


def test_cdc_type1_tombstones_and_null_times(spark):
    feed = lambda rows: spark.createDataFrame(rows, "id int, name string, op string, t timestamp")
    spec = S.ChangeSpec(keys=["id"], sequence_by="t", scd_type=1, delete_when=F.col("op") == "D")
    first = S.apply_changes(None, feed([(1, "a", "D", ts(3)), (2, "b", "U", ts(3))]), spec, keep_tombstones=True)
    second = S.apply_changes(first, feed([(1, "old", "U", ts(2)), (2, "old", "U", None)]), spec, keep_tombstones=True)
    assert [(r.id, r.name) for r in S.visible(second).collect()] == [(2, "b")]
    dim = S.scd2_seed(src(spark, [(1, "a", "x", None)]), "id", T, "updated_at")
    nxt = S.scd2_apply(dim, src(spark, [(1, "b", "x", ts(2))]), "id", T, "updated_at")
    assert sorted((r.name, r.is_current) for r in nxt.collect()) == [("a", False), ("b", True)]
