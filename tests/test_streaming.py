"""Streaming: replays inside / outside the watermark, late first sight,
windows, expectations in a stream, late report."""

import datetime as dt
import os

from pyspark.sql import functions as F

from strata.sources.ingest import file_stream, stream_to_table
from strata.streaming import ops as S
from strata.streaming.late import late_report


def land(spark, root, i, rows):
    spark.createDataFrame(rows, "event_id long, ts timestamp").coalesce(1).write.parquet(os.path.join(root, f"b{i}"))


def test_dedup_three_batches(spark, tmp):
    """Three arrivals, one micro-batch each (land, then run availableNow)."""
    root = os.path.join(tmp, "in")
    t0 = dt.datetime(2024, 1, 1, 10)
    h = dt.timedelta(hours=1)
    arrivals = [
        [(1, t0), (2, t0 + h)],
        [(1, t0), (3, t0 + 5 * h)],                           # replay of 1 inside the 2-hour delay
        [(2, t0 + h), (4, t0 + 2 * h), (5, t0 + 6 * h)],      # replay of 2 and first sight of 4, behind the watermark
    ]
    land(spark, root, 0, arrivals[0])
    stream = file_stream(spark, os.path.join(root, "b*"), "parquet", "event_id long, ts timestamp")
    out = S.dedup_stream(stream.drop("_source_file", "_ingest_ts"), "ts", ["event_id"], "2 hours")
    rows_per_batch = []
    for i, rows in enumerate(arrivals):
        if i:
            land(spark, root, i, rows)
        q = stream_to_table(out, os.path.join(tmp, "out"), os.path.join(tmp, "ck"))
        rows_per_batch.append(sum(p["numInputRows"] for p in q.recentProgress))
    got = sorted(r.event_id for r in spark.read.parquet(os.path.join(tmp, "out")).collect())
    # watermark after arrival 2 = 15:00 - 2h = 13:00: event 4 (12:00) is late, the replay of 2 too
    assert got == [1, 2, 3, 5]
    assert rows_per_batch == [2, 2, 3]


def test_windowed_counts_and_sessions_batch(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 0, m)) for m in (0, 10, 50)] + [(2, dt.datetime(2024, 1, 2, 1))]
    df = spark.createDataFrame(rows, "u long, ts timestamp")
    w = S.windowed_counts(df, "ts", "1 day", "1 hour").collect()
    assert sorted(r.n for r in w) == [1, 3]
    s = S.session_counts(df, "ts", "30 minutes", "1 hour", "u").collect()
    assert sorted(r.n for r in s) == [1, 1, 2]


def test_stream_expectations_fail(spark, tmp):
    import pytest

    from strata.operators.quality import ExpectationFailed

    root = os.path.join(tmp, "in")
    land(spark, root, 0, [(1, dt.datetime(2024, 1, 1)), (-1, dt.datetime(2024, 1, 1))])
    stream = file_stream(spark, os.path.join(root, "b*"), "parquet", "event_id long, ts timestamp")
    check = S.fail_on_expectations({"positive_id": F.col("event_id") > 0})

    def sink(df, bid):
        check(df, bid).write.mode("append").parquet(os.path.join(tmp, "out"))

    with pytest.raises(Exception) as e:
        stream_to_table(stream, None, os.path.join(tmp, "ck"), foreach_batch=sink)
    assert "expectations failed" in str(e.value) or isinstance(e.value, ExpectationFailed)
    assert not os.path.exists(os.path.join(tmp, "out"))


def test_late_report(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(0, t0), (0, t0 + dt.timedelta(hours=5)), (1, t0 + dt.timedelta(hours=2)), (1, t0 + dt.timedelta(hours=6))]
    df = spark.createDataFrame(rows, "batch long, ts timestamp")
    rep = {r.delay_seconds: r.late_events for r in late_report(df, "ts", "batch", [0, 3600 * 4]).collect()}
    assert rep == {0: 1, 3600 * 4: 0}


def test_schema_drift_after_restart(spark, tmp):
    """A file with a new column; the stream restarts with the evolved
    schema and the column appears (older rows NULL)."""
    import json

    from pyspark.sql.types import StructType

    from strata.sources.ingest import ingest_json_stream
    from strata.sources.schema import drifted_schema

    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"event_id": 1, "speed": 50.0}) + "\n")
    stored = StructType.fromDDL("event_id long, speed double")
    target, ck = os.path.join(tmp, "bronze"), os.path.join(tmp, "ck")
    ingest_json_stream(spark, src, target, ck, stored)
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write(json.dumps({"event_id": 2, "speed": 60.0, "device_fw": "fw-2"}) + "\n")
    wider = drifted_schema(spark, src, "json", stored)
    assert wider.fieldNames() == ["event_id", "speed", "device_fw"]
    ingest_json_stream(spark, src, target, ck, wider)
    out = {r.event_id: r.device_fw for r in spark.read.option("mergeSchema", True).parquet(target).collect()}
    assert out == {1: None, 2: "fw-2"}


def test_batch_sessions_equal_session_window(spark):
    import random

    random.seed(5)
    rows = [(random.randint(0, 3), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=random.randint(0, 3 * 1440))) for _ in range(400)]
    df = spark.createDataFrame(rows, "u long, ts timestamp")
    a = sorted(tuple(r) for r in S.session_counts(df, "ts", "30 minutes", "1 hour", "u").select("u", "session_start", "session_end", "n").collect())
    b = sorted(tuple(r) for r in S.session_counts_batch(df, "ts", 1800, "u").select("u", "session_start", "session_end", "n").collect())
    assert a == b


def test_apply_changes_stream_equals_batch(spark, tmp):
    """J8 stream: two arrivals of CDC rows folded batch by batch equal the
    batch operator over all rows."""
    from strata.operators.scd import ChangeSpec, apply_changes
    from strata.streaming.cdc import apply_changes_stream, read_table

    src = os.path.join(tmp, "cdc")
    t0 = dt.datetime(2024, 1, 1)
    a1 = [(1, "a", "U", t0), (2, "b", "U", t0), (3, "c", "U", t0)]
    a2 = [(1, "a2", "U", t0 + dt.timedelta(hours=1)), (3, None, "D", t0 + dt.timedelta(hours=2)),
          (2, "b-old", "U", t0 - dt.timedelta(hours=1))]
    schema = "id long, name string, op string, ts timestamp"
    spec = ChangeSpec(keys=["id"], sequence_by="ts", scd_type=1, delete_when=F.col("op") == "D")
    for i, rows in enumerate((a1, a2)):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(src, f"b{i}"))
        stream = file_stream(spark, os.path.join(src, "b*"), "parquet", schema).drop("_source_file", "_ingest_ts")
        apply_changes_stream(stream, os.path.join(tmp, "t1"), os.path.join(tmp, "ck1"), spec)
    got = sorted((r.id, r.name) for r in read_table(spark, os.path.join(tmp, "t1")).collect())
    want = sorted((r.id, r.name) for r in apply_changes(None, spark.createDataFrame(a1 + a2, schema), spec).collect())
    assert got == want == [(1, "a2"), (2, "b")]


def test_observed_expectations_in_stream(spark, tmp):
    """Per-batch rule counts from ``observe``, rows unchanged."""
    root = os.path.join(tmp, "in")
    land(spark, root, 0, [(1, dt.datetime(2024, 1, 1)), (-1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 1))])
    stream = file_stream(spark, os.path.join(root, "b*"), "parquet", "event_id long, ts timestamp")
    obs = S.observed_expectations(stream.drop("_source_file", "_ingest_ts"), "dq", {"positive_id": F.col("event_id") > 0})
    q = stream_to_table(obs, os.path.join(tmp, "out"), os.path.join(tmp, "ck"))
    metrics = [p["observedMetrics"]["dq"] for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics and metrics[0]["rows"] == 3 and metrics[0]["passed"] == 2 and metrics[0]["failed_positive_id"] == 1
    assert spark.read.parquet(os.path.join(tmp, "out")).count() == 3
