"""Queries: streaming (S2-S5) and windows over the events table.

The streaming queries land the events (with derived replays / dirt) slice
by slice in a run folder under the shared checkpoint folder and run a real
Structured Streaming query after each arrival (``availableNow``, one
checkpoint), then return what the sink committed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.sources.ingest import file_stream, stream_to_table
from strata.streaming import ops as S
from strata.streaming.late import late_report as late_report_op
from strata.streaming.runs import run_dir
from strata.plans.registry import query

FILES = 3  # arrivals (micro-batches) per streaming query, in event id order
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]


def _slices(t, replays: bool = False, dirty: bool = False):
    """The events in arrival order (event id) cut into FILES slices;
    replays of 'click' events arrive with their original, those of the last
    hour before a cut in the next slice, so inside a two-hour watermark."""
    e = t.events.select(*EVENT_COLS)
    if dirty:
        e = e.withColumn("value", F.when(F.pmod("event_id", F.lit(50)) == 0, -F.col("value")).otherwise(F.col("value")))
    top = t.events.agg(F.max("event_id") + 1).scalar()
    e = e.withColumn("_file", F.floor(F.col("event_id") * FILES / top).cast("int"))
    if replays:
        ends = e.groupBy("_file").agg(F.max("ts").alias("_end"))  # one row a slice
        r = e.where(F.col("event_type") == "click").join(F.broadcast(ends), "_file")
        soon = F.col("ts") >= F.col("_end") - F.make_interval(hours=F.lit(1))
        r = r.withColumn("_file", F.least(F.col("_file") + F.when(soon, 1).otherwise(0), F.lit(FILES - 1))).drop("_end")
        e = e.unionByName(r.select(*e.columns))
    return e


def _run(t, name, out_fn, replays: bool = False, dirty: bool = False):
    """Land one slice at a time and run the same streaming query over what
    has arrived (``availableNow``, shared checkpoint): every run is one
    micro-batch of new files, as in a scheduled incremental job, and the
    watermark carries over between runs. Returns the committed output."""
    from strata.sources.sinks import move_path

    e = _slices(t, replays, dirty)
    root = run_dir(t.spark, name)
    schema = e.drop("_file").schema
    # all slices are written by one job (one scan of the table) into a
    # staging folder; each arrival then moves one slice into the watched
    # folder, as a landing process would
    e.write.partitionBy("_file").parquet(f"{root}/staging")
    stream = S.event_time(
        file_stream(t.spark, f"{root}/input/part=*", "parquet", schema).drop("_source_file", "_ingest_ts"), "ts")
    out = out_fn(stream)
    for i in range(FILES):
        move_path(t.spark, f"{root}/staging/_file={i}", f"{root}/input/part={i:04d}")
        stream_to_table(out, f"{root}/out", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/out")


@query("stream_dedup", "SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value FROM events")
def stream_dedup(t):
    """Replays (same id, same time) dropped inside a 2-hour watermark;
    state is evicted as the watermark passes."""
    out = _run(t, "stream_dedup", lambda s: S.dedup_stream(s, "ts", ["event_id"], "2 hours"), replays=True)
    return out.select(*EVENT_COLS)


@query("stream_filter", """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type,
       CASE WHEN event_id % 50 = 0 THEN -value ELSE value END AS value
FROM events WHERE (CASE WHEN event_id % 50 = 0 THEN -value ELSE value END) BETWEEN 0 AND 300""")
def stream_filter(t):
    """S3: invalid readings dropped before any stateful step."""
    out = _run(t, "stream_filter", lambda s: S.drop_invalid_stream(s, F.col("value").between(0, 300)), dirty=True)
    return out.select(*EVENT_COLS)


@query("stream_daily_counts", """
WITH w AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
                  CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end, event_type, count(*) AS n
           FROM events GROUP BY 1, 2, 3)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_daily_counts(t):
    """Tumbling daily counts per type, append mode: only windows the
    watermark (max time - 1 hour) has closed are emitted."""
    return _run(t, "stream_daily_counts", lambda s: S.windowed_counts(s, "ts", "1 day", "1 hour", by="event_type"))


@query("session_counts", """
WITH e AS (SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE OR
                  lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS new_session FROM events),
s AS (SELECT *, sum(CAST(new_session AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, CAST(min(ts) AS TIMESTAMP) AS session_start, CAST(max(ts) + INTERVAL 30 MINUTE AS TIMESTAMP) AS session_end, count(*) AS n
FROM s GROUP BY user_id, sid""")
def session_counts(t):
    """Session windows (30-minute gap) per user in batch, hot users split by
    day (same sessions as ``session_window``)."""
    e = S.event_time(t.events.select("user_id", "ts"), "ts")
    return S.session_counts_batch(e, "ts", 30 * 60, "user_id")


LATE_SQL = """
WITH e AS (SELECT event_id // 500 AS batch,
                  CASE WHEN event_id % 33 = 0 THEN ts - (event_id % 7 + 1) * INTERVAL 1 HOUR ELSE ts END AS t FROM events),
b AS (SELECT batch, max(t) AS bmax FROM e GROUP BY batch),
m AS (SELECT batch, max(bmax) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max FROM b),
d AS (SELECT unnest([0, 1800, 3600, 7200, 86400]) AS delay_seconds)
SELECT delay_seconds, count(*) AS events,
       count(*) FILTER (WHERE prev_max IS NOT NULL AND t < prev_max - delay_seconds * INTERVAL 1 SECOND) AS late_events,
       CAST(count(*) FILTER (WHERE prev_max IS NOT NULL AND t < prev_max - delay_seconds * INTERVAL 1 SECOND) AS DOUBLE) / count(*) AS late_share
FROM e JOIN m USING (batch), d GROUP BY delay_seconds"""


@query("late_report", LATE_SQL)
def late_report(t):
    """Share of events each watermark delay would drop (events shifted
    back 1-7 hours on every 33rd id; micro-batches of 500 ids)."""
    e = t.events.select(
        (F.col("event_id") / 500).cast("long").alias("batch"),
        F.when(F.pmod("event_id", F.lit(33)) == 0,
               F.col("ts") - F.make_interval(hours=(F.pmod("event_id", F.lit(7)) + 1).cast("int"))).otherwise(F.col("ts")).alias("ts"))
    return late_report_op(e, "ts", "batch", [0, 1800, 3600, 7200, 86400])


@query("sliding_counts", """
WITH b AS (SELECT event_type, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') AS s1 FROM events),
w AS (SELECT event_type, unnest([s1 - INTERVAL 12 HOUR, s1]) AS window_start FROM b)
SELECT CAST(window_start AS TIMESTAMP) AS window_start, CAST(window_start + INTERVAL 1 DAY AS TIMESTAMP) AS window_end,
       event_type, count(*) AS n
FROM w GROUP BY ALL""")
def sliding_counts(t):
    """Sliding event-time windows (1 day, every 12 hours) per type, batch
    form of ``windowed_counts(slide=...)``."""
    e = S.event_time(t.events.select("event_type", "ts"), "ts")
    w = F.window("ts", "1 day", "12 hours")
    out = e.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n")


@query("weekly_counts", """
SELECT CAST(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS TIMESTAMP) AS window_start,
       CAST(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 7 DAY AS TIMESTAMP) AS window_end,
       user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS total
FROM events GROUP BY ALL""")
def weekly_counts(t):
    """Tumbling 7-day windows per user (aligned to 1970-01-01, as Spark's
    ``window``), with an exact total."""
    from strata.functions.numbers import exact_sum

    e = S.event_time(t.events.select("user_id", "ts", "value"), "ts")
    out = e.groupBy(F.window("ts", "7 days").alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id", "n", "total")


LATE_FEED = """
WITH e AS (SELECT event_id, CASE WHEN event_id % 40 = 7 THEN ts - INTERVAL 5 DAY ELSE ts END AS ts, event_type,
    CAST(floor(event_id * 3.0 / (SELECT max(event_id) + 1 FROM events)) AS INTEGER) AS slice FROM events),
m AS (SELECT slice, max(ts) AS top FROM e GROUP BY slice),
w AS (SELECT a.slice, max(b.top) AS top FROM m a LEFT JOIN m b ON b.slice < a.slice GROUP BY a.slice),
l AS (SELECT e.*, coalesce(ts < top - INTERVAL 2 HOUR, false) AS late FROM e JOIN w USING (slice))
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type, CASE WHEN late THEN 'late' ELSE 'kept' END AS outcome, true AS adds_up FROM l
UNION ALL SELECT event_id, CAST(ts AS TIMESTAMP), event_type, 'late', true FROM l WHERE late AND event_type = 'click'"""


@query("stream_late_quarantine", LATE_FEED)
def stream_late_quarantine(t):
    """S4/S2 in a running stream: late events land in a quarantine table,
    replays of clicks are dropped, and kept + late + duplicates = sent."""
    from strata.sources.sinks import move_path
    from strata.streaming.quarantine import LateQuarantine

    e = t.events.select("event_id", F.when(F.col("event_id") % 40 == 7, F.col("ts") - F.make_interval(days=F.lit(5))).otherwise(F.col("ts")).alias("ts"), "event_type")
    top = t.events.agg(F.max("event_id") + 1).scalar()
    e = e.withColumn("_file", F.floor(F.col("event_id") * FILES / top).cast("int"))
    e = e.unionByName(e.where("event_type = 'click'"))
    root = run_dir(t.spark, "late-quarantine")
    e.write.partitionBy("_file").parquet(f"{root}/staging")
    stream = S.event_time(file_stream(t.spark, f"{root}/input/part=*", "parquet", e.drop("_file").schema).drop("_source_file", "_ingest_ts"), "ts")
    q = LateQuarantine(t.spark, f"{root}/t", "ts", "event_id", 2 * 3600)
    for i in range(FILES):
        move_path(t.spark, f"{root}/staging/_file={i}", f"{root}/input/part={i:04d}")
        q.run(stream, f"{root}/ck")
    n = q.counts()
    adds = n["kept"] + n["late"] + n["duplicates"] == n["sent"] and F.lit(n["sent"]) == e.agg(F.count(F.lit(1))).scalar()
    out = q.kept().withColumn("outcome", F.lit("kept")).unionByName(q.late().withColumn("outcome", F.lit("late")))
    return out.withColumn("adds_up", adds if not isinstance(adds, bool) else F.lit(adds))
