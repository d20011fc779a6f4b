"""Late-data report (S4): how many events a watermark delay would drop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.sequence import running_max_before


def late_report(events: DataFrame, ts: str, batch: str, delays_seconds) -> DataFrame:
    """For each candidate delay, the events that arrive after the watermark
    has passed them: micro-batch ``b``'s watermark is the largest event time
    of batches before ``b`` minus the delay (Spark moves the watermark
    between micro-batches only).

    The per-batch maxima are one row per batch; their running maximum is
    carried over ranges of batches, so no task holds them all. It is joined
    back by batch id; each event is read once for all delays.
    """
    t = F.col(ts).cast("timestamp")
    per_batch = events.groupBy(batch).agg(F.max(t).alias("_bmax"))
    # ranges of 3,600 batches: the batch number taken as seconds, by the hour
    at = per_batch.withColumn("_at", F.timestamp_seconds(F.col(batch).cast("long")))
    marks = running_max_before(at, [], ["_at"], "_bmax", "_prev_max", unit="hour").select(F.col(batch).alias("_batch"), "_prev_max")
    # one row per micro-batch: AQE broadcasts it at run time when small
    e = events.select(F.col(batch).alias("_batch"), t.alias("_t")).join(marks, "_batch", "left")
    late = {int(s): F.count_if(F.col("_t") < F.col("_prev_max") - F.make_interval(secs=F.lit(int(s)))) for s in delays_seconds}
    counts = e.agg(F.count(F.lit(1)).alias("events"), *[c.alias(f"late_{s}") for s, c in late.items()])
    rows = F.array(*[F.struct(F.lit(s).alias("delay_seconds"), F.col("events"), F.col(f"late_{s}").alias("late_events")) for s in late])
    return counts.select(F.inline(rows)).withColumn("late_share", F.col("late_events") / F.col("events"))
