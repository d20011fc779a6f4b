"""Streaming operators (S2-S5, S7). Each works on a streaming DataFrame
and, with the same meaning, on a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators._util import as_list


def event_time(df: DataFrame, ts: str, name: str | None = None) -> DataFrame:
    """Watermarks need ``TIMESTAMP`` (not ``TIMESTAMP_NTZ``, not text): cast
    in place (``name`` = new column)."""
    return df.withColumn(name or ts, F.col(ts).cast("timestamp"))


def dedup_stream(df: DataFrame, ts: str, keys, delay: str) -> DataFrame:
    """Drop replays of a key seen within ``delay`` (event time).

    ``dropDuplicatesWithinWatermark`` evicts a key's state once the
    watermark passes its first event time + delay, so state stays bounded
    (plain ``dropDuplicates`` would keep every key forever). Events older
    than the watermark are dropped as late; ``late_report`` sizes that
    loss before a delay is chosen.
    """
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(as_list(keys))


def drop_invalid_stream(df: DataFrame, condition: Column) -> DataFrame:
    """S3: a stateless range predicate placed before the stateful step, so
    invalid rows never enter state."""
    return df.where(F.coalesce(condition, F.lit(False)))


def windowed_counts(df: DataFrame, ts: str, size: str, delay: str, by=None, slide: str | None = None,
                    value: str | None = None) -> DataFrame:
    """Tumbling (or sliding, with ``slide``) event-time windows; in
    append mode a window is emitted once the watermark passes its end and
    its state is dropped."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias("total"))
    out = df.withWatermark(ts, delay).groupBy(w.alias("w"), *as_list(by)).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *as_list(by), *[a for a in ["n", "total"] if a == "n" or value])


def session_counts(df: DataFrame, ts: str, gap: str, delay: str, by) -> DataFrame:
    """Session windows (a session closes after ``gap`` without events);
    streaming form (state per key, closed by the watermark). For batch data
    use :func:`session_counts_batch`, which splits hot keys."""
    out = df.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("s"), *as_list(by)).agg(
        F.count(F.lit(1)).alias("n"))
    return out.select(*as_list(by), F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def observed_expectations(df: DataFrame, name: str, rules) -> DataFrame:
    """Per-micro-batch expectation counts via ``observe`` (read them
    from the query's progress / a listener); rows are not changed."""
    from strata.operators.quality import all_pass

    rules = list(rules.items()) if isinstance(rules, dict) else list(rules)
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(all_pass(rules)).alias("passed")] + \
        [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"failed_{n}") for n, c in rules]
    return df.observe(name, *metrics)


def fail_on_expectations(rules):
    """S7 ``expect_or_fail`` inside a stream: a ``foreachBatch`` step that
    raises before the batch is written when any row fails."""
    from strata.operators.quality import expect

    def check(batch_df: DataFrame, batch_id: int) -> DataFrame:
        out, _ = expect(batch_df, rules, "fail")
        return out

    return check


def session_counts_batch(df: DataFrame, ts: str, gap_seconds: int, by, unit: str = "day", split: str = "bucket") -> DataFrame:
    """Batch sessions with the same result as ``session_window``: start =
    first event, end = last event + gap, n = events. Sessionised per
    (key, day) with carries across days, then one partial aggregate per
    session."""
    from strata.operators.sequence import sessionize

    keys = as_list(by)
    s = sessionize(df, keys, ts, gap_seconds, unit, split=split)
    t = F.col(ts).cast("timestamp")
    return s.groupBy(*keys, "session_id").agg(
        F.min(t).alias("session_start"),
        (F.max(t) + F.make_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        F.count(F.lit(1)).alias("n"),
    ).drop("session_id")
