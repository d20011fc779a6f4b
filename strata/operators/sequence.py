"""Ordered operations per key that stay safe on a hot key.

A window ``PARTITION BY key ORDER BY ts`` sends every row of a key to one
task. These operators split each key further into ordered pieces ``_b``:

* ``split="bucket"`` (default): the piece is ``date_trunc(unit, ts)``; no
  extra shuffle, a key is spread over its time buckets;
* ``split="range"``: rows are range-partitioned on (key, order columns) and
  the partition id is the piece, so every piece is bounded by the partition
  size even for a burst of one key inside one bucket. The pieces are
  materialised once with a reliable ``checkpoint`` (Spark re-samples range
  boundaries on every evaluation, so the two uses of the pieces must read
  one materialised copy).

Rows are ordered inside (key, piece) and a small per-(key, piece) summary
(one or two rows per occupied piece) carries values across piece borders, so a
key holding a third of all rows is processed by many tasks. Results do not
depend on the split or the unit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators._util import as_list

UNITS = {"hour": "HOUR", "day": "DAY", "week": "WEEK", "month": "MONTH", "year": "YEAR"}


def _bucket(c: str, unit: str):
    return F.date_trunc(UNITS[unit], F.col(c).cast("timestamp"))


def split_pieces(df: DataFrame, keys, order, unit: str = "day", split: str = "bucket", name: str = "_b") -> DataFrame:
    """Adds the ordered piece column ``name`` (see module doc)."""
    keys, order = as_list(keys), as_list(order)
    if split == "bucket":
        return df.withColumn(name, _bucket(order[0], unit))
    if split != "range":
        raise ValueError(split)
    from strata.session import cut_lineage

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(c) for c in keys + order])
    return cut_lineage(ranged.withColumn(name, F.spark_partition_id()))


def _with_piece(inner: DataFrame, summary: DataFrame, keys) -> DataFrame:
    """Left join of per-piece values on (keys, piece); NULL keys and NULL
    times are values of their own, as they are in a window."""
    cols = keys + ["_b"]
    s = summary.select(*[F.col(c).alias(f"_s_{i}") for i, c in enumerate(cols)], *[c for c in summary.columns if c not in cols])
    on = None
    for i, c in enumerate(cols):
        same = F.col(c).eqNullSafe(F.col(f"_s_{i}"))
        on = same if on is None else on & same
    return inner.join(s, on, "left").drop(*[f"_s_{i}" for i in range(len(cols))])


def neighbors(df: DataFrame, keys, order, cols, unit: str = "day", prefix_prev: str = "prev_",
              prefix_next: str = "next_", split: str = "bucket") -> DataFrame:
    """Exact ``lag(c, 1)`` / ``lead(c, 1)`` per key in ``order`` for each
    column of ``cols`` (``order`` = [time column, tie-break columns...]).
    NULL times come first; a NULL key is a key of its own.

    Adds ``prev_<c>`` / ``next_<c>`` (NULL at the ends of a key). One window
    per piece serves the rows inside it; the first and last rows of the
    pieces (two a piece) meet in a second window. Both branches read the same
    shuffle, so the input is evaluated once.
    """
    keys, order, cols = as_list(keys), as_list(order), as_list(cols)
    b = split_pieces(df, keys, order, unit, split)
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    # a total order: the two branches below must agree on rows of equal order
    b = b.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    by_order = [*[F.col(o) for o in order], F.col("_tie")]
    w = Window.partitionBy(*keys, "_b").orderBy(*by_order)
    inner = (
        b.withColumn("_prev", F.lag(payload, 1).over(w))
        .withColumn("_next", F.lead(payload, 1).over(w))
        .withColumn("_first", F.lag(F.lit(1), 1).over(w).isNull())
        .withColumn("_last", F.lead(F.lit(1), 1).over(w).isNull())
    )
    inside = inner.where(~F.col("_first") & ~F.col("_last"))
    # of two border rows that follow one another the outer values are needed
    wk = Window.partitionBy(*keys).orderBy("_b", *by_order, F.col("_last"))
    border = (
        inner.where(F.col("_first") | F.col("_last"))
        .withColumn("_before", F.lag(payload, 1).over(wk))
        .withColumn("_after", F.lead(payload, 1).over(wk))
        .withColumn("_prev", F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_prev")))
        .withColumn("_next", F.when(F.col("_last"), F.col("_after")).otherwise(F.col("_next")))
        .drop("_before", "_after")
    )
    return inside.unionByName(border).select(
        *df.columns,
        *[F.col(f"_prev.{c}").alias(prefix_prev + c) for c in cols],
        *[F.col(f"_next.{c}").alias(prefix_next + c) for c in cols],
    )


def next_value_at_or_after(asks: DataFrame, values: DataFrame, keys, t: str, out: str,
                           unit: str = "year", split: str = "bucket") -> DataFrame:
    """For each row of ``asks``: the smallest ``values.t`` of the same key
    with ``values.t >= asks.t`` (NULL if none), named ``out``."""
    keys = as_list(keys)
    a = asks.withColumn("_kind", F.lit(0)).withColumn("_v", F.lit(None).cast(values.schema[t].dataType))
    v = values.select(*keys, F.col(t), F.col(t).alias("_v")).withColumn("_kind", F.lit(1))
    stacked = split_pieces(a.unionByName(v, allowMissingColumns=True), keys, [t, "_kind"], unit, split)
    # running minimum in descending time order: a growing frame (linear),
    # starts sort before questions at equal time so ">=" holds
    w = (Window.partitionBy(*keys, "_b").orderBy(F.col(t).desc(), F.col("_kind").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = stacked.withColumn("_in", F.min("_v").over(w)).where(F.col("_kind") == 0)
    summary = stacked.groupBy(*keys, "_b").agg(F.min("_v").alias("_bmin"))
    later = Window.partitionBy(*keys).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, "_b", F.min("_bmin").over(later).alias("_later"))
    res = _with_piece(inner, summary, keys)
    return res.select(*asks.columns, F.coalesce("_in", "_later").alias(out))


def running_max_before(df: DataFrame, keys, order, value: str, out: str, unit: str = "day",
                       split: str = "bucket") -> DataFrame:
    """``max(value)`` over all earlier rows of the key in ``order``
    (exclusive), NULL for the first row."""
    keys, order = as_list(keys), as_list(order)
    b = split_pieces(df, keys, order, unit, split)
    w = Window.partitionBy(*keys, "_b").orderBy(*[F.col(o) for o in order]).rowsBetween(Window.unboundedPreceding, -1)
    inner = b.withColumn("_in", F.max(value).over(w))
    summary = b.groupBy(*keys, "_b").agg(F.max(value).alias("_bmax"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, "_b", F.max("_bmax").over(before).alias("_earlier"))
    res = _with_piece(inner, summary, keys)
    return res.select(*df.columns, F.greatest("_in", "_earlier").alias(out))


def running_count(df: DataFrame, keys, order, flag: str, out: str, unit: str = "day",
                  split: str = "bucket") -> DataFrame:
    """Per key, the number of rows with ``flag`` TRUE up to and including
    this row in ``order``: a running count inside each (key, bucket) plus the
    totals of earlier buckets (a window over one row per occupied bucket)."""
    keys, order = as_list(keys), as_list(order)
    b = split_pieces(df, keys, order, unit, split)
    w = Window.partitionBy(*keys, "_b").orderBy(*[F.col(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    inner = b.withColumn("_in", F.sum(F.col(flag).cast("long")).over(w))
    totals = b.groupBy(*keys, "_b").agg(F.sum(F.col(flag).cast("long")).alias("_bt"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_b", F.coalesce(F.sum("_bt").over(before), F.lit(0)).alias("_earlier"))
    res = _with_piece(inner, totals, keys)
    return res.select(*df.columns, (F.col("_in") + F.col("_earlier")).alias(out))


def sessionize(df: DataFrame, keys, ts: str, gap_seconds: int, unit: str = "day", tie_break=None,
               split: str = "bucket") -> DataFrame:
    """Session id per row: a new session starts when the previous event of
    the key is more than ``gap_seconds`` earlier (a gap of exactly
    ``gap_seconds`` continues the session, as ``session_window`` does).
    Previous events and the
    running session count are both split into ordered pieces (see module
    doc)."""
    keys = as_list(keys)
    order = [ts] + as_list(tie_break)
    prev = neighbors(df, keys, order, [ts], unit, prefix_prev="_prev_", prefix_next="_next_", split=split)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    p = F.unix_micros(F.col(f"_prev_{ts}").cast("timestamp"))
    flagged = prev.withColumn("_new", p.isNull() | (t - p > F.lit(int(gap_seconds * 1_000_000)))) \
        .withColumn("_old", ~F.col("_new")).drop(f"_prev_{ts}", f"_next_{ts}")
    # of events at one time the one that opens the session is counted first
    return running_count(flagged, keys, order + ["_old"], "_new", "session_id", unit, split).drop("_new", "_old")
