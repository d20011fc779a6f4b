"""Ranking, top-k, quantiles and ordered output.

Newest-per-key uses a ``max_by`` aggregate instead of a
``row_number`` window: the aggregate has a map-side partial step, so a key
holding a third of the rows is reduced in every task before the shuffle.
Global ranks (quintiles, exact quantiles) come from a range-partitioned sort
plus per-partition offsets, so no single task sorts the whole input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators._util import as_list


def _order_key(order) -> list[Column]:
    out = []
    for o in as_list(order):
        out.append(F.col(o) if isinstance(o, str) else o)
    return out


def latest_per_key(df: DataFrame, keys, order, tie_break=None) -> DataFrame:
    """the newest row per business key.

    ``order`` lists ascending "newness" columns (the greatest wins); NULLs
    lose to any value (descending, NULLs last). Ties are broken by
    ``tie_break`` columns, by default a hash of the whole row, so the result
    never depends on task order. Implemented as ``max_by`` over a struct.
    """
    keys = as_list(keys)
    cols = df.columns
    # default tie-break: a 64-bit hash of the whole row (cheap; only rows
    # equal in every order column reach it)
    tb = [F.col(c) for c in as_list(tie_break)] if tie_break else [F.xxhash64(*[F.col(c) for c in cols])]
    ordering = F.struct(*[F.when(o.isNull(), 0).otherwise(1) for o in _order_key(order)] +
                        _order_key(order) + tb)
    payload = F.struct(*[F.col(c) for c in cols])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(payload, ordering).alias("_row"))
        .select("_row.*")
    )


def top_n(df: DataFrame, by, n: int, tie_break) -> DataFrame:
    """the ``n`` greatest rows by ``by`` (descending), ties broken by
    ``tie_break`` ascending. Planned as ``TakeOrderedAndProject``: each task
    keeps its own top ``n`` and only those reach the final merge."""
    order = [F.col(c).desc_nulls_last() for c in as_list(by)] + [F.col(c).asc() for c in as_list(tie_break)]
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, group, by, n: int, tie_break) -> DataFrame:
    """Top ``n`` rows per group. Each group's candidates are first cut to
    ``n`` per (group, task-local salt) so a hot group is ranked in pieces."""
    order = [F.col(c).desc_nulls_last() for c in as_list(by)] + [F.col(c).asc() for c in as_list(tie_break)]
    salted = df.withColumn("_s", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(32)))
    w1 = Window.partitionBy(*as_list(group), "_s").orderBy(*order)
    pre = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n).drop("_r", "_s")
    w2 = Window.partitionBy(*as_list(group)).orderBy(*order)
    return pre.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= n)


def sort_by(df: DataFrame, *order) -> DataFrame:
    """ordered presentation (distributed range-partitioned sort)."""
    return df.orderBy(*order)


def global_row_number(df: DataFrame, order, name: str = "row_number") -> DataFrame:
    """1-based position of each row in a total order over the whole frame.

    The sort is range-partitioned across tasks; each partition's row count
    (one row per partition) gives its offset; the offsets are joined back
    by broadcast. Give a total order (ties broken) for a repeatable result.

    The sorted, id-tagged rows are materialised once with a reliable
    ``checkpoint``: the counts and the rows must see the same partitions,
    and two evaluations of a range shuffle may be sampled or coalesced
    (AQE) differently.
    """
    from strata.session import cut_lineage

    tagged = df.orderBy(*_order_key(order)).withColumn("_mid", F.monotonically_increasing_id())
    tagged = cut_lineage(tagged.withColumn("_pid", F.shiftright(F.col("_mid"), 33)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per shuffle partition: a proven, small broadcast
    out = tagged.join(F.broadcast(offsets), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return out.withColumn(name, F.col("_off") + local + 1).drop("_mid", "_pid", "_off")


def quantile_bucket(df: DataFrame, col: str, n: int, tie_break, name: str = "bucket") -> DataFrame:
    """exact ``ntile(n)`` over ``col`` ascending (ties by ``tie_break``)
    without a single-task sort: bucket sizes follow ``ntile`` (the first
    ``N mod n`` buckets get one extra row)."""
    ranked = global_row_number(df, [F.col(col).asc_nulls_first()] + [F.col(c).asc() for c in as_list(tie_break)], "_rn")
    # N from the materialised rank (the input is not evaluated again)
    N = ranked.agg(F.max("_rn")).scalar()
    r = ranked
    q = F.floor(N / F.lit(n))
    rem = F.pmod(N, F.lit(n))
    i = F.col("_rn") - 1
    big = rem * (q + 1)
    bucket = F.when(i < big, F.floor(i / (q + 1)) + 1).otherwise(F.floor((i - big) / q) + rem + 1)
    return r.withColumn(name, bucket.cast("int")).drop("_rn")


def exact_quantiles(df: DataFrame, col: str, probs, name_q: str = "q", name_v: str = "value") -> DataFrame:
    """Exact, linearly interpolated quantiles (``percentile`` semantics,
    position ``p * (N - 1)``) of the non-NULL values of ``col``, from a
    distributed rank. One output row per probability."""
    out = exact_quantiles_by(df.select(F.lit("_").alias("_c"), F.col(col).alias("_x")), "_c", "_x", probs, name_q, name_v)
    return out.drop("_c")


def exact_quantiles_by(df: DataFrame, group: str, col: str, probs, name_q: str = "q", name_v: str = "value") -> DataFrame:
    """Exact interpolated quantiles of ``col`` per value of ``group``.

    Equal values are counted first (a partial aggregate), so a value that
    many rows share is one row of the sort. The distinct values are range
    sorted and stored once with their counts; running counts inside each
    partition and one total per (partition, group) place every value; the two
    values around each wanted position are picked and interpolated."""
    from strata.session import cut_lineage

    counted = (df.where(F.col(col).isNotNull()).groupBy(F.col(group).alias("_g"), F.col(col).alias("_v"))
               .agg(F.count(F.lit(1)).alias("_c")))
    stored = cut_lineage(counted.orderBy("_g", "_v").withColumn("_pid", F.spark_partition_id()))
    inside = Window.partitionBy("_pid", "_g").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = stored.groupBy("_g", "_pid").agg(F.sum("_c").alias("_n")).select(
        "_g", "_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    totals = stored.groupBy("_g").agg(F.sum("_c").alias("_n"))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("q"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("pos")) for p in probs])
    totals = totals.select("_g", wanted.alias("_want"))
    # sizes: partitions + groups rows, and one row per group
    placed = (stored.withColumn("_end", F.sum("_c").over(inside)).join(F.broadcast(pieces), ["_g", "_pid"])
              .withColumn("_end", F.col("_end") + F.col("_off")).withColumn("_start", F.col("_end") - F.col("_c"))
              .join(totals, "_g"))
    covers = lambda at: (at >= F.col("_start")) & (at < F.col("_end"))
    near = F.filter("_want", lambda w: covers(F.floor(w["pos"])) | covers(F.ceil(w["pos"])))
    hit = placed.where(F.size(near) > 0).select("_g", "_v", "_start", "_end", F.inline(near))
    low, high = F.floor("pos"), F.ceil("pos")
    out = hit.groupBy("_g", "q").agg(
        F.max(F.when(covers(low), F.col("_v"))).alias("_lo"), F.max(F.when(covers(high), F.col("_v"))).alias("_hi"),
        F.first(F.col("pos") - low).alias("_f"))
    return out.select(F.col("_g").alias(group), F.col("q").alias(name_q),
                      (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias(name_v))


def month_trend(df: DataFrame, month_col: str, measures: dict[str, Column]) -> DataFrame:
    """measures per month, in month order."""
    return df.groupBy(month_col).agg(*[c.alias(n) for n, c in measures.items()]).orderBy(month_col)
