"""Aggregations.

All of them are hash aggregates with a partial (map-side) step, so a hot
group is pre-aggregated in every task before the shuffle; nothing is
collected per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.numbers import exact_sum, safe_ratio
from strata.operators._util import as_list


def basic_stats(df: DataFrame, by, measure: str, scale: int | None = 6) -> DataFrame:
    """count(*), count(measure), sum, avg, min, max per group.

    With ``scale`` set, sum and avg are exact (decimals), hence identical on
    any partitioning.
    """
    m = F.col(measure)
    total = exact_sum(measure, scale) if scale is not None else F.sum(m)
    return df.groupBy(*as_list(by)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(m).alias("n_values"),
        total.alias("total"),
        safe_ratio(total, F.count(m)).alias("mean"),
        F.min(m).alias("min_value"),
        F.max(m).alias("max_value"),
    )


def count_distinct(df: DataFrame, by, col: str, name: str = "n_distinct") -> DataFrame:
    """Exact distinct count per group (Catalyst rewrites it into a
    two-level aggregate: de-duplicate (group, value), then count)."""
    return df.groupBy(*as_list(by)).agg(F.countDistinct(col).alias(name))


def approx_distinct(df: DataFrame, by, col: str, rsd: float = 0.05, name: str = "approx_distinct") -> DataFrame:
    """HyperLogLog++ estimate, fixed memory per group, mergeable."""
    return df.groupBy(*as_list(by)).agg(F.approx_count_distinct(col, rsd).alias(name))


def conditional(df: DataFrame, by, measures: dict[str, Column]) -> DataFrame:
    """Named conditional aggregates, e.g.
    ``{"active": F.count_if(F.col("status") == "ACTIVE")}``."""
    return df.groupBy(*as_list(by)).agg(*[c.alias(n) for n, c in measures.items()])


def rollup_children(parent: DataFrame, children: DataFrame, key: str, measures: dict[str, Column],
                    defaults: dict | None = None) -> DataFrame:
    """Aggregate children per parent key, left-join onto the parent;
    parents without children get ``defaults`` (e.g. count 0)."""
    agg = children.groupBy(key).agg(*[c.alias(n) for n, c in measures.items()])
    out = parent.join(agg, key, "left")
    return out.na.fill(defaults) if defaults else out


def histogram(df: DataFrame, col: str, width: float, by=None, name: str = "bucket") -> DataFrame:
    """Counts per fixed-width bucket (``floor(c / width) * width``),
    aggregated on the executors; only the bucket counts leave them."""
    b = (F.floor(F.col(col) / F.lit(width)) * F.lit(width))
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(*as_list(by), b.alias(name))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rate_in_range(df: DataFrame, col: str, lo, hi, by=None, name: str = "share_in_range") -> DataFrame:
    """Share of non-NULL cells inside ``[lo, hi]``."""
    c = F.col(col)
    return df.groupBy(*as_list(by)).agg(
        safe_ratio(F.count_if(c.between(lo, hi)), F.count(c)).alias(name),
        F.count(c).alias("n_cells"),
    )


def weighted_score(df: DataFrame, by, flags: dict[str, float], distance: str, per: float = 100.0,
                   name: str = "score") -> DataFrame:
    """``per * sum(w_i * flag_i) / sum(distance)`` per group; NULL when
    the distance is 0."""
    parts = [F.lit(float(w)) * F.sum(F.col(f).cast("int")).cast("double") for f, w in flags.items()]
    weighted = parts[0]
    for p in parts[1:]:
        weighted = weighted + p
    return df.groupBy(*as_list(by)).agg(
        *[F.sum(F.col(f).cast("int")).alias(f"{f}_events") for f in flags],
        exact_sum(distance).alias("distance"),
        (F.lit(per) * safe_ratio(weighted, exact_sum(distance))).alias(name),
    )


def profile(df: DataFrame, cols, scale: int = 6, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """E5: long-format profile: one row per (column, statistic).

    count / mean / stddev / min / max come from one aggregate pass (mean
    from an exact decimal sum, stddev rounded to 6
    decimals so it does not depend on summation order);
    quartiles are exact (interpolated) and come from one distributed sort
    of all profiled columns in long form, never from one task holding all
    values. ``exact=False`` takes the quartiles from ``percentile_approx``
    instead (one aggregate pass, no sort, no checkpoint; rank error at most
    N / ``accuracy``).
    """
    rows = []
    stats = []
    for c in cols:
        x = F.col(c).cast("double")
        stats += [
            F.count(x).cast("double").alias(f"{c}|count"),
            (exact_sum(c, scale) / F.count(x)).alias(f"{c}|mean"),
            F.round(F.stddev_samp(x), 6).alias(f"{c}|stddev"),
            F.min(x).alias(f"{c}|min"),
            F.max(x).alias(f"{c}|max"),
        ]
    wide = df.agg(*stats)
    pairs = F.array(*[F.struct(F.lit(n.split("|")[0]).alias("column"), F.lit(n.split("|")[1]).alias("statistic"),
                               F.col(f"`{n}`").alias("value")) for n in wide.columns])
    rows.append(wide.select(F.inline(pairs)))
    if not exact:
        # bounded-memory quartiles (mergeable sketch, rank error <= N / accuracy)
        pq = df.agg(*[F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75], accuracy).alias(c) for c in cols])
        long_q = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(f"p{p}").alias("statistic"),
                                    F.col(f"`{c}`")[i].alias("value")) for c in cols for i, p in enumerate((25, 50, 75))])
        rows.append(pq.select(F.inline(long_q)))
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return out
    from strata.operators.ranking import exact_quantiles_by

    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                                         for c in cols])).alias("_e")).select("_e.*")
    q = exact_quantiles_by(long, "column", "x", [0.25, 0.5, 0.75])
    rows.append(q.select("column", F.concat(F.lit("p"), F.round(F.col("q") * 100).cast("int").cast("string")).alias("statistic"),
                         F.col("value")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
