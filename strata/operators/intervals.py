"""General interval join (C6): overlap and point in interval, as equi joins.

**Pairs.** Every interval has a level: the smallest power of two above its length. At its
own level, or any higher one, it covers at most two bins. Of two intervals the
one of the higher level is *placed* in its bins and the other *probes* that
level, so a pair meets whatever the two lengths are, and an interval makes at
most two rows for each level that the other side has: a long interval is not
cut into as many rows as it has days. A pair that meets in two bins counts in
the bin where its overlap begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators._util import as_list
from strata.operators.sequence import _with_piece, split_pieces

SUM_TYPE = "decimal(38,6)"


def number(df: DataFrame, column: str) -> Column:
    """Integers as they are, dates as days, timestamps as microseconds."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("long")


def _level(lo: Column, hi: Column) -> Column:
    """Smallest k with hi - lo < 2^k."""
    length = hi - lo
    return F.when(length == 0, 0).otherwise(F.length(F.bin(length))).cast("int")


def _bins(lo: Column, hi: Column, level: Column) -> Column:
    first, last = F.call_function("shiftright", lo, level), F.call_function("shiftright", hi, level)
    return F.when(first == last, F.array(first)).otherwise(F.array(first, last))


def _spans(df: DataFrame, span: tuple[str, str], on: list[str], side: str) -> DataFrame:
    """``df`` with both ends as numbers, without rows that meet nothing."""
    low, high = number(df, span[0]), number(df, span[1])
    there = low <= high
    for k in on:
        there = there & F.col(k).isNotNull()
    return df.where(there).withColumns({f"_{side}lo": low, f"_{side}hi": high})


def _totals(a: DataFrame, b: DataFrame, on: list[str], sums: dict[str, str]) -> DataFrame:
    """For each different (``on``, low, high) of ``a`` that meets any row of
    ``b``: ``_rows``, and per sum its exact value ``_s_*`` and its number of
    values ``_k_*``."""
    point = lambda side, t, rank: F.struct(F.lit(side).alias("_side"), t.alias("_t"), F.lit(rank).alias("_rank"))
    values = {"_rows": F.count(F.lit(1))}
    for n, c in sums.items():
        values |= {f"_s_{n}": F.sum(F.col(c).cast(SUM_TYPE)), f"_k_{n}": F.count(c)}
    # side 0: beginnings up to a's end; side 1: ends before a's beginning
    ends = F.inline(F.array(point(0, F.col("_blo"), 0), point(1, F.col("_bhi"), 1)))
    given = b.select(*on, *dict.fromkeys(sums.values()), ends).groupBy(*on, "_side", "_t", "_rank").agg(*[v.alias(n) for n, v in values.items()])
    asks = F.inline(F.array(point(0, F.col("_ahi"), 1), point(1, F.col("_alo"), 0)))
    asked = a.select(*on, "_alo", "_ahi").distinct().select(*on, "_alo", "_ahi", asks)

    keys = [*on, "_side"]
    line = split_pieces(given.unionByName(asked, allowMissingColumns=True), keys, ["_t", "_rank"], split="range")
    upto = Window.partitionBy(*keys, "_b").orderBy("_t", "_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = line.withColumns({n: F.sum(n).over(upto) for n in values}).where(F.col("_alo").isNotNull())
    pieces = line.groupBy(*keys, "_b").agg(*[F.sum(n).alias(n) for n in values])
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(*keys, "_b", *[F.sum(n).over(before).alias(f"_p{n}") for n in values])
    out = _with_piece(inner, pieces, keys)
    sign = F.when(F.col("_side") == 0, 1).otherwise(-1)
    at = lambda n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_p{n}"), F.lit(0))
    met = out.groupBy(*on, "_alo", "_ahi").agg(*[F.sum(sign * at(n)).alias(n) for n in values])
    return met.where("_rows > 0")


def interval_join(a: DataFrame, b: DataFrame, a_span: tuple[str, str], b_span: tuple[str, str], on=(), how: str = "inner",
                  sums: dict[str, str] | None = None, count: str = "rows") -> DataFrame:
    """Pairs of rows whose closed intervals [low, high] share a point (and
    whose ``on`` columns are equal). A point is an interval with both ends the
    same column. Rows with a NULL end or key, or with low > high, meet nothing.

    Columns of both sides come out (``on`` once); other names must differ.
    ``how`` is ``inner``, ``left_semi`` (rows of ``a`` that meet any) or
    ``totals`` (those rows, with the number of rows of ``b`` that each meets
    as ``count`` and, for ``sums`` = {name: column of b}, their exact decimal
    sums, NULL if all values are); the last two make no pairs. A bin that holds
    many rows is an ordinary skewed join key, which the adaptive plan splits;
    nothing is compared outside its bin.
    """
    if how not in ("inner", "left_semi", "totals"):
        raise ValueError("how is inner, left_semi or totals")
    on, sums = as_list(on), dict(sums or {})
    left, right = _spans(a, a_span, on, "a"), _spans(b, b_span, on, "b")
    if how != "inner":
        met = _totals(left, right, on, sums if how == "totals" else {})
        at = [*on, "_alo", "_ahi"]
        if how == "left_semi":
            return left.join(met.select(*at), at, "left_semi").select(*a.columns)
        added = [F.when(F.col(f"_k_{n}") > 0, F.col(f"_s_{n}")).cast(SUM_TYPE).alias(n) for n in sums]
        return left.join(met, at).select(*a.columns, F.col("_rows").alias(count), *added)

    rows = {side: df.select(*on, f"_{side}lo", f"_{side}hi", F.struct(*cols).alias(f"_{side}")).withColumn(
        f"_{side}level", _level(F.col(f"_{side}lo"), F.col(f"_{side}hi"))) for side, df, cols in (("a", left, a.columns), ("b", right, b.columns))}

    def levels(side: str) -> list[int]:
        return sorted(r[0] for r in rows[side].select(f"_{side}level").distinct().collect())  # at most 64 numbers

    def place(side: str, level: Column) -> DataFrame:
        lo, hi = F.col(f"_{side}lo"), F.col(f"_{side}hi")
        return rows[side].withColumn("_level", level).withColumn("_bin", F.explode(_bins(lo, hi, F.col("_level"))))

    def probe(side: str, there: list[int], equal: bool) -> DataFrame:
        own = F.col(f"_{side}level")
        higher = F.filter(F.array(*[F.lit(x) for x in there]).cast("array<int>"), lambda x: (x >= own) if equal else (x > own))
        lo, hi = F.col(f"_{side}lo"), F.col(f"_{side}hi")
        return rows[side].withColumn("_level", F.explode(higher)).withColumn("_bin", F.explode(_bins(lo, hi, F.col("_level"))))

    keys = [*on, "_level", "_bin"]
    start = F.greatest("_alo", "_blo")
    meets = (start <= F.least("_ahi", "_bhi")) & (F.call_function("shiftright", start, F.col("_level")) == F.col("_bin"))
    wide_b = place("b", F.col("_blevel")).join(probe("a", levels("b"), True), keys)
    wide_a = place("a", F.col("_alevel")).join(probe("b", levels("a"), False), keys)
    pairs = wide_b.where(meets).select(*rows["a"].columns, *[c for c in rows["b"].columns if c not in on]).unionByName(
        wide_a.where(meets).select(*rows["a"].columns, *[c for c in rows["b"].columns if c not in on]))
    b_rest = [F.col(f"_b.{c}").alias(c) for c in b.columns if c not in on]
    return pairs.select(*[F.col(f"_a.{c}").alias(c) for c in a.columns], *b_rest)
